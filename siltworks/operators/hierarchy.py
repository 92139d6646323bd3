"""Parent-child rows to full hierarchies: root, depth, path, descendants, loops.

Method: every partition contracts the parent chains that lie inside it to
*fragments* (a fragment ends at its exit, the topmost node whose parent lies
elsewhere); the fragments, linked by their exits' parents, form a smaller
quotient forest that is solved the same way; then paths, depths and sizes of
fragments are expanded back to their nodes. Loops inside a partition are found
at once and stand as a root from then on; loops over several partitions close
in the quotient.

At the first level nodes are ranged by key, since parents mostly lie near their
children. Later levels, if the quotient is still larger than one task's share,
rake leaves and colocate a random half of the nodes with their parents, so
that every level shrinks by a constant factor whatever the shape; trees that have
come down to their root are set aside as solved, for they shrink no more and their
number grows with the table. A group that
a task holds has about ``local_rows`` rows; a parent with more children than
that never draws them into its group. Groups grow in number with the table,
tasks do not: ``MOST_TASKS`` take the groups one after the other, and ``MOST_RANGES``
ranges, of whose bounds the driver holds samples, are sorted and sliced into groups.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut

NONE, MEMBER, BELOW = 0, 1, 2
#: What the driver keeps of a stage grows with its tasks, and what it samples with the ranges.
MOST_TASKS, MOST_RANGES = 1_000, 300
_UP = "id long, parent long, w long, size long, cyc boolean, up array<string>, part long, exit long, dist long, st int, fsum long, loc array<string>"
_DONE = "id long, root long, depth long, state int, total long, above array<string>"


def _links(ids: np.ndarray, parents: np.ndarray) -> np.ndarray:
    """Position of each row's parent, -1 if it is not among the rows."""
    order = np.argsort(ids, kind="stable")
    at = np.searchsorted(ids[order], parents)
    at[at == len(ids)] = 0
    found = order[at]
    return np.where((parents >= 0) & (ids[found] == parents), found, -1)


def _chase(lp: np.ndarray, w: np.ndarray):
    """Of each row: where its chain ends, the weight up to there, hops, 0/1/2 for tree, loop, below a loop.

    Chains that lead into a loop end at the loop's first row.
    """
    n = len(lp)
    here = np.arange(n)
    ptr, low = np.where(lp < 0, here, lp), here.copy()
    for _ in range(max(1, n.bit_length())):
        low = np.minimum(low, low[ptr])
        ptr = ptr[ptr]
    looped = lp[ptr] >= 0
    member = np.zeros(n, bool)
    member[ptr[looped]] = True
    stop = (lp < 0) | member
    ptr = np.where(stop, here, lp)
    dist, hops = np.where(stop, 0, w), np.where(stop, 0, 1)
    for _ in range(max(1, n.bit_length())):
        dist, hops, ptr = dist + dist[ptr], hops + hops[ptr], ptr[ptr]
    return np.where(member[ptr], low[ptr], ptr), dist, hops, np.where(member, MEMBER, np.where(looped, BELOW, NONE))


def _sums(lp: np.ndarray, hops: np.ndarray, size: np.ndarray, flag: np.ndarray):
    """Sums of ``size`` over subtrees, and whether a subtree holds a flag; loop rows take their branches only."""
    size, flag = size.copy(), flag.copy()
    order = np.argsort(-hops, kind="stable")
    bounds = np.flatnonzero(np.diff(hops[order])) + 1
    for rows in np.split(order, bounds):
        rows = rows[(hops[rows] > 0)]
        np.add.at(size, lp[rows], size[rows])
        np.logical_or.at(flag, lp[rows], flag[rows])
    return size, flag


def _numbers(pdf: pd.DataFrame):
    return pdf["id"].to_numpy(np.int64), pdf["parent"].fillna(-1).to_numpy(np.int64), pdf["w"].to_numpy(np.int64), pdf["size"].to_numpy(np.int64)


def _trails(lp, hops, ups):
    """Names from each row's end of chain down to the row itself, exclusive."""
    out = [None] * len(lp)
    for i in np.argsort(hops, kind="stable"):
        out[i] = [] if hops[i] == 0 else [*out[lp[i]], *ups[i]]
    return out


def _contract(pdf: pd.DataFrame, paths: bool) -> pd.DataFrame:
    ids, parents, w, size = _numbers(pdf)
    lp = _links(ids, parents)
    end, dist, hops, st = _chase(lp, w)
    whole, _ = _sums(lp, hops, size, np.zeros(len(ids), bool))
    ring = np.zeros(len(ids), np.int64)
    np.add.at(ring, end[st == MEMBER], whole[st == MEMBER])
    out = pdf[["id", "w", "size", "cyc", "up", "part"]].copy()
    out["parent"] = pdf["parent"].astype("Int64")
    out["exit"], out["dist"], out["st"] = ids[end], dist, st
    out["fsum"] = np.where(st == MEMBER, ring, whole)
    out["loc"] = _trails(lp, hops, pdf["up"].tolist()) if paths else None
    return out[["id", "parent", "w", "size", "cyc", "up", "part", "exit", "dist", "st", "fsum", "loc"]]


def _expand(pdf: pd.DataFrame, paths: bool) -> pd.DataFrame:
    """Rows of one group with what is known of their exits and of the fragments below them."""
    ids, parents, w, size = _numbers(pdf)
    lp = _links(ids, parents)
    _, dist, hops, st = _chase(lp, w)
    below = pdf["att_size"].fillna(0).to_numpy(np.int64)
    total, on_ring = _sums(lp, hops, size + below, pdf["att_ring"].eq(True).to_numpy(bool))
    far = pdf["r_state"].to_numpy(np.int64)
    state = np.where(st != NONE, st, np.where(far == MEMBER, np.where(on_ring, MEMBER, BELOW), far))
    # an exit that is a loop's stand-in from a lower level is a member by itself
    state = np.where((st == NONE) & (far == MEMBER) & pdf["r_alone"].to_numpy(bool) & (hops == 0), MEMBER, state)
    depth = np.where(state == NONE, pdf["r_depth"].to_numpy(np.int64) + dist, -1)
    out = pd.DataFrame({"id": ids, "root": pdf["r_root"].to_numpy(np.int64), "depth": depth, "state": state.astype(np.int32)})
    out["total"] = np.where(state == MEMBER, pdf["r_total"].to_numpy(np.int64), total)
    out["above"] = [None if s else [*a, *b] for s, a, b in zip(state, pdf["r_above"], pdf["loc"])] if paths else None
    return out


def _finish(pdf: pd.DataFrame, paths: bool) -> pd.DataFrame:
    """The whole quotient in one group."""
    ids, parents, w, size = _numbers(pdf)
    lp = _links(ids, parents)
    end, dist, hops, st = _chase(lp, w)
    total, _ = _sums(lp, hops, size, np.zeros(len(ids), bool))
    ring = np.zeros(len(ids), np.int64)
    np.add.at(ring, end[st == MEMBER], total[st == MEMBER])
    stands = pdf["cyc"].to_numpy(bool)
    state = np.where(st != NONE, st, np.where(stands[end], np.where(hops == 0, MEMBER, BELOW), NONE))
    out = pd.DataFrame({"id": ids, "root": ids[end], "depth": np.where(state == NONE, dist, -1), "state": state.astype(np.int32)})
    out["total"] = np.where(st == MEMBER, ring[end], total)
    out["above"] = _trails(lp, hops, pdf["up"].tolist()) if paths else None
    return out


def _solve(rows: DataFrame, n: int, local_rows: int, paths: bool, level: int) -> DataFrame:
    """rows: id, parent, w, size, cyc, up, part. Gives id, root, depth, state, total, above of each."""
    finished = lambda some: some.withColumn("part", F.lit(0).cast("long")).groupBy("part").applyInPandas(lambda pdf: _finish(pdf, paths), _DONE)
    if n <= local_rows:
        return finished(rows)
    leaves = None
    if level:
        kids = rows.where("parent is not null").groupBy(F.col("parent").alias("id")).agg(F.count("*").alias("kids"))
        rows = cut(rows.join(kids, "id", "left"))
        leaves = rows.where("kids is null and parent is not null").drop("kids")
        extra = leaves.groupBy(F.col("parent").alias("id")).agg(F.sum("size").alias("extra"))
        alone = rows.where("kids is null and parent is null").select(
            "id",
            F.col("id").alias("root"),
            F.when(F.col("cyc"), -1).otherwise(0).cast("long").alias("depth"),
            F.when(F.col("cyc"), MEMBER).otherwise(NONE).alias("state"),
            F.col("size").alias("total"),
            (F.array() if paths else F.lit(None)).cast("array<string>").alias("above"),
        )
        core = rows.where("kids is not null").join(extra, "id", "left").withColumn("size", F.col("size") + F.coalesce("extra", F.lit(0)))
        n = rows.where("kids is not null").count()
        crowded = kids.where(F.col("kids") > max(1, local_rows // 4)).select(F.col("id").alias("parent"), F.lit(True).alias("crowded"))
        coin = lambda c: F.pmod(F.xxhash64(c, F.lit(level)), F.lit(2)) == 0
        anchor = F.when(~coin(F.col("id")) & F.col("parent").isNotNull() & F.col("crowded").isNull() & coin(F.col("parent")), F.col("parent")).otherwise(F.col("id"))
        parts = max(1, 2 * ceil(n / local_rows))
        rows = core.drop("kids", "extra", "part").join(crowded, "parent", "left").withColumn("part", F.pmod(F.xxhash64(anchor, F.lit(-level)), F.lit(parts)).cast("long")).drop("crowded")
    rows = rows.select("id", "parent", "w", "size", "cyc", "up", "part")
    if leaves is None:
        return _contracted(rows, local_rows, paths, level, 2 * ceil(n / local_rows))
    done = cut(finished(rows) if n <= local_rows else _contracted(rows, local_rows, paths, level, 2 * ceil(n / local_rows)))
    top = done.select(F.col("id").alias("parent"), "root", F.col("depth").alias("d"), F.col("state").alias("s"), F.col("above").alias("a"))
    hung = leaves.join(top, "parent").select(
        "id",
        "root",
        F.when(F.col("s") == NONE, F.col("d") + F.col("w")).otherwise(F.lit(-1)).alias("depth"),
        F.when(F.col("s") == NONE, F.lit(NONE)).otherwise(F.lit(BELOW)).alias("state"),
        F.col("size").alias("total"),
        F.when(F.col("s") == NONE, F.concat("a", "up")).alias("above") if paths else F.lit(None).cast("array<string>").alias("above"),
    )
    return done.unionByName(hung).unionByName(alone)


def _contracted(rows: DataFrame, local_rows: int, paths: bool, level: int, parts: int) -> DataFrame:
    # the rows are few bytes each, so the number of tasks is not left to their size
    tasks = min(parts, MOST_TASKS)
    frags = cut(rows.repartition(tasks, "part").groupBy("part").applyInPandas(lambda pdf: _contract(pdf, paths), _UP))
    ends = frags.where("id = exit").select("id", F.when(F.col("st") == NONE, F.col("parent")).alias("pe"), "w", F.col("fsum").alias("size"), ((F.col("st") == MEMBER) | F.col("cyc")).alias("cyc"), "up")
    at = frags.select(F.col("id").alias("pe"), F.col("exit").alias("parent"), F.col("dist").alias("far"), F.col("loc").alias("lead"))
    quotient = cut(
        ends.join(at, "pe", "left").select(
            "id", "pe", "parent", (F.col("w") + F.coalesce("far", F.lit(0))).alias("w"), "size", "cyc",
            (F.when(F.col("parent").isNull(), F.col("up")).otherwise(F.concat("lead", "up")) if paths else F.lit(None).cast("array<string>")).alias("up"),
        )
    )
    n = quotient.count()
    solved = cut(_solve(quotient.drop("pe").withColumn("part", F.lit(0).cast("long")), n, local_rows, paths, level + 1))
    hung = (
        quotient.where("pe is not null")
        .join(solved.select("id", "total", "state"), "id")
        .groupBy(F.col("pe").alias("id"))
        .agg(F.sum("total").alias("att_size"), F.max(F.col("state") == MEMBER).alias("att_ring"))
    )
    known = solved.join(quotient.select("id", F.col("parent").isNull().alias("r_alone")), "id").select(
        F.col("id").alias("exit"), F.col("root").alias("r_root"), F.col("depth").alias("r_depth"), F.col("state").alias("r_state"), F.col("total").alias("r_total"), F.col("above").alias("r_above"), "r_alone"
    )
    full = frags.join(known, "exit").join(hung, "id", "left").drop("exit", "dist", "st", "fsum", "cyc", "up")
    return full.repartition(tasks, "part").groupBy("part").applyInPandas(lambda pdf: _expand(pdf, paths), _DONE)


def hierarchy(df: DataFrame, node: str = "url", parent: str = "parent_url", order: list[Column] | None = None, key=lambda c: c, with_path: bool = False, local_rows: int = 50_000) -> DataFrame:
    """One row per node: node, parent, root, depth, descendants, cycle_state[, path].

    ``key`` brings node and parent columns to the form in which they are
    compared. Of several rows of one node the first by ``order`` (then by the
    parent, nulls last) counts. Rows whose node is null are no nodes; a parent
    that is null, blank or no node makes its child a root. ``cycle_state`` is
    ``member`` on a loop (a node that is its own parent is one), ``below``
    under one, else ``none``. ``root`` is the topmost ancestor, or the smallest
    node of the loop; ``depth`` counts steps from the root and is -1 for member
    and below; ``descendants`` counts the other nodes reachable downwards;
    ``path`` lists the nodes from the root to the node itself and is null for
    member and below. Repeated rows and further columns change nothing; an
    empty table gives an empty result.
    """
    if local_rows < 1:
        raise ValueError("local_rows must be positive")
    rows = df.select(key(F.col(node)).alias("node"), F.nullif(key(F.col(parent)), F.lit("")).alias("up_node"), F.struct(*(order or [F.lit(0)])).alias("ord"))
    first = F.min(F.struct(*[F.struct(c.isNull(), c) for c in (F.col(f"ord.{f}") for f in rows.schema["ord"].dataType.names)], F.col("up_node").isNull(), F.col("up_node").alias("up_node"))).alias("m")
    nodes = rows.where(F.col("node").isNotNull() & (F.col("node") != "")).groupBy("node").agg(first).select("node", F.col("m.up_node").alias("up_node"))
    parts = max(1, ceil(df.count() / local_rows))
    nodes = cut(nodes.repartitionByRange(min(parts, MOST_RANGES), "node").sortWithinPartitions("node").withColumn("id", F.monotonically_increasing_id()))
    # an id holds its range and, in the lower 33 bits, its place there
    place = F.col("id").bitwiseAND(F.lit((1 << 33) - 1))
    ids = nodes.select(F.col("node").alias("up_node"), F.col("id").alias("parent"))
    linked = nodes.join(ids, "up_node", "left").select(
        "id", "parent", F.lit(1).cast("long").alias("w"), F.lit(1).cast("long").alias("size"), F.lit(False).alias("cyc"),
        (F.array("up_node") if with_path else F.lit(None).cast("array<string>")).alias("up"),
        F.shiftleft(F.shiftright("id", 33), 33).bitwiseOR(F.floor(place / local_rows)).alias("part"),
    )
    done = cut(_contracted(linked, local_rows, with_path, 0, parts))
    # of a loop the smallest node in byte order stands for the root
    rings = done.where(F.col("state") == MEMBER).join(nodes, "id").groupBy("root").agg(F.min("node").alias("ring_root"))
    roots = nodes.select(F.col("id").alias("root"), F.col("node").alias("root_node"))
    tree_roots = done.where("id = root").join(roots, "root").join(rings, "root", "left").select("root", F.coalesce("ring_root", "root_node").alias("root_node"))
    out = nodes.join(done, "id").join(tree_roots, "root").select(
        "node",
        F.col("up_node").alias("parent"),
        F.col("root_node").alias("root"),
        "depth",
        (F.col("total") - 1).alias("descendants"),
        F.when(F.col("state") == MEMBER, "member").when(F.col("state") == BELOW, "below").otherwise("none").alias("cycle_state"),
        *([F.when(F.col("state") == NONE, F.concat("above", F.array("node"))).alias("path")] if with_path else []),
    )
    return out
