"""Splits that keep related records together.

Method: hash-to-min over the graph of entities (values of the key columns that
records share), then weighted rendezvous hashing of the components. A cluster
is never gathered: membership is a relation of (node, member) rows, a round is
one aggregation and one join. The minimum of a large component holds all its
members; such nodes, of which there are few, are joined by broadcast, so their
rows stay where they are and the largest component is spread over tasks.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut


def entity_components(edges: DataFrame, max_rounds: int = 64, heavy: int = 1000) -> DataFrame:
    """edges(a, b) of strings to (node, component): the smallest node of each connected part in byte order.

    Nulls join nothing; an edge of a node with itself makes it a part of its
    own. Nodes on one edge only are set aside first and take their
    neighbour's component at the end, which leaves the connected parts as
    they are.
    """
    # read twice, made once
    e = cut(edges.where("a is not null and b is not null").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    both = cut(e.select("a", "b").union(e.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"))))
    degree = both.where("a <> b").groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("peer"))
    pendant = degree.where("n = 1").select(F.col("a").alias("node"), "peer")
    # of two pendant nodes joined to each other the smaller stays
    peers = pendant.select(F.col("node").alias("peer"), F.lit(True).alias("too"))
    leaf = cut(pendant.join(peers, "peer", "left").where("too is null or node > peer").select("node", "peer"))
    core = both.select(F.col("a").alias("node"), F.col("b").alias("member")).join(leaf.select("node"), "node", "left_anti")
    core = core.join(leaf.select(F.col("node").alias("member")), "member", "left_anti").select("node", "member")
    # every node knows itself, also where only leaves hang on it
    alone = both.select(F.col("a").alias("node")).union(leaf.select(F.col("peer").alias("node"))).distinct().join(leaf.select("node"), "node", "left_anti")
    cluster = cut(core.union(alone.select("node", F.col("node").alias("member"))).distinct())
    before, rows = None, cluster.count()
    for _ in range(max_rounds):
        low = cut(cluster.groupBy("node").agg(F.min("member").alias("low"), F.count("*").alias("n")))
        crowded = F.broadcast(low.where(F.col("n") * heavy > rows).select("node", "low"))
        sent = cluster.join(crowded, "node").union(cluster.join(crowded.select("node"), "node", "left_anti").join(low.where(F.col("n") * heavy <= rows).select("node", "low"), "node")).select("low", "member", "node")
        # the whole cluster goes to its minimum, the minimum goes to every member
        up = sent.select(F.col("low").alias("node"), "member")
        down = sent.select(F.col("member").alias("node"), F.col("low").alias("member"))
        cluster = cut(up.union(down).distinct())
        now = cluster.agg(F.count("*"), F.sum(F.xxhash64("node", "member").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, rows = now, now[0]
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    found = cluster.groupBy("node").agg(F.min("member").alias("component"))
    hung = leaf.join(found.withColumnRenamed("node", "peer"), "peer").select("node", F.least("node", "component").alias("component"), F.col("component").alias("was"))
    # a leaf may be the smallest of its part
    fixed = cut(found.select("node", F.col("component").alias("was")).union(hung.select("node", "was")))
    name = fixed.groupBy("was").agg(F.min("node").alias("component"))
    return fixed.join(name, "was").select("node", "component")


def record_entities(df: DataFrame, record_id: str, keys: Mapping[str, Column]) -> DataFrame:
    """Of each record its entities as (record_id, entity); records without any stand for themselves."""
    parts = [F.when(c.isNotNull() & (c != ""), F.concat(F.lit(f"{name}\u0001"), c)) for name, c in sorted(keys.items())]
    own = F.concat(F.lit("\u0002"), F.col(record_id).cast("string"))
    found = F.array_compact(F.array(*parts))
    return df.select(F.col(record_id).alias("record_id"), F.when(F.size(found) == 0, F.array(own)).otherwise(found).alias("entities"))


def rendezvous(key: Column, weights: Mapping[str, float], seed: int = 0) -> Column:
    """The split of a key: the least -ln(u) / weight, u a hash of key and split in (0, 1)."""
    if not weights or any(w < 0 for w in weights.values()) or not any(weights.values()):
        raise ValueError("weights must be non-negative and not all zero")
    scores = []
    for name, w in sorted(weights.items()):
        if w:
            u = (F.pmod(F.xxhash64(key, F.lit(name), F.lit(seed)), F.lit(1 << 52)) + F.lit(0.5)) / F.lit(float(1 << 52))
            scores.append(F.struct((-F.log(u) / F.lit(float(w))).alias("score"), F.lit(name).alias("name")))
    return F.least(*scores)["name"] if len(scores) > 1 else scores[0]["name"]


def entity_map(df: DataFrame, record_id: str, keys: Mapping[str, Column], whole_records: bool = False) -> tuple[DataFrame, DataFrame]:
    """(record_id, entities) and (node, component) of all entities.

    With ``whole_records`` different entities of one record's rows are joined over the record too.
    """
    ents = record_entities(df, record_id, keys)
    # a star on the first entity links all of a row's
    edges = ents.select(F.col("entities")[0].alias("a"), F.explode("entities").alias("b")).distinct()
    if whole_records:
        firsts = ents.groupBy("record_id").agg(F.min(F.col("entities")[0]).alias("a"), F.max(F.col("entities")[0]).alias("b")).where("a <> b").select("record_id", "a")
        edges = edges.union(ents.join(firsts, "record_id").select("a", F.explode("entities").alias("b")))
    return ents, entity_components(edges)


def placed(sizes: list[tuple[str, int]], shares: Mapping[str, float], total: int, seed: int = 0) -> tuple[dict[str, str], dict[str, float]]:
    """(component to split, what is left of each share) for heavy components, the largest first.

    Each goes, by weighted rendezvous hashing with what is left as weights, to
    one of the splits that have room for it, or else to the one with most room.
    """
    left = {n: w * total / sum(shares.values()) for n, w in shares.items()}
    out = {}
    for name, size in sorted(sizes, key=lambda c: (-c[1], c[0])):
        room = [n for n in left if left[n] >= size]

        def score(n, name=name):
            u = (int.from_bytes(hashlib.blake2b(f"{seed}|{name}|{n}".encode(), digest_size=8).digest(), "big") + 0.5) / 2**64
            return -math.log(u) / left[n]

        to = min(room, key=score) if room else max(left, key=lambda n: (left[n], n))
        out[name] = to
        left[to] -= size
    return out, {n: max(0.0, v) for n, v in left.items()}


def related_splits(df: DataFrame, record_id: str, keys: Mapping[str, Column], weights: Mapping[str, float] | None = None, seed: int = 0, heavy: int = 2000) -> DataFrame:
    """record_id, component, split: records that share an entity, directly or over others, get one split.

    Proportions hold over records. Components of more than one in ``heavy``
    records, fewer than ``heavy``, are counted on the driver and placed first by what is left of
    each share (:func:`placed`); all others go by rendezvous hashing weighted
    with what is left then. A component larger than a share overfills a split,
    since it may not be divided. Null and empty values join
    nothing. Repeated rows of a record count once; if rows of one record name
    different entities, all of these are joined. An empty table gives no rows.
    """
    shares = dict(weights or {"train": 0.8, "validation": 0.1, "test": 0.1})
    if not shares or any(w < 0 for w in shares.values()) or not any(shares.values()):
        raise ValueError("weights must be non-negative and not all zero")
    ents, comp = entity_map(df, record_id, keys, whole_records=True)
    firsts = ents.groupBy("record_id").agg(F.min(F.col("entities")[0]).alias("entity"))
    of = cut(firsts.join(comp.withColumnRenamed("node", "entity"), "entity").select("record_id", "component"))
    sizes = of.groupBy("component").agg(F.count("*").alias("n"))
    total = of.count()
    big = [(r["component"], r["n"]) for r in sizes.where(F.col("n") * heavy > total).collect()]
    at, left = placed(big, shares, total, seed)
    light = rendezvous(F.col("component"), left if any(left.values()) else shares, seed)
    if not at:
        return of.select("record_id", "component", light.alias("split"))
    table = F.broadcast(df.sparkSession.createDataFrame(list(at.items()), "component string, place string"))
    return of.join(table, "component", "left").select("record_id", "component", F.coalesce("place", light).alias("split"))
