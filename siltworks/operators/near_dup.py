"""Near-duplicate records of one page, by the ratio of matching blocks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..checkpoints import cut
from ..functions.ratios import PAIRS, Texts
from ..functions.text import near_key

ANSWER_THRESHOLD, QUESTION_THRESHOLD = 0.4, 0.6
#: Rows and characters that a task compares at once; a group of a pair of blocks stays together.
_ROWS, _CHARS = 2_048, 1_000_000


def _compared(pdf: pd.DataFrame, threshold: float) -> pd.DataFrame:
    """Pairs of the threshold or more inside the groups (g, x, y) of rows sorted by group and first."""
    firsts, lasts, b = pdf["first"].to_numpy(), pdf["last"].to_numpy(), pdf["b"].to_numpy()
    same = (pdf["x"] == pdf["y"]).to_numpy()
    texts = Texts(pdf["t"].tolist())
    rows = np.arange(len(pdf))
    new = _begins(pdf)
    more = np.append(np.flatnonzero(new)[1:], len(pdf))[np.cumsum(new) - 1] - rows - 1
    out, ahead = [], np.cumsum(more)
    for k in np.split(rows, np.flatnonzero(np.diff(ahead // PAIRS)) + 1):
        i = np.repeat(k, more[k])
        j = i + 1 + np.arange(len(i)) - np.repeat(ahead[k] - more[k] - (ahead[k[0]] - more[k[0]]), more[k])
        keep = same[i] | (b[i] != b[j])
        i, j = i[keep], j[keep]
        keep = texts.bound(i, j) >= threshold
        i, j = i[keep], j[keep]
        mixed = lasts[i] > firsts[j]
        forward, backward = texts.ratios(j, i, threshold), np.full(len(i), -1.0)
        backward[mixed] = texts.ratios(i[mixed], j[mixed], threshold)
        found = pd.DataFrame({"a": firsts[i], "b": firsts[j], "forward": forward, "backward": backward, "mixed": mixed})
        out.append(found[np.maximum(forward, backward) >= max(threshold, 0)])
    out = pd.concat(out)
    for c in ("forward", "backward"):
        out[c] = out[c].astype("Float64").mask(out[c] < 0)
    return out


def _begins(pdf: pd.DataFrame) -> np.ndarray:
    """Whether a row begins a group (g, x, y)."""
    new = np.ones(len(pdf), bool)
    new[1:] = False
    for c in ("g", "x", "y"):
        v = pdf[c].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return new


def near_classes(df: DataFrame, field: str = "answer", threshold: float = ANSWER_THRESHOLD, seq: str = "record_seq", group: str = "source_url", block: int = 128) -> tuple[DataFrame, DataFrame]:
    """(members, pairs) of rows of one group whose near keys have ratio ``threshold`` or more.

    members(s, cls): each row's class of equal keys in its group, named by its
    first row. pairs(a, b, forward, backward, mixed) of different classes, a < b:
    the ratio depends on which text comes first, so ``forward`` holds for rows of
    a before rows of b and ``backward`` for the other order; null below the threshold and,
    if the two do not mix, for the order that does not occur. Rows of one class have ratio 1.

    The ratio is 2 x matching characters / all characters of both near keys, with
    the matching blocks of the later row against the earlier one and the usual
    skipping of popular characters from 200 characters on. A null group is a group, null texts are empty.

    Pairs are never rows before they pass: a group is dealt into blocks of about
    ``block`` classes, every pair of blocks is a task's work, and inside it the
    exact bound by character counts goes first; the ratios of the rest are taken many at a
    time. A group that holds a third of all rows is thereby spread over the cluster; no pair is lost.
    """
    if not 0 <= threshold <= 1:
        raise ValueError("threshold must be in [0, 1]")
    rows = df.select(F.coalesce(F.col(group), F.lit("")).alias("g"), F.col(seq).cast("long").alias("s"), near_key(F.col(field)).alias("t")).withColumn("h", F.md5("t"))
    classes = rows.groupBy("g", "h").agg(F.min("s").alias("first"), F.max("s").alias("last"), F.min("t").alias("t"))
    sizes = classes.groupBy("g").agg(F.count("*").alias("k")).where("k > 1")
    dealt = classes.join(sizes, "g").withColumn("blocks", F.ceil(F.col("k") / F.lit(block)).cast("int")).withColumn("b", F.pmod(F.xxhash64("t"), F.col("blocks")).cast("int"))
    spread = dealt.withColumn("o", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("g", "b", F.least("b", "o").alias("x"), F.greatest("b", "o").alias("y"), "first", "last", "t")

    def compare(batches):
        held: list[pd.DataFrame] = []
        rows = chars = 0
        for pdf in batches:
            held.append(pdf)
            rows, chars = rows + len(pdf), chars + int(pdf["t"].str.len().sum())
            if rows < _ROWS and chars < _CHARS:
                continue
            whole = pd.concat(held, ignore_index=True)
            # the last group may go on in the next batch
            starts = np.flatnonzero(_begins(whole))
            size = np.cumsum(whole["t"].str.len().to_numpy())
            at = 0
            while at < starts[-1]:
                to = min(at + _ROWS, np.searchsorted(size, (size[at - 1] if at else 0) + _CHARS))
                later = starts[starts > at]
                to = later[max(0, np.searchsorted(later, to, "right") - 1)]
                yield _compared(whole[at:to], threshold)
                at = to
            held = [whole[at:]]
            rows, chars = len(held[0]), int(held[0]["t"].str.len().sum())
        if rows:
            yield _compared(pd.concat(held, ignore_index=True), threshold)

    # comparing costs far more than its input's bytes tell, so the number of tasks is not left to their size
    spark = df.sparkSession
    tasks = max(3 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = spread.repartition(tasks, "g", "x", "y").sortWithinPartitions("g", "x", "y", "first").mapInPandas(compare, "a long, b long, forward double, backward double, mixed boolean")
    return rows.select("g", "h", "s").join(classes.select("g", "h", F.col("first").alias("cls")), ["g", "h"]).select("s", "cls"), pairs


def _halves(pairs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pairs all of whose rows are near, and those of which only one order is."""
    part = F.col("mixed") & (F.col("forward").isNull() | F.col("backward").isNull())
    return pairs.where(~part), pairs.where(part)


def near_links(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """(s, cls, links): each row's class and how many rows it is near to; half the sum of links is the number of pairs."""
    # numbers only, read again and again below; their texts are not
    members = cut(members)
    n = members.groupBy("cls").agg(F.count("*").alias("n"))
    sized = pairs.join(n.select(F.col("cls").alias("a"), F.col("n").alias("na")), "a").join(n.select(F.col("cls").alias("b"), F.col("n").alias("nb")), "b")
    whole, part = _halves(sized)
    of_class = whole.select(F.col("a").alias("cls"), F.col("nb").alias("links")).union(whole.select("b", "na")).groupBy("cls").agg(F.sum("links").alias("more"))
    one = lambda side: part.join(members.withColumnRenamed("cls", side), side).select("a", "b", "na", "nb", F.col("forward").isNotNull().alias("fwd"), "s", F.lit(side == "a").alias("of_a"))
    order = Window.partitionBy("a", "b").orderBy("s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    told = one("a").union(one("b")).withColumn("before", F.sum(F.when(F.col("of_a"), 0).otherwise(1)).over(order)).withColumn("before_a", F.sum(F.when(F.col("of_a"), 1).otherwise(0)).over(order))
    links = F.when(F.col("of_a"), F.when(F.col("fwd"), F.col("nb") - F.col("before")).otherwise(F.col("before"))).otherwise(F.when(F.col("fwd"), F.col("before_a")).otherwise(F.col("na") - F.col("before_a")))
    of_row = told.groupBy("s").agg(F.sum(links).alias("own"))
    return members.join(n, "cls").join(of_class, "cls", "left").join(of_row, "s", "left").select("s", "cls", (F.col("n") - 1 + F.coalesce("more", F.lit(0)) + F.coalesce("own", F.lit(0))).alias("links"))


def near_duplicates(df: DataFrame, field: str = "answer", threshold: float = ANSWER_THRESHOLD, seq: str = "record_seq", group: str = "source_url", block: int = 128) -> DataFrame:
    """(i, j, ratio) of all pairs of rows of one group, i < j by ``seq``, of ratio ``threshold`` or more.

    :func:`near_classes` written out: quadratic in the copies of a text. Use classes and
    :func:`near_links` where copies are many.
    """
    members, pairs = near_classes(df, field, threshold, seq, group, block)
    left, right = members.select(F.col("cls").alias("a"), F.col("s").alias("p")), members.select(F.col("cls").alias("b"), F.col("s").alias("q"))
    crossed = pairs.join(left, "a").join(right, "b").withColumn("ratio", F.when(F.col("p") < F.col("q"), F.col("forward")).otherwise(F.col("backward"))).where("ratio is not null")
    equal = left.join(right.withColumnRenamed("b", "a"), "a").where("p < q").select("p", "q", F.lit(1.0))
    return crossed.select(F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j"), "ratio").union(equal)


def duplicate_classes(df: DataFrame, field: str = "answer", seq: str = "record_seq", group: str = "source_url") -> DataFrame:
    """(seq, class_first): rows whose near keys are equal in a group share the first one's seq."""
    rows = df.select(F.coalesce(F.col(group), F.lit("")).alias("g"), F.col(seq).cast("long").alias(seq), near_key(F.col(field)).alias("t"))
    firsts = rows.groupBy("g", "t").agg(F.min(seq).alias("class_first"))
    return rows.join(firsts, ["g", "t"]).select(seq, "class_first")


def semantic_dedup(df: DataFrame, field: str = "answer", threshold: float = ANSWER_THRESHOLD, seq: str = "record_seq", group: str = "source_url", dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(kept rows, reasons): of each near pair the row with the shorter raw text is dropped, the later one on a tie.

    reasons(seq, winner, ratio) has of each dropped row the pair of highest
    ratio, the first by (i, j) on a tie; a winner may itself be dropped. ``dry_run`` keeps all rows.

    Inside a class all rows but the first of the longest lose at ratio 1, the
    most there is, so of each class only that row can lose to another class.
    """
    members, pairs = near_classes(df, field, threshold, seq, group)
    pairs = cut(pairs)
    # numbers only, read again and again below; their texts are not
    rows = cut(members.join(df.select(F.col(seq).cast("long").alias("s"), F.length(F.coalesce(F.col(field), F.lit(""))).alias("n")), "s"))
    lengths = rows.groupBy("cls", "n").agg(F.min("s").alias("first"))
    best = lengths.groupBy("cls").agg(F.max(F.struct("n", (-F.col("first")).alias("back"))).alias("m")).select("cls", F.col("m.n").alias("n"), (-F.col("m.back")).alias("r"))
    losers = rows.join(best.select("cls", "r"), "cls").where("s <> r").select("cls", "s", "n")
    rivals = losers.join(lengths.select("cls", F.col("n").alias("m"), "first"), "cls")
    earlier = F.min(F.when((F.col("m") >= F.col("n")) & (F.col("first") < F.col("s")), F.col("first")))
    later = F.min(F.when(F.col("m") > F.col("n"), F.col("first")))
    own = rivals.groupBy("s").agg(F.coalesce(earlier, later).alias("winner")).select(F.col("s").alias("loser"), "winner", F.lit(1.0).alias("ratio"))

    def lost(of: str, to: str, before: str, after: str) -> DataFrame:
        x = pairs.join(best.select(F.col("cls").alias(of), "r", "n"), of).join(rows.select(F.col("cls").alias(to), F.col("s").alias("w"), F.col("n").alias("m")), to)
        e1 = F.min(F.when((F.col("w") < F.col("r")) & (F.col("m") >= F.col("n")) & F.col(before).isNotNull(), F.struct(before, "w")))
        e2 = F.min(F.when((F.col("w") > F.col("r")) & (F.col("m") > F.col("n")) & F.col(after).isNotNull(), F.struct(after, "w")))
        got = x.groupBy("a", "b", "r").agg(e1.alias("e1"), e2.alias("e2"))
        both = F.array_compact(F.array(F.struct(F.col(f"e1.{before}").alias("ratio"), F.col("e1.w").alias("winner")), F.struct(F.col(f"e2.{after}").alias("ratio"), F.col("e2.w").alias("winner"))))
        return got.select(F.col("r").alias("loser"), F.explode(both).alias("x")).where("x.winner is not null").select("loser", "x.winner", "x.ratio")

    # rows of a stand before rows of b at the forward ratio
    found = own.union(lost("b", "a", "forward", "backward")).union(lost("a", "b", "backward", "forward"))
    first = F.struct("ratio", -F.least("loser", "winner"), -F.greatest("loser", "winner"))
    reasons = found.groupBy("loser").agg(F.max_by(F.struct("winner", "ratio"), first).alias("m")).select(F.col("loser").alias(seq), F.col("m.winner").alias("winner"), F.round("m.ratio", 3).alias("ratio"))
    kept = df if dry_run else df.join(reasons.select(seq), seq, "left_anti")
    return kept, reasons
