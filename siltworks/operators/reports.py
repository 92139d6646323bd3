"""Reports over records, scores and pages, as DataFrames and as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..checkpoints import cut
from ..functions.text import chunk_key
from .near_dup import ANSWER_THRESHOLD, QUESTION_THRESHOLD, near_classes, near_links

THRESHOLDS = tuple(k / 10 for k in range(1, 10))


def score_stats(scored: DataFrame, score: str = "relevance_score") -> DataFrame:
    """One row: count, min, max, mean, median, population stdev of the scores that are not null."""
    c = F.col(score)
    return scored.where(c.isNotNull()).agg(F.count("*").alias("n"), F.min(c).alias("lo"), F.max(c).alias("hi"), F.avg(c).alias("mean"), F.median(c).alias("median"), F.stddev_pop(c).alias("stdev"))


def threshold_sweep(scored: DataFrame, score: str = "relevance_score", thresholds: tuple[float, ...] = THRESHOLDS) -> DataFrame:
    """(threshold, skipped, total): pages below each candidate threshold, in one scan."""
    c = F.col(score)
    one = scored.where(c.isNotNull()).agg(F.count("*").alias("total"), *[F.count_if(c < t).alias(f"t{k}") for k, t in enumerate(thresholds)])
    pairs = F.array(*[F.struct(F.lit(t).alias("threshold"), F.col(f"t{k}").alias("skipped")) for k, t in enumerate(thresholds)])
    return one.select("total", F.explode(pairs).alias("p")).select("p.threshold", "p.skipped", "total")


def pairs_per_page(records: DataFrame) -> DataFrame:
    return records.groupBy(F.coalesce("source_url", F.lit("")).alias("source_url")).agg(F.count("*").alias("pairs"))


def scores_with_pairs(scored: DataFrame, records: DataFrame) -> DataFrame:
    """Scored pages with the number of their records, 0 if none."""
    return scored.join(pairs_per_page(records).withColumnRenamed("source_url", "url"), "url", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))


def redundancy_cause(a: str = "a", b: str = "b") -> Column:
    """Why two near-duplicate records of one page arose: same_chunk, adjacent_chunk or other."""
    x, y = (lambda f: F.col(f"{a}.{f}")), (lambda f: F.col(f"{b}.{f}"))
    return (
        F.when(~x("source_url").eqNullSafe(y("source_url")), "other")
        .when(x("source_chunk").eqNullSafe(y("source_chunk")), "same_chunk")
        .when(F.abs(x("chunk_index") - y("chunk_index")) == 1, "adjacent_chunk")
        .otherwise("other")
    )


def redundancy_by_cause(records: DataFrame, pairs: DataFrame, seq: str = "record_seq") -> DataFrame:
    """(cause, pairs) of near-duplicate pairs (i, j) of records."""
    side = records.select(F.col(seq).alias("s"), F.struct("source_url", F.xxhash64("source_chunk").alias("source_chunk"), "chunk_index").alias("v"))
    j = pairs.join(side.select(F.col("s").alias("i"), F.col("v").alias("a")), "i").join(side.select(F.col("s").alias("j"), F.col("v").alias("b")), "j")
    return j.groupBy(redundancy_cause().alias("cause")).agg(F.count("*").alias("pairs"))


def redundancy_of_classes(records: DataFrame, members: DataFrame, pairs: DataFrame, seq: str = "record_seq") -> DataFrame:
    """(cause, pairs) of near-duplicate pairs given as classes: members(s, cls) and pairs of classes.

    Pairs of one chunk and of adjacent chunks are counted by joins on chunk and
    place, all others by what is left of the products of class sizes, so copies are
    never written out. Only interleaved classes that are near in one order alone are.
    """
    place = records.select(F.col(seq).cast("long").alias("s"), F.coalesce("source_url", F.lit("")).alias("url"), F.xxhash64("source_chunk").alias("chunk"), F.col("chunk_index").cast("long").alias("at"))
    unit = cut(members.join(place, "s").groupBy("cls", "url", "chunk", "at").agg(F.count("*").alias("n")))
    size = unit.groupBy("cls").agg(F.sum("n").alias("n"))
    part = F.col("mixed") & (F.col("forward").isNull() | F.col("backward").isNull())
    both = cut(pairs.where(~part).select("a", "b").union(size.where("n > 1").select("cls", "cls")))
    named = lambda df, side: df.select(*[F.col(c).alias(f"{c}_{side}") if c not in ("url", "chunk") else F.col(c) for c in df.columns])
    product = F.when(F.col("a") == F.col("b"), F.col("n_a") * (F.col("n_a") - 1) / 2).otherwise(F.col("n_a") * F.col("n_b"))
    total = both.join(named(size, "a").withColumnRenamed("cls_a", "a"), "a").join(named(size, "b").withColumnRenamed("cls_b", "b"), "b").agg(F.sum(product).cast("long").alias("n"))
    chunk = unit.groupBy("cls", "url", "chunk").agg(F.sum("n").alias("n"))
    left = both.join(named(chunk, "a").withColumnRenamed("cls_a", "a"), "a")
    same = left.join(named(chunk, "b").withColumnRenamed("cls_b", "b"), ["b", "url", "chunk"]).agg(F.sum(product).cast("long").alias("n"))
    steps = unit.withColumn("step", F.explode(F.array(F.lit(1), F.lit(-1)))).withColumn("to", F.col("at") + F.col("step"))
    near = both.join(steps.select(F.col("cls").alias("a"), "url", F.col("chunk").alias("chunk_a"), F.col("n").alias("n_a"), "step", "to"), "a").join(unit.select(F.col("cls").alias("b"), "url", F.col("chunk").alias("chunk_b"), F.col("n").alias("n_b"), F.col("at").alias("to")), ["b", "url", "to"])
    beside = near.where("chunk_a <> chunk_b and (a <> b or step = 1)").agg(F.sum(F.col("n_a") * F.col("n_b")).cast("long").alias("n"))
    # what is neither of one chunk nor of adjacent ones is of other cause
    counts = total.select(F.lit("other").alias("cause"), F.col("n").alias("pairs")).union(same.selectExpr("stack(2, 'same_chunk', n, 'other', -n)")).union(beside.selectExpr("stack(2, 'adjacent_chunk', n, 'other', -n)"))
    side = lambda c, s: members.select(F.col("cls").alias(c), F.col("s").alias(s))
    written = pairs.where(part).join(side("a", "p"), "a").join(side("b", "q"), "b").where((F.col("p") < F.col("q")) == F.col("forward").isNotNull())
    few = redundancy_by_cause(records, written.select(F.least("p", "q").alias("i"), F.greatest("p", "q").alias("j")), seq)
    return counts.union(few).groupBy("cause").agg(F.sum("pairs").alias("pairs")).where("pairs > 0")


def dataset_report(records: DataFrame, seq: str = "record_seq", scored: DataFrame | None = None) -> dict:
    """Counts of a dataset. Near pairs of answers are found once and used for count and causes."""
    pages = pairs_per_page(records).agg(F.count("*").alias("pages"), F.sum("pairs").alias("total"), F.min("pairs").alias("least"), F.max("pairs").alias("most"), F.avg("pairs").alias("mean")).first()
    distinct = records.select(chunk_key(F.coalesce("question", F.lit(""))).alias("k")).distinct().count()
    members, pairs = near_classes(records, "answer", ANSWER_THRESHOLD, seq)
    causes = {r["cause"]: r["pairs"] for r in redundancy_of_classes(records, members, cut(pairs), seq).collect()}
    asked = near_links(*near_classes(records, "question", QUESTION_THRESHOLD, seq)).agg(F.sum("links")).first()[0] or 0
    out = {
        "total": pages["total"] or 0, "pages": pages["pages"], "least": pages["least"], "most": pages["most"], "mean": pages["mean"],
        "exact_duplicate_questions": (pages["total"] or 0) - distinct,
        "near_duplicate_questions": asked // 2,
        "near_duplicate_answers": sum(causes.values()),
        "causes": {c: causes.get(c, 0) for c in ("same_chunk", "adjacent_chunk", "other")},
    }
    if scored is not None:
        out["scores"] = [r.asDict() for r in scores_with_pairs(scored, records).orderBy(F.desc("relevance_score"), "url").toLocalIterator()]
    return out


def report_text(r: dict) -> str:
    """A dataset report for the console."""
    pages = f"{r['pages']} pages, {r['least']} to {r['most']} records each, {r['mean']:.1f} on average" if r["pages"] else "no pages"
    causes = ", ".join(f"{c} {n}" for c, n in r["causes"].items())
    lines = [
        f"records: {r['total']} on {pages}",
        f"questions asked before, word for word: {r['exact_duplicate_questions']}",
        f"near duplicates on one page: {r['near_duplicate_questions']} question pairs from {QUESTION_THRESHOLD}, {r['near_duplicate_answers']} answer pairs from {ANSWER_THRESHOLD}",
        f"answer pairs by cause: {causes}",
    ]
    return "\n".join([*lines, *(f"{s['relevance_score']:.4f} {s['status']:<16} {s['pairs']:>6} {s['url']}" for s in r.get("scores") or [])])


def score_report_text(scored: DataFrame) -> str:
    """Scores, their statistics and the threshold sweep for the console."""
    s = score_stats(scored).first()
    if not s["n"]:
        return "no page has a score"
    top = scored.where("relevance_score is not null").orderBy(F.desc("relevance_score"), "url").select("relevance_score", "status", "url")
    lines = [f"{s['n']} scored pages: {s['lo']:.4f} to {s['hi']:.4f}, mean {s['mean']:.4f}, median {s['median']:.4f}, deviation {s['stdev']:.4f}"]
    lines += [f"{r['relevance_score']:.4f} {r['status']:<16} {r['url']}" for r in top.toLocalIterator()]
    lines += [f"below {r['threshold']:.1f}: {r['skipped']} of {r['total']} ({100 * r['skipped'] / r['total']:.0f}%)" for r in threshold_sweep(scored).orderBy("threshold").collect()]
    return "\n".join(lines)


def results_text(rows: list) -> str:
    """Nearest-neighbour results for the console."""
    if not rows:
        return "nothing found"
    return "\n\n".join(f"{k}. distance {r['distance']:.4f}, from {', '.join(r['sources'])}\n{r['text']}\nin: {r['parent_text']}" for k, r in enumerate(rows, 1))
