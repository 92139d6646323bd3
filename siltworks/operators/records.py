"""Canonical question-answer records: validation, deduplication, splits, projections."""

from __future__ import annotations

import random
from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import chunk_key
from ..functions.urls import strip

FIELDS = ("question", "answer", "source_chunk", "chunk_index", "source_url", "section", "page_title", "generation_model", "extraction_strategy", "timestamp", "crawl_date", "license_signal")
SCHEMA = T.StructType([T.StructField(f, T.IntegerType() if f == "chunk_index" else T.StringType()) for f in FIELDS])
"""The twelve fields of a record; times stay ISO-8601 text."""

def _strip(c: Column) -> Column:
    return strip(F.coalesce(c, F.lit("")))


def canonical(df: DataFrame) -> DataFrame:
    """The twelve fields in order with their types; missing ones are null, others are dropped."""
    return df.select(*[(F.col(f) if f in df.columns else F.lit(None)).cast(SCHEMA[f].dataType).alias(f) for f in FIELDS])


def with_reasons(df: DataFrame, least: int = 20) -> DataFrame:
    """df with ``_reject_reason``: empty_answer, question_equals_answer or answer_too_short, the first that holds, else null.

    Question and answer are compared without outer white space, null as empty,
    in any case; the values themselves stay as they are.
    """
    q, a = _strip(F.col("question")), _strip(F.col("answer"))
    reason = F.when(a == "", "empty_answer").when(F.lower(q) == F.lower(a), "question_equals_answer").when(F.length(a) < least, "answer_too_short")
    return df.withColumn("_reject_reason", reason)


def validate(df: DataFrame, least: int = 20) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); rejected rows carry their reason."""
    marked = with_reasons(df, least)
    return marked.where("_reject_reason is null").drop("_reject_reason"), marked.where("_reject_reason is not null")


def first_by(df: DataFrame, key: Column, order: list[Column]) -> DataFrame:
    """The first row of each key; a null key is a key of its own.

    Rows are reduced to (key, order) before any shuffle by an aggregate, so a key
    that holds a third of all rows costs one row per task.
    """
    marked = df.withColumn("_key", key).withColumn("_rank", F.struct(*order))
    best = marked.groupBy("_key").agg(F.min("_rank").alias("_best"))
    kept = marked.join(best.select(F.col("_key").alias("_k"), "_best"), marked["_key"].eqNullSafe(F.col("_k")) & (F.col("_rank") == F.col("_best")))
    return kept.drop("_key", "_rank", "_k", "_best").dropDuplicates([c for c in df.columns if not isinstance(df.schema[c].dataType, T.MapType)])


def dedup_by_question(df: DataFrame, order: list[Column]) -> DataFrame:
    """The first record of each question, compared by its chunk key; a missing question is the empty one.

    ``order`` must tell all rows apart; rows equal in every column count once.
    """
    return first_by(df, chunk_key(F.coalesce("question", F.lit(""))), order)


def to_raw_text(df: DataFrame, order: list[Column]) -> DataFrame:
    """Distinct non-empty source chunks as ``text``, the first spelling of each."""
    rows = df.where(F.col("source_chunk").isNotNull() & (F.col("source_chunk") != ""))
    key = chunk_key(F.col("source_chunk"))
    return rows.groupBy(key.alias("_k")).agg(F.min_by("source_chunk", F.struct(*order)).alias("text")).select("text")


def split_groups(df: DataFrame, by: str = "source_url", ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """(group, split) of all groups: sorted, shuffled by a seeded Mersenne twister, cut at rounded shares.

    The shuffle is defined on a list in one place, so group names (not rows) go
    to the driver; for corpora with more groups than a driver holds use
    :func:`hash_split`. Null and empty groups are ``unknown``.
    """
    spark = df.sparkSession
    name = F.coalesce(F.nullif(F.col(by), F.lit("")), F.lit("unknown"))
    groups = [r[0] for r in df.select(name.alias("g")).distinct().orderBy("g").collect()]
    random.Random(seed).shuffle(groups)
    a = round(len(groups) * ratios[0])
    b = a + round(len(groups) * ratios[1])
    rows = [(g, "train" if i < a else "validation" if i < b else "test") for i, g in enumerate(groups)]
    return spark.createDataFrame(rows, "grp string, split string")


def split_records(df: DataFrame, by: str = "source_url", ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """df with ``split``: all rows of a group in one split."""
    name = F.coalesce(F.nullif(F.col(by), F.lit("")), F.lit("unknown"))
    return df.withColumn("grp", name).join(split_groups(df, by, ratios, seed), "grp").drop("grp")


def hash_split(df: DataFrame, by: str = "source_url", ratios: tuple[float, float, float] = (0.8, 0.1, 0.1), seed: int = 42) -> DataFrame:
    """df with ``split`` by a hash of the group: no shuffle, no driver, shares hold in expectation."""
    name = F.coalesce(F.nullif(F.col(by), F.lit("")), F.lit("unknown"))
    u = F.conv(F.substring(F.sha2(F.concat_ws("\u0001", F.lit(str(seed)), name), 256), 1, 8), 16, 10).cast("long") / F.lit(float(1 << 32))
    return df.withColumn("split", F.when(u < ratios[0], "train").when(u < ratios[0] + ratios[1], "validation").otherwise("test"))


# --- projections ---------------------------------------------------------------


def _chat() -> list[Column]:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.col(c).alias("content"))
    return [F.array(turn("user", "question"), turn("assistant", "answer")).alias("messages")]


def _vertex() -> list[Column]:
    turn = lambda role, c: F.struct(F.lit(role).alias("role"), F.array(F.struct(F.col(c).alias("text"))).alias("parts"))
    return [F.array(turn("user", "question"), turn("model", "answer")).alias("contents")]


def _named(**pairs: str) -> Callable[[], list[Column]]:
    return lambda: [F.col(c).alias(n) if c else F.lit("").alias(n) for n, c in pairs.items()]


PROJECTIONS: Mapping[str, Callable[[], list[Column]]] = {
    "conversational": _chat,
    "alpaca": _named(instruction="question", input="", output="answer"),
    "prompt_completion": _named(prompt="question", completion="answer"),
    "embedding_pairs": _named(anchor="question", positive="source_chunk"),
    "rag_eval": _named(question="question", ground_truth_answer="answer", context="source_chunk"),
    "openai_finetune": _chat,
    "vertex": _vertex,
}
BATCH_PROJECTIONS = ("raw_text", "triplets")
UNSUPPORTED = {
    "dpo": "needs a rejected answer per record, which the records do not hold",
    "orpo": "needs a rejected answer per record, which the records do not hold",
    "kto": "needs a desirability label per record, which the records do not hold",
    "classification": "needs class labels, which the records do not hold",
}


def project(df: DataFrame, schema: str) -> DataFrame:
    """Records in the shape of a training schema; other columns are dropped."""
    if schema in UNSUPPORTED:
        raise ValueError(f"schema {schema!r} is not supported: {UNSUPPORTED[schema]}")
    if schema not in PROJECTIONS:
        raise ValueError(f"unknown schema {schema!r}; known: {sorted([*PROJECTIONS, *BATCH_PROJECTIONS])}")
    return df.select(*PROJECTIONS[schema]())


def mine_triplets(df: DataFrame, order: list[Column], seed: int = 42, shelves: int = 64) -> DataFrame:
    """(anchor, positive, negative): the negative is a chunk of another page, drawn by a hash of the record.

    Chunks are weighted by their records. All records are numbered by page, so the
    other pages' records are all numbers outside the page's own range: the
    negative is a number drawn from there, fetched by one equi-join. Records
    without any other page give no row. A page's records are dealt by hash over
    ``shelves`` that are numbered one after the other from their counts, so neither all records nor
    those of a crowded page are sorted in one task.
    """
    rows = df.where(F.col("source_url").isNotNull()).withColumn("_ord", F.struct(*order)).withColumn("_shelf", F.pmod(F.xxhash64(F.to_json("_ord")), F.lit(shelves)))
    sizes = rows.groupBy("source_url", "_shelf").agg(F.count("*").alias("k"))
    # running totals over ranges of pages: totals per range first, then inside each range
    spread = sizes.withColumn("_part", F.pmod(F.xxhash64("source_url"), F.lit(512)))
    inner = spread.withColumn("_in", F.sum("k").over(Window.partitionBy("_part").orderBy("source_url", "_shelf").rowsBetween(Window.unboundedPreceding, -1)))
    parts = spread.groupBy("_part").agg(F.sum("k").alias("pn"))
    before = parts.withColumn("_before", F.coalesce(F.sum("pn").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("pn")
    total = parts.agg(F.sum("pn").alias("total"))
    shelf = inner.join(F.broadcast(before), "_part").select("source_url", "_shelf", "k", (F.col("_before") + F.coalesce("_in", F.lit(0))).alias("first"))
    page = Window.partitionBy("source_url")
    starts = shelf.select("source_url", "_shelf", "first", F.min("first").over(page).alias("start"), F.sum("k").over(page).alias("n"))
    place = F.row_number().over(Window.partitionBy("source_url", "_shelf").orderBy("_ord")) - 1
    numbered = rows.withColumn("_at", place).join(starts, ["source_url", "_shelf"]).crossJoin(F.broadcast(total))
    draw = F.pmod(F.xxhash64(F.lit(seed), F.to_json("_ord")), F.greatest(F.col("total") - F.col("n"), F.lit(1)))
    asked = numbered.where("total > n").withColumn("_want", F.when(draw < F.col("start"), draw).otherwise(draw + F.col("n")))
    pool = numbered.select((F.col("first") + F.col("_at")).alias("_want"), F.col("source_chunk").alias("negative"))
    return asked.join(pool, "_want").select(F.col("question").alias("anchor"), F.col("source_chunk").alias("positive"), "negative")
