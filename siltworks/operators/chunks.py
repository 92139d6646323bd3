"""The chunk index: content-addressed merge, upsert, identity, nearest neighbours."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import chunk_id
from ..functions.vectors import cosine, l2


def merge_chunks(df: DataFrame, text: str, source: str, parent: str, order: list[Column]) -> DataFrame:
    """One row per chunk: chunk_id, text, sources, parent_text.

    Chunks with equal keys are one: text and parent are the first row's by
    ``order``, sources are the distinct pages in the order of their first row. Only
    (chunk, page) pairs are aggregated before sources are listed, so redelivered
    rows do not swell a list. Rows with a null text are dropped, null sources are no page.
    """
    rows = df.where(F.col(text).isNotNull()).select(chunk_id(F.col(text)).alias("chunk_id"), F.col(text).alias("text"), F.col(source).alias("source"), F.col(parent).alias("parent_text"), F.struct(*order).alias("ord"))
    pages = rows.groupBy("chunk_id", "source").agg(F.min("ord").alias("ord"), F.min_by(F.struct("text", "parent_text"), "ord").alias("v"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("source").isNotNull(), F.struct("ord", "source")))), lambda x: x["source"])
    return pages.groupBy("chunk_id").agg(F.min_by("v", "ord").alias("v"), listed.alias("sources")).select("chunk_id", "v.text", "sources", "v.parent_text")


def embed_new(chunks: DataFrame, known: DataFrame | None, embed: Callable[[list[str]], list[list[float]]]) -> DataFrame:
    """Chunks with ``embedding``: those in ``known`` keep theirs, only the others are embedded, batch by batch."""
    new = chunks if known is None else chunks.join(known.select("chunk_id"), "chunk_id", "left_anti")

    def run(batches):
        for b in batches:
            yield b.assign(embedding=list(embed(b["text"].tolist())))

    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new.schema.fields) + ", embedding array<float>"
    return new.mapInPandas(run, kind)


def upsert_chunks(existing: DataFrame, new: DataFrame) -> DataFrame:
    """Index after an upsert by chunk_id: known chunks keep text, parent and embedding and gain unseen sources, others are added."""
    a, b = existing.alias("a"), new.alias("b")
    both = a.join(b, F.col("a.chunk_id") == F.col("b.chunk_id"), "full_outer")
    cols = []
    for f in existing.columns:
        if f == "sources":
            empty = F.array().cast("array<string>")
            cols.append(F.array_union(F.coalesce("a.sources", empty), F.coalesce("b.sources", empty)).alias("sources"))
        else:
            theirs = F.col(f"b.{f}") if f in new.columns else F.lit(None)
            cols.append(F.when(F.col("a.chunk_id").isNotNull(), F.col(f"a.{f}")).otherwise(theirs).alias(f))
    return both.select(*cols)


def check_identity(recorded: dict | None, model: str, dim: int) -> dict:
    """The identity of an index; raises ValueError if the recorded model or dimension is another one."""
    if recorded:
        for k, v in (("embedding_model", model), ("embedding_dim", dim)):
            if recorded.get(k) is not None and recorded[k] != v:
                raise ValueError(f"index was built with {k}={recorded[k]!r}, not {v!r}")
    return {"embedding_model": model, "embedding_dim": dim}


def nearest(index: DataFrame, query: list[float], k: int = 5, vector: str = "embedding", key: str = "chunk_id") -> DataFrame:
    """The ``k`` rows nearest to one vector, with ``distance`` (squared L2), nearest first, ties by key. One scan, no shuffle of the index."""
    q = F.array(*[F.lit(float(x)) for x in query])
    return index.where(F.col(vector).isNotNull()).withColumn("distance", l2(F.col(vector), q)).orderBy("distance", key).limit(k)


def nearest_to_all(index: DataFrame, queries: DataFrame, k: int = 5, vector: str = "embedding", key: str = "vec_id", block: int = 512, max_queries: int = 100_000) -> DataFrame:
    """(query_id, key, distance, rank) of the ``k`` nearest rows of every query row.

    The query set is broadcast in full after its count was checked; the index is
    scanned once in matrix blocks, every task keeps k candidates per query, and one
    shuffle of these finds the k best. Distances are squared L2, ties go to the smaller key.
    """
    n = queries.count()
    if n > max_queries:
        raise ValueError(f"{n} queries exceed {max_queries}; pass them in parts")
    got = queries.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("q"), vector).toPandas()
    if got.empty:
        return queries.sparkSession.createDataFrame([], f"query_id long, {key} long, distance double, rank int")
    shared = queries.sparkSession.sparkContext.broadcast((got["q"].to_numpy(), np.stack([np.asarray(v, np.float64) for v in got[vector]])))

    def run(batches):
        ids, mat = shared.value
        for b in batches:
            m = np.stack([np.asarray(v, np.float64) for v in b["v"]]) if len(b) else np.zeros((0, mat.shape[1]))
            keys = b["k"].to_numpy()
            for at in range(0, len(ids), block):
                part = mat[at : at + block]
                d = np.maximum(0.0, (part**2).sum(1)[:, None] + (m**2).sum(1)[None] - 2 * part @ m.T)
                take = min(k, len(keys))
                if not take:
                    continue
                # all that tie with the k-th stay, so that the smaller key can win
                kth = np.partition(d, take - 1, axis=1)[:, take - 1]
                r, c = np.nonzero(d <= kth[:, None] * (1 + 1e-9) + 1e-12)
                exact = ((part[r] - m[c]) ** 2).sum(1)
                yield pd.DataFrame({"query_id": ids[at + r], "k": keys[c], "distance": exact})

    rows = index.where(F.col(vector).isNotNull()).select(F.col(key).cast("long").alias("k"), F.col(vector).alias("v"))
    cand = rows.mapInPandas(run, "query_id long, k long, distance double")
    ranked = cand.withColumn("rank", F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "k")))
    return ranked.where(F.col("rank") <= k).select("query_id", F.col("k").alias(key), "distance", "rank")


def top_units(units: DataFrame, page: str, vector: str, intent: list[float], k: int = 3, position: str = "position") -> DataFrame:
    """The ``k`` units of each page nearest to an intent by cosine, with ``score`` and ``chunk_index`` (the rank from 0), ties by position."""
    scored = units.withColumn("score", cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in intent])))
    rank = F.row_number().over(Window.partitionBy(page).orderBy(F.desc("score"), position))
    return scored.withColumn("chunk_index", rank - 1).where(F.col("chunk_index") < k)


def page_scores(chunks: DataFrame, page: str, vector: str, intent: list[float]) -> DataFrame:
    """(page, score): the best cosine of a page's chunks with an intent, 0 if it has none."""
    c = cosine(F.col(vector), F.array(*[F.lit(float(x)) for x in intent]))
    return chunks.groupBy(page).agg(F.coalesce(F.max(c), F.lit(0.0)).alias("score"))
