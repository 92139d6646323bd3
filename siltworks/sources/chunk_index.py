"""A stored chunk index: snapshots of chunks beside the identity of the embedding they were made with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..operators.chunks import check_identity, embed_new, nearest, upsert_chunks
from .snapshots import open_snapshot, save_snapshot

CHUNKS = "chunk_id string, text string, sources array<string>, parent_text string, embedding array<float>"
_IDENTITY = "embedding_model string, embedding_dim int"
Embed = Callable[[list[str]], list[list[float]]]


def identity(spark: SparkSession, path: str) -> dict | None:
    """The model and dimension that an index was built with; null for one that was never written."""
    row = open_snapshot(spark, f"{path}/identity", _IDENTITY).first()
    return row.asDict() if row else None


def open_index(spark: SparkSession, path: str, model: str, dim: int) -> DataFrame:
    """The chunks of an index; ValueError if it was built with another model or dimension."""
    check_identity(identity(spark, path), model, dim)
    return open_snapshot(spark, f"{path}/chunks", CHUNKS)


def upsert(chunks: DataFrame, path: str, embed: Embed, model: str, dim: int) -> DataFrame:
    """Index after an upsert of merged chunks(chunk_id, text, sources, parent_text): only unknown ones are embedded."""
    spark = chunks.sparkSession
    known = open_index(spark, path, model, dim)
    if identity(spark, path) is None:
        # recorded before any vector, so that no vector is ever without it
        save_snapshot(spark.createDataFrame([(model, dim)], _IDENTITY), f"{path}/identity")
    new = embed_new(chunks, known, embed)
    met = chunks.join(known.select("chunk_id"), "chunk_id", "left_semi")
    return save_snapshot(upsert_chunks(known, new.unionByName(met, allowMissingColumns=True)), f"{path}/chunks")


def query_text(spark: SparkSession, path: str, text: str, embed: Embed, model: str, k: int = 5) -> DataFrame:
    """The ``k`` chunks nearest to a text, with parent text, sources and distance, nearest first."""
    vector = [float(x) for x in embed([text])[0]]
    return nearest(open_index(spark, path, model, len(vector)), vector, k)
