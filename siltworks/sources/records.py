"""Reading and writing records as JSON lines, exactly-once appends, single named files."""

from __future__ import annotations

import json
import os
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..checkpoints import cut
from ..operators.records import SCHEMA


def read_records(spark: SparkSession, path: str | list[str], schema: T.StructType = SCHEMA) -> DataFrame:
    """Records of JSON-lines files in an explicit schema; blank lines are skipped, a malformed line fails the query."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_records_in_order(spark: SparkSession, path: str | list[str], schema: T.StructType = SCHEMA) -> DataFrame:
    """Records with ``record_seq``, growing in file order. A malformed line fails the query; blank lines are skipped.

    The number is made of file and position in it, so keep-first operators follow
    the order in which records were written.
    """
    text = spark.read.text(path).withColumn("record_seq", F.monotonically_increasing_id()).where(F.trim("value") != "")
    row = F.from_json("value", schema, {"mode": "FAILFAST"})
    return text.select("record_seq", row.alias("r")).select("record_seq", "r.*")


def written_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct source_urls already written; malformed lines and missing urls are skipped, a missing path has none."""
    kind = T.StructType([T.StructField("source_url", T.StringType()), T.StructField("_bad", T.StringType())])
    empty = spark.createDataFrame([], "source_url string")
    try:
        lines = spark.read.schema(kind).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    except Exception as e:  # a sink that was never written
        if "PATH_NOT_FOUND" in str(e):
            return empty
        raise
    return lines.where("source_url is not null").select("source_url").distinct()


def _data_files(spark: SparkSession, path: str) -> list[str]:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    return [s.getPath().toString() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName()[0] not in "_."]


def known_urls(spark: SparkSession, path: str) -> DataFrame:
    """Distinct source_urls of a sink, from a narrow table beside it that lists the urls of each file.

    Only files that the table lacks are read, and then listed, so the cost of a batch does not
    grow with the sink's records. A crash between a write and its listing is mended by the next call.
    """
    table = f"{path.rstrip('/')}.urls"
    listed = spark.read.schema("source_url string, file string").parquet(table) if _data_files(spark, table) else spark.createDataFrame([], "source_url string, file string")
    name = F.element_at(F.split("file", "/"), -1)
    have = {r[0] for r in listed.select(name).distinct().collect()}
    new = [f for f in _data_files(spark, path) if f.rsplit("/", 1)[-1] not in have]
    if new:
        kind = T.StructType([T.StructField("source_url", T.StringType()), T.StructField("_bad", T.StringType())])
        lines = spark.read.schema(kind).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(new)
        found = lines.select("source_url", F.input_file_name().alias("file")).where("source_url is not null").distinct()
        # a file without any url is listed too
        found.union(spark.createDataFrame([(None, f) for f in new], "source_url string, file string")).write.mode("append").parquet(table)
        listed = spark.read.schema("source_url string, file string").parquet(table)
    return listed.where("source_url is not null").select("source_url").distinct()


def append_new_pages(spark: SparkSession, records: DataFrame, path: str) -> DataFrame:
    """Append the records of pages that the sink lacks; returns these records. Null urls are never known.

    A page is written once however often it is delivered, which makes retried batches harmless.
    """
    fresh = records.join(known_urls(spark, path), "source_url", "left_anti").select(*records.columns)
    # written first elsewhere: a cached plan would be made again, now without the rows, once its sink has changed
    fresh = cut(fresh)
    fresh.write.mode("append").json(path)
    return fresh


def write_batch(spark: SparkSession, records: DataFrame, path: str, chunks: DataFrame | None = None, upsert: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """One batch: the records of new pages appended, then the chunks of the batch upserted; returns the new records.

    Both steps may be repeated: known pages are not written again, and an upsert
    of known chunks changes nothing, so a batch that failed between them is delivered again whole.
    """
    fresh = append_new_pages(spark, records, path)
    if chunks is not None and upsert is not None:
        upsert(chunks)
    return fresh


def write_parts(df: DataFrame, path: str, by: str | None = None) -> None:
    """JSON lines written by the tasks into a folder, nulls included; one folder a value of ``by`` if given."""
    w = df.write.mode("overwrite").option("ignoreNullFields", "false")
    (w.partitionBy(by) if by else w).json(path)


def write_lines(df: DataFrame, path: str) -> int:
    """One JSON-lines file of exactly this name on the driver's file system, in the rows' order; the number of rows.

    For deliverables whose name a framework fixes. Rows are streamed partition by
    partition, never collected; use ``df.write.json`` for data that stays in the cluster.
    """
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        for row in df.toLocalIterator(prefetchPartitions=True):
            f.write(json.dumps(row.asDict(recursive=True), ensure_ascii=False) + "\n")
            n += 1
    return n


def write_array(df: DataFrame, path: str) -> int:
    """One JSON array file, streamed like :func:`write_lines`."""
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    n = 0
    with open(path, "w", encoding="utf-8") as f:
        f.write("[")
        for row in df.toLocalIterator(prefetchPartitions=True):
            f.write((",\n  " if n else "\n  ") + json.dumps(row.asDict(recursive=True), ensure_ascii=False))
            n += 1
        f.write("\n]" if n else "]")
    return n


def write_json(value: dict | Iterable, path: str) -> None:
    os.makedirs(os.path.dirname(os.path.abspath(path)), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        json.dump(value, f, indent=2, ensure_ascii=False)
