"""Tables that are replaced as a whole: numbered parquet snapshots in one folder, the last complete one counts."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete snapshots, ascending; a snapshot is complete once its job has committed."""
    fs, p = _folder(spark, path)
    if not fs.exists(p):
        return []
    found = []
    for s in fs.listStatus(p):
        m = re.fullmatch(r"v(\d{8})", s.getPath().getName())
        if m and fs.exists(spark._jvm.org.apache.hadoop.fs.Path(s.getPath(), "_SUCCESS")):
            found.append(int(m[1]))
    return sorted(found)


def open_snapshot(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """The last complete snapshot; an empty table where none was written."""
    have = versions(spark, path)
    return spark.read.schema(schema).parquet(f"{path}/v{have[-1]:08d}") if have else spark.createDataFrame([], schema)


def save_snapshot(df: DataFrame, path: str, keep: int = 2) -> DataFrame:
    """Write the next snapshot, drop all but the last ``keep``, and return the written rows.

    A plan that reads the snapshot before stays valid while it is kept, so one step
    may read the last and write the next. A crash leaves the last complete one.
    """
    if keep < 2:
        raise ValueError("the snapshot that is read must be kept")
    spark = df.sparkSession
    have = versions(spark, path)
    to = f"{path}/v{(have[-1] + 1 if have else 0):08d}"
    df.write.mode("overwrite").parquet(to)
    fs, p = _folder(spark, path)
    for old in have[: max(0, len(have) + 1 - keep)]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p, f"v{old:08d}"), True)
    return spark.read.schema(df.schema).parquet(to)
