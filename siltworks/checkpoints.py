"""Cutting lineage in the folder that all executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a local master may leave it
    unset, as in tests: a temporary folder of this machine is used then. Elsewhere executors
    could not share such a folder, and RuntimeError is raised.
    """
    sc = spark.sparkContext
    have = sc._jsc.sc().getCheckpointDir()
    if have.isDefined():
        return have.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not sc.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="siltworks-"))
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """An eager reliable checkpoint: the rows survive the loss of executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
