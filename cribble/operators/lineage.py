"""Cutting lineage through the folder that the whole cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

KEY = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir.

    Where the session names none, a temporary folder is made only on one machine, as in tests; a cluster must name one.
    """
    sc = spark.sparkContext
    told = sc.getConf().get(KEY) or spark.conf.get(KEY, None)
    if not told:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(f"set {KEY} to a folder that the whole cluster shares")
        told = "file://" + tempfile.mkdtemp(prefix="cribble-")
        spark.conf.set(KEY, told)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(told)
    return told


def cut(df: DataFrame) -> DataFrame:
    """df with its rows written to the shared folder and its lineage dropped.

    The files survive the loss of executors.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_table(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder for a table that a caller writes."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
