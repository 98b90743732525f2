"""Reading the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table of that name; columns and filters are pushed into its scan."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """df, a scan with projections, in as many tasks as the session has cores, if its files give fewer.

    Only a matter of layout: files of one or two row groups would keep all of a table's texts in one task. Tables of many
    files stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df._jdf.queryExecution().toRdd().getNumPartitions() < cores else df
