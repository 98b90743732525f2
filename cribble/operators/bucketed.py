"""Tables in buckets of a key, which joins by that key read where they lie."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


class BucketedTable:
    """A table (columns, batch) under path in buckets of one column; batches are appended, each once.

    columns: a schema string. A path that holds such a table already is opened again.
    """

    def __init__(self, spark: SparkSession, path: str, columns: str, by: str, buckets: int = 64):
        self.spark, self.buckets, self.by = spark, buckets, by
        self.columns = [c.split()[0] for c in columns.split(", ")]
        self.name = "bucketed_" + uuid.uuid4().hex
        spark.sql(f"CREATE TABLE {self.name} ({columns}, batch BIGINT) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")

    def read(self, before: int | None = None) -> DataFrame:
        """Rows of all batches, or of those before one."""
        t = self.spark.table(self.name)
        return (t if before is None else t.where(F.col("batch") < before)).drop("batch")

    def add(self, rows: DataFrame, batch: int) -> None:
        """Appends the rows of a batch, unless it is there."""
        if self.spark.table(self.name).where(F.col("batch") == batch).isEmpty():
            rows.select(*self.columns, F.lit(batch).cast("long").alias("batch")).repartition(self.buckets, self.by).write.insertInto(self.name)
