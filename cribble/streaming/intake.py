"""Candidates as a stream: what the batch functions do, in micro-batches. This goes beyond the reference, which has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cribble.functions.text import content_hash
from cribble.functions.urls import normalize_url
from cribble.operators.bucketed import BucketedTable
from cribble.operators.lineage import cut
from cribble.operators.store import insert_ignore

SCHEMA = "incoming_id long, batch_no int, title string, content string, canonical_url string, source_domain string, collected_at timestamp"


def candidates(spark: SparkSession, folder: str, lateness: str = "30 days") -> DataFrame:
    """The stream of records that arrive as files, each address once within the lateness allowed."""
    s = spark.readStream.schema(SCHEMA).parquet(folder).withColumn("url", normalize_url(F.col("canonical_url")))
    return s.withWatermark("collected_at", lateness).dropDuplicatesWithinWatermark(["url"])


def store_new(spark: SparkSession, table: str):
    """A function for foreachBatch: appends the records whose address and digest the table doesn't hold yet.

    Addresses and digests are kept apart in buckets, so a micro-batch is joined to them where they lie and reads no text.
    Each micro-batch goes to a folder by its number, so a batch that runs twice after a failure leaves one copy. What
    can't be read is an error, never an empty store.
    """
    urls = BucketedTable(spark, f"{table}-urls", "url STRING", "url")
    digests = BucketedTable(spark, f"{table}-digests", "digest STRING", "digest")

    def run(batch: DataFrame, number: int) -> None:
        new = batch.withColumn("digest", content_hash(F.col("title"), F.col("content"))).select("incoming_id", "url", "digest", "title", "content", "collected_at")
        new = insert_ignore(urls.read(number), new, ["url"], F.col("incoming_id"))
        new = cut(insert_ignore(digests.read(number), new, ["digest"], F.col("incoming_id")))
        new.write.mode("overwrite").parquet(f"{table}/batch={number}")
        urls.add(new.select("url"), number)
        digests.add(new.select("digest"), number)

    return run
