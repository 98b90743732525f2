"""Exports of accepted contents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cribble.functions.text import content_hash
from cribble.functions.urls import normalize_url
from cribble.operators.dedup import greedy_two_key


def merge_export(existing: DataFrame, added: DataFrame) -> DataFrame:
    """Result rows of a run joined to those exported before: existing first, a row skipped if an earlier kept one has its address or digest.

    existing, added: seq (order within each), title, content, date, url, source_domain. Nothing is ever removed.
    """
    both = existing.withColumn("part", F.lit(0)).unionByName(added.withColumn("part", F.lit(1)))
    both = both.withColumn("order", F.struct("part", "seq")).withColumn("k1", normalize_url(F.col("url"))).withColumn("k2", content_hash(F.col("title"), F.col("content")))
    return greedy_two_key(both, "order", "k1", "k2").drop("k1", "k2", "order")
