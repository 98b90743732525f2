"""Greedy deduplication on two keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cribble.operators.lineage import cut


def greedy_two_key(df: DataFrame, order: str, k1: str, k2: str) -> DataFrame:
    """The rows kept when rows are taken by order and a row is skipped if an earlier kept row has its k1 or its k2.

    A skipped row occupies no key, so this isn't two dropDuplicates. Each round keeps the rows that are the first
    undecided of both their keys and drops the rows with a kept key; only aggregates per key are exchanged, never
    pairs. A null key conflicts with nothing. order must be unique.
    """
    left = cut(df.select(F.col(order).alias("o"), F.col(k1).alias("a"), F.col(k2).alias("b")))
    kept = None
    while not left.isEmpty():
        fa = left.where("a is not null").groupBy("a").agg(F.min("o").alias("fa"))
        fb = left.where("b is not null").groupBy("b").agg(F.min("o").alias("fb"))
        m = left.join(fa, "a", "left").join(fb, "b", "left")
        now = cut(m.where("(fa is null or fa = o) and (fb is null or fb = o)").select("o", "a", "b"))
        kept = now if kept is None else cut(kept.union(now))
        rest = left.join(now.select("o"), "o", "left_anti").join(now.where("a is not null").select("a").distinct(), "a", "left_anti")
        left = cut(rest.join(now.where("b is not null").select("b").distinct(), "b", "left_anti").select("o", "a", "b"))
    if kept is None:
        return df
    return df.join(kept.select(F.col("o").alias(order)), order, "left_semi")
