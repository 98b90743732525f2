"""Capping the records of dominant contributors at cutoffs found by parallel bisection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cribble.operators.lineage import cut

#: Midpoints that are counted in one round, for all contributors together.
PARTS = 64


def cutoffs(rows: DataFrame, need: DataFrame, key: str) -> DataFrame:
    """(who, cut, left): for each contributor the need-th least key, and how many rows with just that key are still due.

    rows: who, a numeric key. need: who, left (1 up to the number of the contributor's rows). Each round splits every
    contributor's bounds at 63 midpoints, counts the rows between them in one aggregation, and keeps the part with
    the cutoff, shrunk to the least and greatest key in it. No group is gathered; of each contributor at most 64
    counts meet in a task.
    """
    at = F.col(key)
    lo = cut(rows.join(need, "who").groupBy("who").agg(F.first("left").alias("left"), F.min(at).alias("lo"), F.max(at).alias("hi")))
    order = Window.partitionBy("who").orderBy("part")
    while not lo.where("lo < hi").isEmpty():
        open_ = lo.where("lo < hi")
        part = F.floor((at - F.col("lo")).cast("double") / (F.col("hi") - F.col("lo")).cast("double") * (PARTS - 1)).cast("int")
        n = rows.join(open_, "who").where(at.between(F.col("lo"), F.col("hi"))).withColumn("part", F.least(part, F.lit(PARTS - 1)))
        n = n.groupBy("who", "part").agg(F.first("left").alias("left"), F.count("*").alias("n"), F.min(at).alias("lo"), F.max(at).alias("hi"))
        n = n.withColumn("upto", F.sum("n").over(order)).where("upto >= left and upto - n < left")
        lo = cut(n.select("who", (F.col("left") - F.col("upto") + F.col("n")).alias("left"), "lo", "hi").unionByName(lo.where("not lo < hi")))
    return lo.select("who", F.col("lo").alias("cut"), "left")


def beyond_cap(records: DataFrame, cap: int) -> DataFrame:
    """(id): the records of each contributor after its best cap ones.

    records: id (unique), who, score. The greatest scores stay; null and NaN scores come last; ties by the smaller
    id. Rows with a null who belong to one contributor. An empty table gives an empty result.
    """
    score: Column = F.when(F.col("score").isNull() | F.isnan(F.col("score").cast("double")), F.lit(float("inf"))).otherwise(-F.col("score").cast("double"))
    r = records.select(F.col("id").cast("long").alias("id"), F.coalesce(F.col("who").cast("string"), F.lit("")).alias("who"), score.alias("key"))
    over = r.groupBy("who").agg(F.count("*").alias("n")).where(F.col("n") > cap)
    # an infinite key can't be interpolated: it becomes a value above all scores
    top = r.where(F.col("key") != float("inf")).agg(F.max("key")).first()[0]
    last = 1.0 if top is None else top + max(1.0, abs(top))
    r = r.join(over.select("who"), "who", "left_semi").withColumn("key", F.when(F.col("key") == float("inf"), F.lit(last)).otherwise(F.col("key")))
    r = cut(r)
    need = r.select("who").distinct().withColumn("left", F.lit(cap).cast("long"))
    by_score = cutoffs(r, need, "key")
    tied = r.join(by_score, "who").where(F.col("key") == F.col("cut")).select("who", "id")
    by_id = cutoffs(tied, by_score.select("who", "left"), "id").select("who", F.col("cut").alias("last_id"))
    out = r.join(by_score.select("who", "cut"), "who").join(by_id, "who")
    return out.where((F.col("key") > F.col("cut")) | ((F.col("key") == F.col("cut")) & (F.col("id") > F.col("last_id")))).select("id")


def share_cap(total: int, percent: int) -> int:
    """percent % of total, rounded down, at least 1."""
    return max(1, total * percent // 100)
