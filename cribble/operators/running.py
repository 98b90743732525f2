"""Running sums without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Rows that one range should hold.
RANGE = 4096


def running(df: DataFrame, keys: list[str], order: Column, spot: Column, value: str, out: str, tie: str | None = None) -> DataFrame:
    """out: the sum of value over the earlier rows of the same keys, in order (and then by tie).

    spot: a number that never falls in that order, with a bounded number of rows for each value (about RANGE). Sums
    run inside one spot; the totals of spots are summed in two further levels of 2048, so no window is larger than
    that for up to 2048 areas of a key.
    """
    d = df.withColumn("spot", spot)
    totals = d.groupBy(*keys, "spot").agg(F.sum(value).alias("part")).withColumn("area", F.shiftright("spot", 11))
    areas = totals.groupBy(*keys, "area").agg(F.sum("part").alias("whole"))
    before = lambda *part: Window.partitionBy(*part)
    rows = (Window.unboundedPreceding, -1)
    areas = areas.select(*keys, "area", F.coalesce(F.sum("whole").over(before(*keys).orderBy("area").rowsBetween(*rows)), F.lit(0)).alias("base"))
    totals = totals.withColumn("off", F.coalesce(F.sum("part").over(before(*keys, "area").orderBy("spot").rowsBetween(*rows)), F.lit(0))).join(areas, [*keys, "area"])
    totals = totals.select(*keys, "spot", (F.col("off") + F.col("base")).alias("base"))
    inner = before(*keys, "spot").orderBy(order, *([tie] if tie else [])).rowsBetween(*rows)
    d = d.withColumn("inner", F.coalesce(F.sum(value).over(inner), F.lit(0)))
    return d.join(totals, [*keys, "spot"]).withColumn(out, F.col("inner") + F.col("base")).drop("spot", "inner", "base")
