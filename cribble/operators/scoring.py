"""Scores that fade with time, survival rates with fallbacks, budgets."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

HALF_LIFE_DAYS, NEUTRAL = 14.0, 0.5


def decay(ts: Column, now: datetime) -> Column:
    """0.5 to the power of age over half-life; no age below 0; 0 for an unknown time."""
    age = (F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))) / 86_400_000_000.0
    return F.when(ts.isNull(), F.lit(0.0)).otherwise(F.pow(F.lit(0.5), F.greatest(age, F.lit(0.0)) / HALF_LIFE_DAYS))


def faded_mean(events: DataFrame, key: str, now: datetime) -> DataFrame:
    """(key, score): the mean of value weighted by decay of ts."""
    w = events.select(key, decay(F.col("ts"), now).alias("w"), "value")
    return w.groupBy(key).agg(F.coalesce(F.try_divide(F.sum(F.col("w") * F.col("value")), F.sum("w")), F.lit(NEUTRAL)).alias("score"))


def leading_streak(events: DataFrame, key: str, last: int = 5) -> DataFrame:
    """(key, streak): failures since the latest success, among the last events by ts and id (latest first)."""
    rn = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("ts"), F.desc("id")))
    few = events.withColumn("rn", rn).where(F.col("rn") <= last)
    return few.groupBy(key).agg(F.coalesce(F.min(F.when(F.col("ok"), F.col("rn"))) - 1, F.count("*")).cast("int").alias("streak"))


def survival(events: DataFrame, least: int = 30) -> DataFrame:
    """(lv2, type, provider, rate, tier): accepted share of the first of three levels with enough samples.

    events: lv2, type, provider, ok. All levels come from one aggregation with grouping sets.
    """
    g = events.groupingSets([["lv2", "type", "provider"], ["lv2", "provider"], ["provider"]], "lv2", "type", "provider")
    g = g.agg(F.grouping_id().alias("g"), F.count("*").alias("n"), F.sum(F.col("ok").cast("int")).alias("k"))
    level = lambda bits, cols, tag: g.where(F.col("g") == bits).select(*cols, F.col("n").alias(f"n{tag}"), F.col("k").alias(f"k{tag}"))
    j = level(0, ["lv2", "type", "provider"], 1).join(level(2, ["lv2", "provider"], 2), ["lv2", "provider"], "left").join(level(6, ["provider"], 3), ["provider"], "left")
    tier = F.when(F.col("n1") >= least, 1).when(F.col("n2") >= least, 2).when(F.col("n3") >= least, 3)
    rate = F.when(tier == 1, F.col("k1") / F.col("n1")).when(tier == 2, F.col("k2") / F.col("n2")).when(tier == 3, F.col("k3") / F.col("n3"))
    return j.select("lv2", "type", "provider", rate.alias("rate"), tier.alias("tier"))


def multiplier(rate: Column, initial: float = 2.0) -> Column:
    """1.1 over the rate (at least 0.25), between 1.1 and 4; initial where there is no rate."""
    m = F.least(F.greatest(F.lit(1.1) / F.greatest(rate, F.lit(0.25)), F.lit(1.1)), F.lit(4.0))
    return F.coalesce(m, F.lit(initial))


def rate(part: Column, whole: Column) -> Column:
    """part / whole, null where whole is 0."""
    return F.try_divide(part, whole)


def latest_score(scores: DataFrame) -> DataFrame:
    """(content_id, score): overall of the latest scoring within 1 to 5, by scored_at, run, taxonomy and type.

    Null, NaN and other values are left out; of scorings with the same key the greatest overall is taken.
    """
    ok = scores.where(F.col("overall").between(1.0, 5.0) & ~F.isnan("overall"))
    key = F.struct("scored_at", "run_id", "taxonomy_lv2", "type_name", "overall")
    return ok.groupBy("content_id").agg(F.max(key)["overall"].alias("score"))
