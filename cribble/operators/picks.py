"""Lookups with a fallback and picks of one among several."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from cribble.functions.urls import is_blocked


def lookup(rows: DataFrame, entries: DataFrame) -> DataFrame:
    """rows (own, type, ...) with lv2 and way: exact where (own, type) is an entry, unique_name where only one entry has the type, else null.

    entries: (lv2, type), distinct.
    """
    exact = entries.select(F.col("lv2").alias("own"), "type", F.lit(True).alias("_exact"))
    only = entries.groupBy("type").agg(F.min("lv2").alias("_only"), F.count("*").alias("_n")).where("_n = 1").drop("_n")
    j = rows.join(exact, ["own", "type"], "left").join(only, "type", "left")
    way = F.when(F.col("_exact"), "exact").when(F.col("_only").isNotNull(), "unique_name")
    return j.withColumn("lv2", F.when(F.col("_exact"), F.col("own")).otherwise(F.col("_only"))).withColumn("way", way).drop("_exact", "_only")


def allowed(types: DataFrame, scoped: DataFrame, flat: DataFrame, blocked: list[str]) -> DataFrame:
    """(lv2, type, allowed, any_domain): the domains of (lv2, type) in scoped, of type in flat where scoped has no entry, without blocked ones.

    The lists are settings, of some domains a type.
    """
    free = lambda t: F.array_sort(F.collect_set(F.when(~is_blocked(F.col("domain"), blocked), F.col("domain"))))
    own = scoped.groupBy("lv2", "type").agg(free(scoped).alias("own"))
    every = flat.groupBy("type").agg(free(flat).alias("flat"))
    j = types.join(own, ["lv2", "type"], "left").join(every, "type", "left")
    a = F.coalesce("own", "flat", F.array().cast("array<string>"))
    return j.select("lv2", "type", a.alias("allowed"), (F.size(a) > 0).alias("any_domain"))


def _first(df: DataFrame, *order: Column) -> DataFrame:
    return df.withColumn("_k", F.row_number().over(Window.partitionBy("type_name").orderBy(*order))).where("_k = 1").drop("_k")


def best_bundle(bundles: DataFrame, epsilon: float = 0.0, seed: int = 0) -> DataFrame:
    """The bundle of each type with the best score, then one never used, then the one used longest ago, then the first.

    bundles: type_name, bundle, score, last_used_at, one row a bundle. With epsilon, a type whose scores differ takes any
    of its bundles with that probability, by a hash of the seed, so that low scores are tried again.
    """
    order = (F.desc(F.round("score", 9)), F.asc_nulls_first("last_used_at"), F.asc("bundle"))
    if not epsilon:
        return _first(bundles, *order)
    draw = lambda *c: F.pmod(F.xxhash64(F.lit(seed), *c), F.lit(1_000_000)) / 1e6
    differ = bundles.groupBy("type_name").agg((F.countDistinct(F.round("score", 6)) > 1).alias("_differ"))
    b = bundles.join(differ, "type_name").withColumn("_free", F.col("_differ") & (draw("type_name") < epsilon))
    return _first(b, F.when(F.col("_free"), draw("type_name", "bundle")).asc_nulls_first(), *order).drop("_free", "_differ")


def oldest_bundle(bundles: DataFrame) -> DataFrame:
    """The bundle of each type that was never used, else the one used longest ago, the first of equals."""
    return _first(bundles, F.asc_nulls_first("last_used_at"), F.asc("bundle"))


def explored(queries: list[tuple], epsilon: float, rng) -> list:
    """Queries [(item, score)] by score; with probability epsilon a slot goes to any of those left. Scores equal to six places keep their order."""
    left = list(queries)
    if len({round(s, 6) for _, s in left}) <= 1:
        return [q for q, _ in left]
    out = []
    while left:
        at = rng.randrange(len(left)) if len(left) > 1 and rng.random() < epsilon else max(range(len(left)), key=lambda i: left[i][1])
        out.append(left.pop(at)[0])
    return out


def typed_lines(lines: Column) -> Column:
    """Lines trimmed, without blank ones, distinct and sorted."""
    return F.array_sort(F.array_distinct(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != "")))


def tree(types: DataFrame) -> DataFrame:
    """(lv1, groups, types): groups and types of the first level in the order of at. types: lv1, lv2, type, at; a configuration table."""
    of = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("at", c))), lambda x: x[c])
    g = types.groupBy("lv1", "lv2").agg(F.min("at").alias("first"), of("type").alias("types")).withColumnRenamed("first", "at")
    return g.groupBy("lv1").agg(of("lv2").alias("groups"), F.flatten(of("types")).alias("types"))
