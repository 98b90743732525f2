"""Upserts and other table changes as DataFrame to DataFrame functions; keys with nulls never match."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_per_key(df: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """The first row of each key in the order given; the order needs a unique last part."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def last_wins(old: DataFrame, new: DataFrame, keys: list[str], version: str) -> DataFrame:
    """Rows of both by key; a key's row with the greatest version stays, new rows before old ones at a tie."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return first_per_key(both, keys, F.desc(version), F.desc("_new")).drop("_new")


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], *order: Column) -> DataFrame:
    """New rows whose key is not in old, the first of each key."""
    return first_per_key(new.join(old.select(*keys).distinct(), keys, "left_anti"), keys, *order)


def first_wins(old: DataFrame, new: DataFrame, key: str, seen: str, *order: Column) -> DataFrame:
    """(key, created, seen): the rows of old, touched by the latest sighting of new, and the first new row of each other key.

    A known key keeps its row; only the time of its last sighting moves, and never back.
    """
    latest = new.groupBy(key).agg(F.max(seen).alias("_seen"))
    kept = old.select(key, seen).join(latest, key, "left").select(key, F.lit(False).alias("created"), F.greatest(seen, "_seen").alias(seen))
    added = insert_ignore(old, new, [key], *order).select(key).join(latest, key).select(key, F.lit(True).alias("created"), F.col("_seen").alias(seen))
    return kept.unionByName(added)


def sync_set(old: DataFrame, new: DataFrame, keys: list[str], carried: list[str]) -> DataFrame:
    """The rows of new with the carried columns of old where the key is known; other rows of old go."""
    return new.join(old.select(*keys, *carried), keys, "left")


def delete_keys(df: DataFrame, keys: DataFrame) -> DataFrame:
    return df.join(keys.distinct(), keys.columns, "left_anti")


def matching(df: DataFrame, **equal) -> DataFrame:
    """Rows equal to every given value; None leaves a column out."""
    for name, value in equal.items():
        if value is not None:
            df = df.where(F.col(name) == value)
    return df


def get_or_create(old: DataFrame, new: DataFrame, keys: list[str], key: str) -> DataFrame:
    """(asked, id, already) for each new row: the id of the stored row with its keys, else that of the first new row with them.

    already tells whether the row was stored, or asked for before in the same batch.
    """
    stored = old.groupBy(*keys).agg(F.min(key).alias("_stored"))
    first = new.groupBy(*keys).agg(F.min(key).alias("_first"))
    j = new.join(first, keys).join(stored, keys, "left")
    return j.select(F.col(key).alias("asked"), F.coalesce("_stored", "_first").alias("id"), (F.col("_stored").isNotNull() | (F.col(key) > F.col("_first"))).alias("already"))


def update_rows(df: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """df with the columns that changes has besides the keys taken from it, in the rows whose keys it has; other rows stay."""
    cols = [c for c in changes.columns if c not in keys]
    c = changes.select(*keys, *[F.col(x).alias(f"_{x}") for x in cols], F.lit(True).alias("_hit"))
    j = df.join(c, keys, "left")
    return j.select(*[F.when(F.col("_hit"), F.col(f"_{x}")).otherwise(F.col(x)).alias(x) if x in cols else F.col(x) for x in df.columns])
