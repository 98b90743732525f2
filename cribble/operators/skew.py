"""Joins whose keys may be held by a large part of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

#: Keys with more than a HOT-th of all rows are broadcast; there are fewer than HOT of them.
HOT = 5000


def split_join(rows: DataFrame, small: DataFrame, keys: list[str], weight: str = "n") -> DataFrame:
    """rows joined with small by keys, without any key's rows meeting in one task.

    small: unique keys, and in weight the number of rows of each key in a table that holds at least all of rows. Keys
    above a HOT-th of the sum of the weights are joined by broadcast, the others by a sort-merge join.
    """
    total = small.agg(F.sum(weight)).first()[0] or 0
    bound = max(1, total // HOT)
    hot = F.broadcast(small.where(F.col(weight) > bound).withColumn("_hot", F.lit(True)))
    marked = rows.join(hot, keys, "left")
    cold = marked.where("_hot is null").select(*rows.columns).join(small.where(F.col(weight) <= bound).hint("merge"), keys)
    cols = [*rows.columns, *(c for c in small.columns if c not in keys)]
    return marked.where("_hot").select(*cols).unionByName(cold.select(*cols))
