"""The most similar earlier class of each class, exactly.

At a similarity of 0.15 nearly every word of a text may lead to its partner, so no prefix, band or segment narrows the
search: every pair of classes with a common word is counted. Classes are cut into blocks by id; a task holds the word
lists of one block as an index from words to classes and counts the classes of a later block against it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Classes of a block. A class's words are sent to as many tasks as there are blocks.
BLOCK = 32768

FOUND = "a long, b long, jaccard double, best boolean"


def _sets(column) -> tuple[np.ndarray, np.ndarray]:
    c = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return c.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(c.value_lengths().to_numpy(zero_copy_only=False))]).astype(np.int64)


def earlier(floor: float, low: float, high: float):
    """Rows of one pair of blocks (rep, probes, held, tokens) -> the best held class of each probing class, of smaller rep.

    The best is given from floor up. While it is below high, all from low up follow, marked as not best.
    """

    def run(table):
        table = table.sort_by("rep")
        held, probes = table.filter(table["held"]), table.filter(table["probes"])
        out: list = [[], [], [], []]
        if len(held) and len(probes):
            reps = held["rep"].to_numpy()
            words, ends = _sets(held["tokens"])
            sizes = np.diff(ends)
            known, at = np.unique(words, return_inverse=True)
            order = np.argsort(at, kind="stable")
            posts = np.repeat(np.arange(len(reps)), sizes)[order]
            starts = np.concatenate([[0], np.cumsum(np.bincount(at, minlength=len(known)))])
            words, ends = _sets(probes["tokens"])
            for i, rep in enumerate(probes["rep"].to_pylist()):
                before = int(np.searchsorted(reps, rep))
                mine = words[ends[i] : ends[i + 1]]
                k = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                k = k[known[k] == mine]
                if not before or not len(k):
                    continue
                common = np.bincount(np.concatenate([posts[starts[x] : starts[x + 1]] for x in k]), minlength=len(reps))[:before]
                j = common / (len(mine) + sizes[:before] - common)
                top = int(np.argmax(j))
                if j[top] < floor:
                    continue
                near = [] if j[top] >= high else [x for x in np.flatnonzero(j >= low)]
                for x, best in [(top, True), *((x, False) for x in near)]:
                    for col, v in zip(out, (rep, int(reps[x]), float(j[x]), best)):
                        col.append(v)
        return pa.table([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64()), pa.array(out[3], pa.bool_())], names=["a", "b", "jaccard", "best"])

    return run


def closest(classes: DataFrame, floor: float, low: float, high: float, block: int = BLOCK) -> DataFrame:
    """(a, b, jaccard, best) of classes (rep, tokens), b < a; see earlier. a has one best row per block of b.

    classes is read several times.
    """
    n = classes.count()
    blocks = max(1, -(-n // block))
    # where blocks are cut decides how even they are, never what is found
    cuts = classes.approxQuantile("rep", [i / blocks for i in range(1, blocks)], 0.001) if blocks > 1 else []
    mine = F.size(F.filter(F.array(*map(F.lit, cuts)).cast("array<double>"), lambda e: F.col("rep") >= e)) if cuts else F.lit(0)
    d = classes.withColumn("mine", mine)
    # as probing class against blocks up to its own, as held class for its own and later blocks
    every = d.withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    rows = every.select(
        F.greatest("mine", "other").alias("late"), F.least("mine", "other").alias("early"), "rep",
        (F.col("other") <= F.col("mine")).alias("probes"), (F.col("other") >= F.col("mine")).alias("held"), "tokens",
    )
    return rows.groupBy("late", "early").applyInArrow(earlier(floor, low, high), FOUND)
