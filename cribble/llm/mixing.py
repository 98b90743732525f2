"""Mixing sources to target shares of the total size in tokens.

1. Sizes: each text's tokens, a text that stands in several documents counted once. A source may be repeated up to its cap; the largest total at which every source that
   has texts can supply its share is the size of the mixture. A listed source without texts gets nothing, and the
   shares of the others are scaled to sum to one.
2. Blocks: each source's texts are shuffled by hash, once per repetition, and cut into blocks of about equal tokens.
   Running sums are taken in hash ranges of a few thousand texts, whose totals are summed apart, so that no source is
   gathered in one task.
3. Schedule: slot i of the mixture takes the point frac(i * golden ratio); the source in whose part of the cumulative
   numbers of blocks the point falls owns the slot. Any stretch of the mixture is thereby close to the shares. The
   slots of a source are ranked, and the r-th slot gets the source's r-th block, until each block has its slot.

The cap holds for a text, not for a document: equal texts are one, with the least doc_id. A text of several sources
belongs to the one with the smallest cap, so it occurs no more often than any of them allows.

Texts that are null or empty have no tokens and aren't mixed. Sources that mix_targets doesn't list are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from cribble.operators.lineage import cut
from cribble.operators.running import RANGE, running

PHI = 0.6180339887498949
#: Tokens of a block.
BLOCK = 8192


def keyed(df: DataFrame) -> DataFrame:
    """df with text_key, by which equal texts are known; without that column each document is a text of its own."""
    return df if "text_key" in df.columns else df.withColumn("text_key", F.col("doc_id").cast("string"))


def distinct_texts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(doc_id, source, text_key, tokens): one row per text that can be mixed."""
    usable = targets.where("target_share > 0 and max_repeats > 0").select("source", "max_repeats")
    rows = keyed(sizes).where("tokens > 0").join(F.broadcast(usable), "source")
    first = F.min(F.struct("max_repeats", "source", "doc_id")).alias("x")
    one = rows.groupBy("text_key").agg(first, F.first("tokens").alias("tokens"))
    return one.select("x.doc_id", "x.source", "text_key", "tokens")


def plan(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, share, goal, tokens, max_repeats): the share among sources with texts, and tokens to place.

    One row per target; the table of targets is a configuration of at most some thousand rows.
    """
    have = sizes.groupBy("source").agg(F.sum("tokens").alias("tokens"))
    t = targets.join(have, "source", "left").where("tokens > 0 and target_share > 0 and max_repeats > 0")
    every = Window.partitionBy(F.lit(0))
    t = t.withColumn("share", F.col("target_share") / F.sum("target_share").over(every))
    total = F.min(F.col("tokens") * F.col("max_repeats") / F.col("share")).over(every)
    return t.select("source", "share", F.floor(total * F.col("share")).alias("goal"), "tokens", "max_repeats")


def blocks(sizes: DataFrame, goals: DataFrame) -> DataFrame:
    """(source, block, doc_id, text_key, copy_no, tokens, place): the texts to place, place being the tokens before it.

    A text belongs to the block in which it begins. Texts are placed while their middle lies before the goal, so a
    source misses its goal by half a text at most; a source with texts gets one in any case.
    """
    rows = sizes.where("tokens > 0").join(goals.select("source", "goal", "max_repeats", F.col("tokens").alias("all")), "source")
    need = F.least(F.col("max_repeats").cast("long"), F.ceil(F.col("goal") / F.col("all")))
    rows = rows.withColumn("copy_no", F.explode(F.sequence(F.lit(1), F.greatest(need, F.lit(1)).cast("int"))))
    # one shuffled order of each repetition, repetitions after one another
    mixed = F.xxhash64("copy_no", "doc_id")
    n = rows.groupBy("source", "copy_no").agg(F.count("*").alias("texts"))
    rows = rows.join(n, ["source", "copy_no"]).withColumn("h", mixed)
    spots = F.greatest(F.lit(1), F.ceil(F.col("texts") / RANGE)).cast("long")
    spot = F.floor((F.shiftrightunsigned("h", 12).cast("double") / float(1 << 52)) * spots).cast("long")
    rows = running(rows, ["source", "copy_no"], F.col("h"), spot, "tokens", "before", "doc_id")
    rows = rows.withColumn("place", F.col("before") + (F.col("copy_no") - 1) * F.col("all"))
    rows = rows.where("place + tokens / 2 < goal or place = 0")
    return rows.select("source", F.floor(F.col("place") / BLOCK).alias("block"), "doc_id", "text_key", "copy_no", "tokens", "place")


def schedule(goals: DataFrame) -> DataFrame:
    """(slot, source, block): which source's which block stands in each slot.

    Points fall into parts as wide as the sources' numbers of blocks. The sequence gives a part of width w at least
    n * w - d of its first n points, where d grows with the logarithm of n; should a source still lack slots, the
    sequence is carried on until none does.
    """
    spark = goals.sparkSession
    g = goals.withColumn("blocks", F.greatest(F.ceil(F.col("goal") / BLOCK), F.lit(1).cast("long"))).select("source", "blocks")
    # one row per target: a configuration table, so its bounds become literals in the plan
    rows = sorted(g.collect(), key=lambda r: r.source)
    if not rows:
        return spark.createDataFrame([], "slot long, source string, block long")
    total = sum(r.blocks for r in rows)
    ends = [sum(r.blocks for r in rows[: i + 1]) / total for i in range(len(rows) - 1)]
    slots = total + 16
    while True:
        s = _slots(spark, slots, rows, ends)
        got = {r.source: r.n for r in s.groupBy("source").agg(F.count("*").alias("n")).collect()}
        lack = max(r.blocks - got.get(r.source, 0) for r in rows)
        if lack <= 0:
            break
        slots += max(slots // 8, min(total * lack, slots))
    s = running(s, ["source"], F.col("slot"), F.shiftright("slot", 12), "one", "block")
    return s.where("block < blocks").select("slot", "source", "block")


def _slots(spark, slots: int, rows: list, ends: list[float]) -> DataFrame:
    """(slot, source, one, blocks) of the first slots."""
    s = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"id * {PHI}D - floor(id * {PHI}D)").alias("u"), F.lit(1).alias("one"))
    place = F.size(F.filter(F.array(*map(F.lit, ends)).cast("array<double>"), lambda e: F.col("u") >= e)) + 1
    pick = lambda values, kind: F.element_at(F.array(*map(F.lit, values)).cast(f"array<{kind}>"), place)
    return s.select("slot", pick([r.source for r in rows], "string").alias("source"), "one", pick([r.blocks for r in rows], "bigint").alias("blocks"))


def mixture(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """(slot, source, block, doc_id, text_key, copy_no, tokens): the mixture in order of slots.

    sizes: doc_id, source, tokens and, where several documents may hold one text, text_key.
    """
    targets = targets.select("source", "target_share", "max_repeats")
    texts = cut(distinct_texts(sizes, targets))
    goals = cut(plan(texts, targets))
    b = blocks(texts, goals)
    return schedule(goals).join(b, ["source", "block"]).select("slot", "source", "block", "doc_id", "text_key", "copy_no", "tokens")


def report(mixed: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, target_share, actual_share, tokens, texts, most_repeats), one row per target.

    most_repeats: how often a text of the source occurs in the mixture at most, under whatever doc_id and source.
    """
    times = keyed(mixed).groupBy("source", "text_key").agg(F.count("*").alias("times"), F.sum("tokens").alias("tokens"))
    times = times.withColumn("times", F.sum("times").over(Window.partitionBy("text_key")))
    got = times.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("texts"), F.max("times").alias("most_repeats"))
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).alias(c)
    r = targets.select("source", "target_share").join(got, "source", "left").select("source", "target_share", zero("tokens"), zero("texts"), zero("most_repeats"))
    share = F.try_divide(F.col("tokens"), F.sum("tokens").over(Window.partitionBy(F.lit(0))))
    return r.withColumn("actual_share", F.coalesce(share, F.lit(0.0))).select("source", "target_share", "actual_share", "tokens", "texts", "most_repeats")
