"""The reference's near-duplicate verdicts: each record against all stored before it.

A record with a normalised title that an earlier record has is a duplicate of the first such record. Otherwise it is
one of the earlier record with the greatest word similarity, if that is at least 0.45, or at least 0.35 where the
titles' cosine is at least 0.9; the smaller id wins ties. Every record is stored, whatever its verdict.

What the reference observes beside its verdicts is each record's best earlier partner, if their words' similarity is at
least 0.15: the first record with the same title, else the one with the greatest similarity.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from cribble.operators.closest import BLOCK, closest
from cribble.operators.lineage import cut
from cribble.operators.similar import J_TITLED, TITLE_COSINE, WordIndex, class_pairs, cosine, titled_nodes

ALONE = 0.45
#: Similarity from which a partner is observed.
FLOOR = 0.15


def verdicts(docs: DataFrame) -> DataFrame:
    """(id, matched_id, by_title, jaccard): docs is (id, title, content), titles normalised; records without a match are left out."""
    d = docs.select("id", F.coalesce("title", F.lit("")).alias("title"))
    first = d.where("title <> ''").groupBy("title").agg(F.min("id").alias("m"))
    exact = d.join(first, "title").where("m < id").select("id", F.col("m").alias("matched_id"), F.lit(True).alias("by_title"), F.lit(None).cast("double").alias("jaccard"))

    # at 0.45 a pair shares one of 128 bands with probability 0.995; of 256 bits 70 differ in the mean, 96 are 3.5 deviations more
    ix = WordIndex(docs, least=1, bands=128, most_bits=96)
    pairs = class_pairs(ix)
    both = pairs.union(pairs.select("b", "a", "jaccard"))
    m = ix.members
    same = m.where("rep < id").select("id", F.col("rep").alias("o"), F.lit(1.0).alias("j"))
    alone = m.join(both.where(F.col("jaccard") >= ALONE), m.rep == both.a).where("b < id").select("id", F.col("b").alias("o"), F.col("jaccard").alias("j"))
    node = m.groupBy(F.col("rep").alias("r"), F.col("title").alias("t")).agg(F.min("id").alias("o"))
    t = titled_nodes(pairs, ix, alone=ALONE).select("a", "xa", "b", "xb", "jaccard")
    t = t.union(t.select("b", "xb", "a", "xa", "jaccard"))
    titled = t.join(node, (F.col("b") == F.col("r")) & (F.col("xb") == F.col("t"))).select(F.col("a").alias("rep"), F.col("xa").alias("title"), "o", F.col("jaccard").alias("j"))
    titled = m.join(titled, ["rep", "title"]).where("o < id").select("id", "o", "j")
    best = same.union(alone).union(titled).groupBy("id").agg(F.max(F.struct("j", (-F.col("o")).alias("n"))).alias("x"))
    best = best.join(exact.select("id"), "id", "left_anti").select("id", (-F.col("x.n")).alias("matched_id"), F.lit(False).alias("by_title"), F.col("x.j").alias("jaccard"))
    return exact.unionByName(best)


def observations(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """(id, matched_id, title_similarity, content_similarity, would_exclude): docs is (id, title, content), titles normalised.

    Nothing is left to candidates: all classes of word sets are compared, see ``closest``.
    """
    d = docs.select("id", F.coalesce("title", F.lit("")).alias("title"))
    ix = WordIndex(docs, least=1)
    m, classes = ix.members, cut(ix.classes)

    first = d.where("title <> ''").groupBy("title").agg(F.min("id").alias("o"))
    titled = d.join(first, "title").where("o < id").select("id", "o")
    rep = m.select("id", "rep")
    words = lambda n: classes.select(F.col("rep").alias(f"r{n}"), F.col("tokens").alias(f"x{n}"))
    j = titled.join(rep.withColumnRenamed("rep", "r1"), "id").join(rep.select(F.col("id").alias("o"), F.col("rep").alias("r2")), "o")
    j = j.join(words(1).hint("merge"), "r1").join(words(2).hint("merge"), "r2").withColumn("i", F.size(F.array_intersect("x1", "x2")))
    j = j.select("id", "o", F.lit(1.0).alias("t"), (F.col("i") / (F.size("x1") + F.size("x2") - F.col("i"))).alias("j"), F.lit(True).alias("out"))

    # a later copy's best partner is the first copy; a first copy's is the first of another class
    found = cut(closest(classes, FLOOR, J_TITLED, ALONE, block))
    best = found.where("best").groupBy("a").agg(F.max(F.struct("jaccard", (-F.col("b")).alias("n"))).alias("x"))
    best = best.select(F.col("a").alias("id"), (-F.col("x.n")).alias("o"), F.col("x.jaccard").alias("j"))
    copies = m.where("rep < id").select("id", F.col("rep").alias("o"), F.lit(1.0).alias("j"))
    rest = copies.union(best).join(titled.select("id"), "id", "left_anti")
    title = lambda k, x: d.select(F.col("id").alias(k), F.col("title").alias(x))
    near = found.where("not best").join(m.select(F.col("rep").alias("b"), F.col("id").alias("o"), F.col("title").alias("xb")), "b").where("o < a")
    near = near.join(title("a", "xa"), "a").where(cosine("xa", "xb") >= TITLE_COSINE).select(F.col("a").alias("id"), F.lit(True).alias("helped")).distinct()
    rest = rest.join(title("id", "xa"), "id").join(title("o", "xb"), "o").join(near, "id", "left")
    rest = rest.select("id", "o", cosine("xa", "xb").alias("t"), "j", (F.col("helped").isNotNull() | (F.col("j") >= ALONE)).alias("out"))
    every = j.union(rest).where(F.col("j") >= FLOOR)
    return every.select("id", F.col("o").alias("matched_id"), F.col("t").alias("title_similarity"), F.col("j").alias("content_similarity"), F.col("out").alias("would_exclude"))
