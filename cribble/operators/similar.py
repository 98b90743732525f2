"""Similar records: candidates from equal sketch segments, pruned by the pigeonring, checked exactly.

A content is *similar* to another if both have at least 30 distinct words and their Jaccard similarity is at least
0.5, or at least 0.35 while the cosine of their titles' bigrams is at least 0.9.

1. Contents with the same word set form a class; only classes are compared, so copies never meet in pairs.
2. Each class is sketched (``sketch.py``). Classes with an equal band, at any of 80 positions, are candidates.
3. Pigeonring: the 256 sketch bits form a ring of four segments. If two sketches differ in at most D bits, some
   chain of consecutive segments has, at each of its lengths l, at most l*D/4 differences. Pairs without such a
   chain are pruned before the full Hamming distance is taken, and pairs beyond D before the word sets are read.
4. The word sets of what is left are intersected: the result has no false pair.

Titles have bands of their own, for pairs that are similar only with their titles' help. Titles that are shared by
many different contents meet through their rarest words instead of all pairs (prefix filter), which loses none.

The joins of segments and word sets are sort-merge joins at every size: what Python makes has no reliable size
estimate, and a side taken for small would be broadcast whole.

Nulls count as empty texts; empty and short contents are similar to nothing; extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from cribble.operators import sketch
from cribble.operators.lineage import cut

J_ALONE, J_TITLED, TITLE_COSINE = 0.5, 0.35, 0.9
#: Bits of 256 that may differ: at Jaccard 0.5 the mean is 64 and the deviation 6.9, so 3.5 deviations.
MOST_BITS = 88
#: The same of 128 bits of a title: at Jaccard 0.8 the mean is 12.8, the deviation 3.4.
MOST_TITLE_BITS = 28
#: Pairs of contents under one pair of titles, up to which all are checked directly; beyond, an exact prefix filter selects them.
DIRECT = 4096
#: Segments that one task of a join should meet; the number of tasks follows from it, whatever the session's default is.
TASK_ROWS = 200_000


def ring_check(a: str, b: str, most: int, parts: int = 4) -> Column:
    """Whether the sketches a.s0.. and b.s0.. have a viable chain, and then whether they differ in at most most bits."""
    d = [f"bit_count({a}.s{i} ^ {b}.s{i})" for i in range(parts)]
    chains = [" and ".join(f"({' + '.join(d[(i + j) % parts] for j in range(k))}) <= {k * most // parts}" for k in range(1, parts)) for i in range(parts)]
    return F.expr(f"(({') or ('.join(chains)})) and ({' + '.join(d)}) <= {most}")


@F.pandas_udf(T.DoubleType())
def cosine(a: pd.Series, b: pd.Series) -> pd.Series:
    """Cosine of the bigram counts of two titles; 0 where one is empty."""
    from collections import Counter
    from math import sqrt

    def one(x: str, y: str) -> float:
        p, q = Counter(sketch.grams(x)), Counter(sketch.grams(y))
        if not p or not q:
            return 0.0
        return sum(v * q[k] for k, v in p.items() if k in q) / (sqrt(sum(v * v for v in p.values())) * sqrt(sum(v * v for v in q.values())))

    return pd.Series([one(x or "", y or "") for x, y in zip(a, b)], dtype="float64")


@dataclass
class WordIndex:
    """Contents as word-set classes with their segments.

    docs: id BIGINT, title (normalised) STRING, content STRING; further columns are ignored. least: distinct words
    that a content must have. bands, most_bits: how many bands the sketch has and how many of its bits may differ.
    """

    docs: DataFrame
    least: int = sketch.MIN_WORDS
    bands: int = sketch.BANDS
    most_bits: int = MOST_BITS

    @cached_property
    def sets(self) -> DataFrame:
        d = self.docs.select(F.col("id").cast("long").alias("id"), "title", "content")
        return d.mapInArrow(sketch.word_sets(self.least), sketch.WORD_SETS)

    @cached_property
    def classes(self) -> DataFrame:
        """rep (the class's least id), tokens. All uses take just these columns, so they share one exchange."""
        return self.sets.select("cls", "id", "tokens").groupBy("cls").agg(F.min("id").alias("rep"), F.first("tokens").alias("tokens")).select("rep", "tokens")

    @cached_property
    def members(self) -> DataFrame:
        """id, rep, title, one row per content of at least 30 words."""
        m = self.sets.select("cls", "id", "title")
        reps = m.groupBy("cls").agg(F.min("id").alias("rep"))
        return cut(m.join(reps, "cls").select("id", "rep", "title"))

    @cached_property
    def segments(self) -> DataFrame:
        """key (of a band at its position), rep, n, s0..s3."""
        k = self.classes.mapInArrow(sketch.content_bands(self.bands), sketch.CONTENT_BANDS)
        return k.select(F.explode("bands").alias("key"), "rep", "n", "s0", "s1", "s2", "s3")

    @cached_property
    def spread(self) -> int | None:
        """Tasks for a join of the segments; none where they lie in buckets."""
        return max(1, self.members.count() * self.bands // TASK_ROWS)

    @cached_property
    def nodes(self) -> DataFrame:
        """rep, tid, title: the distinct titles of each class, blank ones left out."""
        m = self.members.where(F.col("title") != "").select("rep", F.xxhash64("title").alias("tid"), "title")
        return m.distinct()

    @cached_property
    def nodes_by_rep(self) -> DataFrame:
        """nodes, for joins by class; an index that is stored by class reads them without a shuffle."""
        return self.nodes

    @cached_property
    def titles(self) -> DataFrame:
        """tid, title, m (classes under it)."""
        return self.nodes.groupBy("tid").agg(F.first("title").alias("title"), F.count("*").alias("m"))

    @cached_property
    def title_segments(self) -> DataFrame:
        k = self.titles.select("tid", "title").mapInArrow(sketch.title_bands, sketch.TITLE_BANDS_SCHEMA)
        return k.select(F.explode("bands").alias("key"), "tid", "s0", "s1")


def _content_candidates(p: WordIndex, q: WordIndex) -> DataFrame:
    a, b = p.segments, q.segments
    if p.spread and q.spread:
        tasks = max(p.spread, q.spread, int(p.docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        a, b = a.repartition(tasks, "key"), b.repartition(tasks, "key")
    a, b = a.alias("a"), b.alias("b")
    near = [F.expr("a.n >= 0.44 * b.n and b.n >= 0.44 * a.n"), ring_check("a", "b", p.most_bits)]
    order = [F.expr("a.rep < b.rep")] if p is q else []
    j = a.join(b.hint("merge"), [F.expr("a.key = b.key"), *order, *near])
    return j.select(F.col("a.rep").alias("a"), F.col("b.rep").alias("b")).distinct()


def _prefixes(words: DataFrame, held: DataFrame) -> DataFrame:
    """rep, n, key: the rarest of each class's n words, as many as a pair of at least 0.35 can't both miss.

    Such a pair has ceil(0.35 * n) words of either class in common, so one of them is among all but the last
    ceil(0.35 * n) - 1 words of both, in any order that holds for all.
    """
    k = F.row_number().over(Window.partitionBy("rep").orderBy("held", "key"))
    return words.join(held, "key").withColumn("k", k).where("k <= n - (35 * n + 99) div 100 + 1").select("rep", "n", "key")


def _hot_candidates(p: WordIndex, q: WordIndex, many: DataFrame, na: DataFrame, nb: DataFrame) -> DataFrame:
    """a, b: classes under the pairs of titles in many, without loss: every pair of at least 0.35 is among them."""
    wa, wb = many.join(na, "ta"), many.join(nb, "tb")
    words = lambda x, reps: cut(x.classes.join(reps, "rep", "left_semi").select("rep", F.size("tokens").alias("n"), F.explode("tokens").alias("key")))
    xa, xb = words(p, wa.select(F.col("a").alias("rep"))), words(q, wb.select(F.col("b").alias("rep")))
    held = xa.select("key").union(xb.select("key")).groupBy("key").agg(F.count("*").alias("held"))
    ka = _prefixes(xa, held).select(F.col("rep").alias("a"), F.col("n").alias("x"), "key")
    kb = _prefixes(xb, held).select(F.col("rep").alias("b"), F.col("n").alias("y"), "key")
    hot = wa.join(ka, "a").join(wb.join(kb, "b"), ["ta", "tb", "key"])
    return hot.where("100 * x >= 35 * y and 100 * y >= 35 * x").select("a", "b").distinct()


def _title_candidates(p: WordIndex, q: WordIndex) -> DataFrame:
    a, b = p.title_segments.alias("a"), q.title_segments.alias("b")
    order = [F.expr("a.tid < b.tid")] if p is q else [F.expr("a.tid <> b.tid")]
    near = a.join(b.hint("merge"), [F.expr("a.key = b.key"), *order, ring_check("a", "b", MOST_TITLE_BITS, 2)])
    near = near.select(F.col("a.tid").alias("ta"), F.col("b.tid").alias("tb")).distinct()
    ta = p.titles.select(F.col("tid").alias("ta"), F.col("title").alias("xa"), F.col("m").alias("ma"))
    tb = q.titles.select(F.col("tid").alias("tb"), F.col("title").alias("xb"), F.col("m").alias("mb"))
    near = near.join(ta, "ta").join(tb, "tb").where(cosine("xa", "xb") >= TITLE_COSINE)
    same = ta.join(tb, F.col("ta") == F.col("tb"))
    if p is q:
        same = same.where("ma > 1")
    cols = ["ta", "tb", "ma", "mb"]
    both = cut(near.select(cols).union(same.select(cols)))
    na = p.nodes.select(F.col("tid").alias("ta"), F.col("rep").alias("a"))
    nb = q.nodes.select(F.col("tid").alias("tb"), F.col("rep").alias("b"))
    few = both.where(F.col("ma") * F.col("mb") <= DIRECT).join(na, "ta").join(nb, "tb").select("a", "b")
    many = both.where(F.col("ma") * F.col("mb") > DIRECT).select("ta", "tb")
    out = few if many.isEmpty() else few.union(_hot_candidates(p, q, many, na, nb))
    if p is q:
        out = out.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return out.distinct()


def class_pairs(p: WordIndex, q: WordIndex | None = None) -> DataFrame:
    """a (class of p), b (class of q), jaccard of at least 0.35; within one index each pair once, with a < b."""
    q = q or p
    c = _content_candidates(p, q).union(_title_candidates(p, q)).distinct()
    ta = p.classes.select(F.col("rep").alias("a"), F.col("tokens").alias("xa"))
    tb = q.classes.select(F.col("rep").alias("b"), F.col("tokens").alias("xb"))
    j = c.join(ta.hint("merge"), "a").join(tb.hint("merge"), "b").withColumn("i", F.size(F.array_intersect("xa", "xb")))
    j = j.select("a", "b", (F.col("i") / (F.size("xa") + F.size("xb") - F.col("i"))).alias("jaccard"))
    return cut(j.where(F.col("jaccard") >= J_TITLED))


def titled_nodes(pairs: DataFrame, p: WordIndex, q: WordIndex | None = None, alone: float = J_ALONE) -> DataFrame:
    """a, xa, b, xb: classes with a title each, of pairs below alone whose titles are close enough."""
    q = q or p
    low = pairs.where(F.col("jaccard") < alone).select("a", "b", "jaccard")
    na = p.nodes_by_rep.select(F.col("rep").alias("a"), F.col("title").alias("xa"))
    nb = q.nodes_by_rep.select(F.col("rep").alias("b"), F.col("title").alias("xb"))
    return low.join(na, "a").join(nb, "b").where(cosine("xa", "xb") >= TITLE_COSINE)


def similar_pairs(docs: DataFrame) -> DataFrame:
    """(id_a, id_b), id_a < id_b: every pair of similar contents, copies expanded.

    docs: id, title (normalised), content. For the form without expansion take WordIndex(docs).members and
    class_pairs.
    """
    ix = WordIndex(docs)
    pairs = class_pairs(ix)
    m = ix.members
    ma, mb = m.select(F.col("id").alias("x"), F.col("rep").alias("a"), F.col("title").alias("xa")), m.select(F.col("id").alias("y"), F.col("rep").alias("b"), F.col("title").alias("xb"))
    copies = ma.join(mb, F.col("a") == F.col("b")).where("x < y").select("x", "y")
    alone = pairs.where(F.col("jaccard") >= J_ALONE).join(ma, "a").join(mb, "b").select("x", "y")
    titled = titled_nodes(pairs, ix).join(ma, ["a", "xa"]).join(mb, ["b", "xb"]).select("x", "y")
    out = copies.union(alone).union(titled)
    return out.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))
