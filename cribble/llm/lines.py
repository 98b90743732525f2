"""Lines repeated across one site's documents: per-site line counts kept as tables and merged by deltas.

A new partition of documents becomes a *delta* (site, h1, h2, n): in how many of its documents a normalised line of a
site stands, counted before it is shuffled. Deltas are appended to the state, in folders by a hash of the site; merging
one reads only the folders of its sites and, of those, only the counts of its own lines: what is written is the delta,
never the state. The lines whose count passes the threshold with it are its *crossings*; each line crosses once. Beside
the counts the state keeps postings, which documents hold which lines, so that the documents of crossed lines are known
without their texts: only those documents are rebuilt.

A line is normalised by trimming, one blank for each run of white space, lower case and one 0 for each run of digits;
lines under 10 characters never count. Two 64-bit hashes stand for a line. Null contents and sites have no lines.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from cribble.operators.lineage import cut, scratch_table

MIN_CHARS, MIN_DOCS = 10, 5
#: Lines that stand in more than 1/HOT of all lines are broadcast; there are fewer than HOT of them.
HOT = 5000
KEY = ["site", "h1", "h2"]
STATE = "site string, h1 long, h2 long, n long, bucket int"
POSTINGS = "id long, site string, h1 long, h2 long, bucket int"
#: Folders of the state, by a hash of the site; deltas after which they are written together.
BUCKETS, DELTAS = 32, 16


def norms(content: Column) -> Column:
    """The normalised lines of a content, by line number from 0."""
    c = F.regexp_replace(content, r"(?U)[\s\x1c-\x1f&&[^\n]]+", " ")
    c = F.regexp_replace(F.regexp_replace(c, r" ?\n ?", "\n"), r"\A | \z", "")
    return F.split(F.regexp_replace(F.lower(c), "[0-9]+", "0"), "\n")


def _hashes(line: str) -> list[Column]:
    return [F.xxhash64(line).alias("h1"), F.xxhash64(F.lit("cribble"), F.col(line)).alias("h2")]


def line_rows(docs: DataFrame) -> DataFrame:
    """(id, line_no, site, h1, h2) of the lines that count."""
    rows = docs.where("site is not null").select("id", "site", F.posexplode(norms(F.col("content"))).alias("line_no", "line"))
    return rows.where(F.length("line") >= MIN_CHARS).select("id", "line_no", "site", *_hashes("line"))


def delta(docs: DataFrame, *more: str) -> DataFrame:
    """Line counts of a partition of documents: (site, h1, h2, n), apart for further columns."""
    rows = docs.where("site is not null").select("site", *more, F.explode(F.array_distinct(norms(F.col("content")))).alias("line"))
    rows = rows.where(F.length("line") >= MIN_CHARS).select("site", *more, *_hashes("line"))
    return rows.groupBy(*KEY, *more).agg(F.count("*").alias("n"))


def hits(rows: DataFrame, lines: DataFrame) -> DataFrame:
    """The rows (id, line_no, ...) whose line is among the lines (site, h1, h2, n).

    A line that a large part of all documents share would send them all to one task. Such lines are joined by
    broadcast: counts add up to at most the number of rows, so fewer than HOT lines can exceed the HOT-th part of it.
    """
    total = lines.agg(F.sum("n")).first()[0] or 0
    bound = max(1, total // HOT)
    hot = F.broadcast(lines.where(F.col("n") > bound).select(*KEY, F.lit(True).alias("hot")))
    cold = lines.where(F.col("n") <= bound).select(*KEY)
    marked = rows.join(hot, KEY, "left")
    return marked.where("hot").drop("hot").unionByName(marked.where("hot is null").drop("hot").join(cold, KEY, "left_semi"))


def bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.pmod(F.xxhash64("site"), F.lit(BUCKETS)).cast("int"))


@dataclass
class LineCounts:
    """The line counts of all sites, kept in the shared folder, and their incremental maintenance.

    Partitions must not repeat a document id: a document is counted when its partition is merged.
    """

    spark: SparkSession
    least: int = MIN_DOCS
    path: str = ""
    deltas: int = 0

    def __post_init__(self):
        self.path = self.path or scratch_table(self.spark, "line-counts")

    def _read(self, name: str, schema: str, buckets: list[int] | None = None) -> DataFrame | None:
        if not self.deltas:
            return None
        t = self.spark.read.schema(schema + ", delta int").parquet(f"{self.path}/{name}").drop("delta")
        return t if buckets is None else t.where(F.col("bucket").isin(buckets))

    def counts(self, buckets: list[int] | None = None) -> DataFrame | None:
        return self._read("counts", STATE, buckets)

    def merge_delta(self, new: DataFrame) -> DataFrame:
        """Appends a delta (site, h1, h2, n); returns the lines that cross the threshold with it, with their counts."""
        new = cut(bucketed(new))
        # a bucket is one of BUCKETS numbers
        touched = [r.bucket for r in new.select("bucket").distinct().collect()]
        old = self.counts(touched)
        if old is None:
            both = new.withColumn("before", F.lit(0).cast("long"))
        else:
            mine = old.join(new.select(*KEY).hint("merge"), KEY, "left_semi").groupBy(*KEY).agg(F.sum("n").alias("before"))
            both = new.join(mine.hint("merge"), KEY, "left").withColumn("before", F.coalesce("before", F.lit(0).cast("long")))
        crossed = cut(both.where((F.col("n") + F.col("before") >= self.least) & (F.col("before") < self.least)).select(*KEY, (F.col("n") + F.col("before")).alias("n")))
        new.select(*KEY, "n", "bucket").repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/counts/delta={self.deltas}")
        self.deltas += 1
        return crossed

    def merge_partition(self, docs: DataFrame) -> DataFrame:
        """Merges the documents (id, site, content), with their postings; returns the crossed lines."""
        bucketed(line_rows(docs).select("id", *KEY).distinct()).repartition("bucket", "id").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/postings/delta={self.deltas}")
        return self.merge_delta(delta(docs))

    def repeated(self) -> DataFrame:
        """(site, h1, h2, n): all lines past the threshold."""
        return self.counts().groupBy(*KEY).agg(F.sum("n").alias("n")).where(F.col("n") >= self.least)

    def holders(self, lines: DataFrame) -> DataFrame:
        """(id): the documents merged so far that hold one of the lines, from the postings alone."""
        return hits(self._read("postings", POSTINGS), lines).select("id").distinct()

    def compact(self) -> None:
        """Writes the deltas together as one; deltas and postings of before stay until the new ones are complete."""
        path = scratch_table(self.spark, "line-counts")
        bucketed(self.counts().groupBy(*KEY).agg(F.sum("n").alias("n"))).write.partitionBy("bucket").parquet(f"{path}/counts/delta=0")
        if self._has("postings"):
            self._read("postings", POSTINGS).write.partitionBy("bucket").parquet(f"{path}/postings/delta=0")
        self.path, self.deltas = path, 1

    def _has(self, name: str) -> bool:
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(p)


def repeated_lines(docs: DataFrame, least: int = MIN_DOCS, parts: int = 2) -> DataFrame:
    """(id, line_no) of the lines that stand in at least least documents of their site.

    docs: id, site, content; merged as parts deltas, whose crossings together are the repeated lines.
    """
    part = F.pmod(F.xxhash64("id"), F.lit(parts)).alias("part")
    # all deltas are counted in one pass over the texts
    new = cut(delta(docs.select("id", "site", "content", part), "part"))
    state = LineCounts(docs.sparkSession, least)
    crossed = reduce(DataFrame.unionByName, [state.merge_delta(new.where(F.col("part") == k).drop("part")) for k in range(parts)])
    # each line's count when it crossed is a lower bound; the bound for broadcasts needs the final one
    total = new.groupBy(*KEY).agg(F.sum("n").alias("n"))
    lines = cut(total.join(crossed.select(*KEY).hint("merge"), KEY, "left_semi"))
    return hits(line_rows(docs), lines).select("id", "line_no")


def maintain(state: LineCounts, batches: list[DataFrame]) -> DataFrame:
    """(id, content) of all documents that hold repeated lines, without them, kept up to date batch by batch.

    With each batch only two kinds of documents are rebuilt: those that hold a line it made cross, whenever they came,
    and its own that hold a line that had crossed before. The last version of a document stands.
    """
    kept, seen = None, None
    for docs in batches:
        seen = docs if seen is None else seen.unionByName(docs)
        crossed = state.merge_partition(docs)
        lines = cut(state.repeated())
        own = hits(line_rows(docs), lines).select("id")
        ids = state.holders(crossed).union(own).distinct()
        fresh = cut(rebuild(seen.join(ids, "id", "left_semi"), lines))
        kept = fresh if kept is None else fresh.unionByName(kept.join(fresh.select("id"), "id", "left_anti"))
    return kept


def rebuild(docs: DataFrame, crossed: DataFrame) -> DataFrame:
    """(id, content): the documents that hold a crossed line, without it. Other documents are left out."""
    bad = hits(line_rows(docs), crossed).groupBy("id").agg(F.sort_array(F.collect_set("line_no")).alias("bad"))
    lines = F.filter(F.split("content", "\n"), lambda x, i: ~F.array_contains(F.col("bad"), i))
    return docs.join(bad, "id").select("id", F.array_join(lines, "\n").alias("content"))
