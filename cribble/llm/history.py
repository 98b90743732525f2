"""Checking new batches against all history and against one another.

The accepted records are kept as an index: tables by address, by digest and by the segments of their sketches
(``similar.py``), each stored in buckets of its key. A batch's own keys are brought to the buckets; the history is
joined where it lies and never shuffled, and none of its texts is read again. What the batch adds is appended.

Order matters: a record counts as accepted history for the records after it only if it repeated nothing before it. That
is resolved set-wise: every record lists the keys it owns and the keys that it must not find taken (the same, and those
of similar classes); in each round, records that find an earlier accepted owner are rejected and records with no earlier
undecided rival are accepted.
"""

from __future__ import annotations

import uuid
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from cribble.operators.lineage import cut, scratch_table
from cribble.operators.similar import J_ALONE, TASK_ROWS, WordIndex, class_pairs, titled_nodes


def _least(df: DataFrame, key: str, out: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min("id").alias(out))


def repeats(history: DataFrame, incoming: DataFrame) -> DataFrame:
    """(matched_id, incoming_id): incoming records that repeat an accepted one, with the least such.

    history: id, url, digest, title, content of the accepted records. incoming: the same and batch_no. url and title
    are normalised. Nulls in url and digest match nothing; a null content is empty. Records are taken by batch_no (nulls first), then
    id; ids are unique over both.
    """
    # so many buckets that one holds about TASK_ROWS segments
    buckets = max(HistoryIndex.BUCKETS, history.count() * WordIndex.bands // TASK_ROWS)
    index = HistoryIndex(history.sparkSession, buckets=buckets)
    index.append(history, 0)
    return index.find(incoming)


def check(hist: WordIndex, urls: DataFrame, digests: DataFrame, incoming: DataFrame) -> DataFrame:
    """What repeats returns, with the history as an index and tables of its keys: urls (url, id), digests (digest, id)."""
    new = WordIndex(incoming)
    recs = cut(incoming.select("id", F.struct("batch_no", "id").alias("ord"), "url", "digest"))

    by_class, by_self = class_pairs(new, hist), class_pairs(new)
    m, hm = new.members, hist.members
    old_titles = hm.groupBy(F.col("rep").alias("b"), F.col("title").alias("xb")).agg(F.min("id").alias("hid"))
    old = [
        recs.join(_least(urls, "url", "hid"), "url").select("id", "hid"),
        recs.join(_least(digests, "digest", "hid"), "digest").select("id", "hid"),
        # the least partner of a class first, so that its copies don't multiply with all of them
        m.join(by_class.where(F.col("jaccard") >= J_ALONE).groupBy(F.col("a").alias("rep")).agg(F.min("b").alias("hid")), "rep").select("id", "hid"),
        m.join(titled_nodes(by_class, new, hist).join(old_titles, ["b", "xb"]).groupBy(F.col("a").alias("rep"), F.col("xa").alias("title")).agg(F.min("hid").alias("hid")), ["rep", "title"]).select("id", "hid"),
    ]
    matched = cut(old[0].union(old[1]).union(old[2]).union(old[3]).groupBy("id").agg(F.min("hid").alias("hid")))

    k = lambda tag, *c: F.concat_ws("\x1f", F.lit(tag), *[F.col(x).cast("string") for x in c])
    own = recs.where("url is not null").select("id", k("u", "url").alias("key"))
    own = own.union(recs.where("digest is not null").select("id", k("h", "digest").alias("key")))
    own = own.union(m.select("id", k("c", "rep").alias("key"))).union(m.select("id", k("t", "rep", "title").alias("key")))
    high = by_self.where(F.col("jaccard") >= J_ALONE)
    low = titled_nodes(by_self, new)
    adj = high.select(k("c", "a").alias("key"), k("c", "b").alias("other")).union(low.select(k("t", "a", "xa").alias("key"), k("t", "b", "xb").alias("other")))
    adj = adj.union(adj.select("other", "key"))
    own = own.join(recs.select("id", "ord"), "id")
    seen = own.join(adj, "key").select("id", F.col("other").alias("key"), "ord")
    first = own.groupBy("key").agg(F.min("ord").alias("first"))
    # only keys that a later record asks for can decide anything
    asks = cut(own.unionByName(seen).join(first, "key").where("first < ord").select("id", "ord", "key"))
    own = cut(own.join(asks.select("key").distinct(), "key", "left_semi").select("id", "ord", "key"))

    busy = asks.select("id").union(own.select("id")).distinct()
    state = cut(busy.join(matched.select("id", F.lit(False).alias("ok")), "id", "left"))
    while not state.where("ok is null").isEmpty():
        taken = own.join(state, "id").where("ok is null or ok").groupBy("key").agg(F.min(F.when(F.col("ok"), F.col("ord"))).alias("acc"), F.min(F.when(F.col("ok").isNull(), F.col("ord"))).alias("und"))
        met = asks.join(taken, "key").groupBy("id").agg(F.max(F.coalesce(F.col("acc") < F.col("ord"), F.lit(False))).alias("hit"), F.max(F.coalesce(F.col("und") < F.col("ord"), F.lit(False))).alias("wait"))
        step = F.when(F.col("ok").isNotNull(), F.col("ok")).when(F.coalesce("hit", F.lit(False)), F.lit(False)).when(~F.coalesce("wait", F.lit(False)), F.lit(True))
        state = cut(state.join(met, "id", "left").select("id", step.alias("ok")))

    kept = own.join(state.where("ok"), "id").select("key", F.col("id").alias("hid"), F.col("ord").alias("o"))
    inner = asks.join(kept, "key").where("o < ord").select("id", "hid")
    both = matched.unionByName(inner).groupBy("id").agg(F.min("hid").alias("matched_id"))
    return both.select("matched_id", F.col("id").alias("incoming_id"))


class StoredIndex(WordIndex):
    """A word index whose parts are read from the tables that HistoryIndex keeps."""

    def __init__(self, read):
        self.least, self.bands, self.most_bits = WordIndex.least, WordIndex.bands, WordIndex.most_bits
        self.read = read

    @cached_property
    def spread(self) -> None:
        return None

    @cached_property
    def classes(self) -> DataFrame:
        return self.read("classes")

    @cached_property
    def members(self) -> DataFrame:
        return self.read("members")

    @cached_property
    def segments(self) -> DataFrame:
        return self.read("segments")

    @cached_property
    def nodes(self) -> DataFrame:
        return self.read("nodes")

    @cached_property
    def nodes_by_rep(self) -> DataFrame:
        return self.members.where(F.col("title") != "").select("rep", "title").distinct()

    @cached_property
    def title_segments(self) -> DataFrame:
        return self.read("title_segments").distinct()


class HistoryIndex:
    """The index of everything accepted so far, as bucketed tables in the shared folder.

    A batch runs again after a failure without harm: it sees only what came before it, and what it has appended already
    stays as it is. path reopens an index of another session.
    """

    BUCKETS = 64
    # columns of each table and the one by which it lies in buckets
    TABLES = {
        "urls": ("url STRING, id BIGINT", "url"),
        "digests": ("digest STRING, id BIGINT", "digest"),
        "classes": ("rep BIGINT, tokens ARRAY<BIGINT>", "rep"),
        "members": ("id BIGINT, rep BIGINT, title STRING", "rep"),
        "nodes": ("rep BIGINT, tid BIGINT, title STRING", "tid"),
        "segments": ("key BIGINT, rep BIGINT, n INT, s0 BIGINT, s1 BIGINT, s2 BIGINT, s3 BIGINT", "key"),
        "title_segments": ("key BIGINT, tid BIGINT, s0 BIGINT, s1 BIGINT", "key"),
    }

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int = BUCKETS):
        self.spark, self.buckets = spark, buckets
        self.path = path or scratch_table(spark, "history")
        self.name = "history_" + uuid.uuid4().hex
        for part, (columns, by) in self.TABLES.items():
            spark.sql(f"CREATE TABLE {self.name}_{part} ({columns}, batch INT) USING parquet CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{self.path}/{part}'")

    def read(self, part: str, before: int | None = None) -> DataFrame:
        t = self.spark.table(f"{self.name}_{part}")
        return (t if before is None else t.where(F.col("batch") < before)).drop("batch")

    def _add(self, part: str, rows: DataFrame, batch: int) -> None:
        if not self.spark.table(f"{self.name}_{part}").where(F.col("batch") == batch).isEmpty():
            return
        columns, by = self.TABLES[part]
        names = [c.split()[0] for c in columns.split(", ")]
        rows.select(*names, F.lit(batch).alias("batch")).repartition(self.buckets, by).write.insertInto(f"{self.name}_{part}")

    def append(self, records: DataFrame, batch: int) -> None:
        """Adds accepted records (id, url, digest, title, content)."""
        self._add("urls", records.where("url is not null").select("url", "id"), batch)
        self._add("digests", records.where("digest is not null").select("digest", "id"), batch)
        index = WordIndex(records)
        self._add("classes", index.classes, batch)
        self._add("members", index.members, batch)
        # the rest is made of what is stored
        new = StoredIndex(lambda part: self.spark.table(f"{self.name}_{part}").where(F.col("batch") == batch).drop("batch"))
        self._add("nodes", WordIndex.nodes.func(new), batch)
        self._add("segments", WordIndex.segments.func(new), batch)
        self._add("title_segments", WordIndex.title_segments.func(new), batch)

    def find(self, incoming: DataFrame, before: int | None = None) -> DataFrame:
        """(matched_id, incoming_id) of records that repeat an accepted one of earlier batches, or one another."""
        read = lambda part: self.read(part, before)
        return check(StoredIndex(read), read("urls"), read("digests"), incoming)

    def take(self, incoming: DataFrame, batch: int) -> DataFrame:
        """(matched_id, incoming_id) of the batch; its other records are appended."""
        found = cut(self.find(incoming, batch))
        self.append(incoming.join(found.select(F.col("incoming_id").alias("id")), "id", "left_anti"), batch)
        return found
