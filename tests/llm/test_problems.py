import hashlib
import random
from datetime import datetime

from pyspark.sql import functions as F

from cribble.llm.capping import beyond_cap, share_cap
from cribble.llm.history import HistoryIndex, repeats
from cribble.operators.scoring import latest_score
from tests import plain
from tests.test_operators import rows, texts


def test_history_against_one_by_one(spark):
    docs = texts(5, 80)
    old = [(i, f"https://a/{i}", hashlib.sha256(f"{t}{c}".encode()).hexdigest(), t, c) for i, t, c in docs[:40]]
    r = random.Random(6)
    new = [(i + 1000, i // 60, f"https://a/{r.choice([i, i, i - 45])}", hashlib.sha256(f"{t}{c}".encode()).hexdigest() if i % 3 else None, t, c) for i, t, c in docs[40:]]
    accepted, want = list(old), []
    for i, b, u, h, t, c in new:
        hit = [o[0] for o in accepted if o[1] == u or h is not None and o[2] == h or plain.similar((t, c), (o[3], o[4]))]
        if hit:
            want.append((min(hit), i))
        else:
            accepted.append((i, u, h, t, c))
    cols = "url string, digest string, title string, content string"
    h, n = spark.createDataFrame(old, f"id long, {cols}"), spark.createDataFrame(new, f"id long, batch_no int, {cols}")
    assert rows(repeats(h, n), "matched_id", "incoming_id") == sorted(want)
    index, found = HistoryIndex(spark, buckets=4), []
    index.append(h, 0)
    for b in (0, 1):
        # a batch that runs again finds the same and adds nothing twice
        once = rows(index.take(n.where(F.col("batch_no") == b), b + 1), "matched_id", "incoming_id")
        size = index.read("segments").count()
        assert rows(index.take(n.where(F.col("batch_no") == b), b + 1), "matched_id", "incoming_id") == once and index.read("segments").count() == size
        found += once
    assert sorted(found) == sorted(want)
    # another session reopens the tables by their path
    again = HistoryIndex(spark, index.path, buckets=4)
    assert again.read("urls").count() == index.read("urls").count() > 0
    assert rows(repeats(h, n.limit(0)), "matched_id", "incoming_id") == []
    assert len(rows(repeats(h.limit(0), n), "matched_id", "incoming_id")) <= len(want)


def test_cap(spark):
    r = random.Random(2)
    recs = [(i, r.choice(["a", "a", "a", "b", None]), r.choice([None, float("nan"), 1.0, 2.5, 2.5, 2.5, 4.123456789, r.random() * 5])) for i in range(500)]
    for cap in (1, 100, 1000):
        want = []
        for who in {x[1] for x in recs}:
            own = sorted((x for x in recs if x[1] == who), key=lambda x: (x[2] is None or x[2] != x[2], -(x[2] if x[2] is not None and x[2] == x[2] else 0), x[0]))
            want += [(x[0],) for x in own[cap:]]
        df = spark.createDataFrame(recs, "id long, who string, score double").withColumn("key", F.lit("x")).withColumn("n", F.lit(0))
        assert rows(beyond_cap(df, cap), "id") == sorted(want)
    assert rows(beyond_cap(spark.createDataFrame([], "id long, who string, score double"), 3), "id") == []
    ties = spark.createDataFrame([(i, "a", None) for i in range(300)], "id long, who string, score double")
    assert rows(beyond_cap(ties, 10), "id") == [(i,) for i in range(10, 300)]


def test_share_cap_and_latest_score(spark):
    assert [share_cap(n, 2) for n in (0, 49, 50, 149, 150)] == [1, 1, 1, 2, 3]
    t = datetime(2025, 1, 1)
    s = spark.createDataFrame([("r", 1, "l", "t", 3.0, t), ("s", 1, "l", "t", 4.0, t), ("z", 1, "l", "t", 9.0, t), ("z", 2, "l", "t", None, t), ("z", 1, "l", "t", float("nan"), t)], "run_id string, content_id long, taxonomy_lv2 string, type_name string, overall double, scored_at timestamp")
    assert rows(latest_score(s), "content_id", "score") == [(1, 4.0)]


def exchanges_over(df, table: str) -> int:
    """How many exchanges of the plan have the table's scan below them without a join between."""
    plan = df._jdf.queryExecution().executedPlan().toString().split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-*()0123456789"))
    n = 0
    for i, line in enumerate(plan):
        if table in line and "FileScan" in line:
            level = depth(line)
            for up in reversed(plan[:i]):
                if depth(up) < level:
                    level = depth(up)
                    if "Join" in up:
                        break
                    n += "Exchange" in up
    return n


def test_history_is_joined_where_it_lies(spark):
    from cribble.operators.similar import WordIndex, _content_candidates

    docs = texts(7, 60)
    h = spark.createDataFrame([(i, f"u{i}", f"d{i}", t, c) for i, t, c in docs], "id long, url string, digest string, title string, content string")
    index = HistoryIndex(spark, buckets=4)
    index.append(h, 0)
    from cribble.llm.history import StoredIndex, _least

    old, new = StoredIndex(lambda part: index.read(part, 1)), WordIndex(h)
    assert exchanges_over(_content_candidates(new, old), "_segments") == 0
    assert exchanges_over(new.classes.join(old.classes.hint("merge"), "rep"), "_classes") == 0
    assert exchanges_over(h.join(_least(index.read("urls", 1), "url", "hid").hint("merge"), "url"), "_urls") == 0
    assert exchanges_over(new.segments.join(new.segments.withColumnRenamed("rep", "r").hint("merge"), "key"), "_segments") == 0
