import random
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cribble.functions import text as tx
from cribble.operators import dedup, filters, scoring, store
from cribble.operators.running import running
from cribble.operators.similar import similar_pairs
from tests import plain


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=lambda t: tuple((x is None, x) for x in t))


def texts(seed=1, n=60):
    """Bodies with small edits, copies, shared titles, nulls, empty and short ones."""
    r = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    out = []
    for i in range(n):
        kind = r.random()
        if out and kind < 0.5:
            base = r.choice(out)
            words = (base[2] or "").split()
            for _ in range(int(len(words) * r.choice([0, 0.1, 0.25, 0.4]))):
                words[r.randrange(len(words))] = r.choice(vocabulary)
            r.shuffle(words)
            out.append((i, r.choice([base[1], f"제목 {i} 이다", (base[1] or "") + "!"]), " ".join(words)))
        else:
            out.append((i, f"서로 다른 제목 {i * 7919 % 1000}", r.choice([None, "", "짧은 글"]) if kind > 0.9 else " ".join(r.sample(vocabulary, r.randint(28, 90)))))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_similar_pairs_against_brute_force(spark, seed):
    docs = texts(seed)
    df = spark.createDataFrame(docs, "id long, title string, content string").withColumn("key", F.lit(1)).withColumn("n", F.lit(2))
    want = sorted((a[0], b[0]) for a in docs for b in docs if a[0] < b[0] and plain.similar(a[1:], b[1:]))
    got = rows(similar_pairs(df), "id_a", "id_b")
    assert len(want) > 10 and not set(got) - set(want)
    assert len(set(want) & set(got)) >= 0.98 * len(want) and len(got) == len(set(got))


def test_similar_pairs_hot_title_and_copies(spark):
    r = random.Random(4)
    v = [f"w{i}" for i in range(2000)]
    docs = [(i, "같은 제목", " ".join(r.sample(v, 60))) for i in range(90)] + [(100 + i, f"t{i}", "같은 글 " + " ".join(v[:40])) for i in range(12)]
    got = rows(similar_pairs(spark.createDataFrame(docs, "id long, title string, content string")), "id_a", "id_b")
    assert got == sorted((100 + i, 100 + k) for i in range(12) for k in range(i + 1, 12))


def test_similar_pairs_of_nothing(spark):
    assert rows(similar_pairs(spark.createDataFrame([], "id long, title string, content string")), "id_a", "id_b") == []


def test_greedy_two_keys(spark):
    df = spark.createDataFrame([(1, "u1", "h1"), (2, "u2", "h1"), (3, "u2", "h2"), (4, None, None), (5, None, "h2")], "i int, u string, h string")
    assert rows(dedup.greedy_two_key(df, "i", "u", "h"), "i") == [(1,), (3,), (4,)]
    r = random.Random(1)
    many = [(i, f"u{r.randrange(40)}", f"h{r.randrange(40)}") for i in range(200)]
    us, hs, want = set(), set(), []
    for i, u, h in many:
        if u not in us and h not in hs:
            us.add(u), hs.add(h), want.append((i,))
    assert rows(dedup.greedy_two_key(spark.createDataFrame(many, "i int, u string, h string"), "i", "u", "h"), "i") == want


def test_store(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 5), ("c", 1), ("c", 0), ("a", 0)], "k string, v int")
    assert rows(store.first_wins(old, new, "k", "v", F.col("v")), "k", "created", "v") == [("a", False, 1), ("b", False, 5), ("c", True, 1)]
    assert rows(store.last_wins(old, new, ["k"], "v"), "k", "v") == [("a", 1), ("b", 5), ("c", 1)]
    assert rows(store.insert_ignore(old, new, ["k"], F.col("v")), "k", "v") == [("c", 0)]
    once = store.first_wins(old, new, "k", "v", F.col("v")).select("k", "v")
    assert rows(store.first_wins(once, new, "k", "v", F.col("v")), "k", "v") == rows(once, "k", "v")
    assert rows(store.sync_set(old, new.select("k").distinct(), ["k"], ["v"]), "k", "v") == [("a", 1), ("b", 2), ("c", None)]
    assert rows(store.delete_keys(old, new.select("k")), "k") == []


def test_filters(spark):
    lo, hi = date(2025, 1, 1), date(2026, 1, 1)
    df = spark.createDataFrame([(1, "2025-06-01"), (2, "2024-01-01"), (3, "2027-01-01"), (4, None), (5, "이상한값"), (6, "2025-02-30"), (7, "2026-01-01")], "i int, d string")
    assert [r[0] for r in df.orderBy("i").select(filters.in_dates(F.col("d"), lo, hi)).collect()] == [True, False, False, True, True, True, True]
    t = spark.createDataFrame([(1, "all english", "text"), (2, "한글", "제목과 본문"), (3, None, None), (4, "", " ")], "i int, t string, c string")
    assert [r[0] for r in t.orderBy("i").select(filters.enough_script(F.col("t"), F.col("c"))).collect()] == [False, True, False, False]
    f = spark.createDataFrame([(200, None), (401, None), (404, None), (429, None), (503, None), (418, None), (None, "timeout"), (None, "connection")], "s int, e string")
    reason, again = filters.fetch_reason(F.col("s"), F.col("e"))
    assert [tuple(r) for r in f.select(reason, again).collect()] == [(None, None), ("access_denied", False), ("not_found", False), ("temporary_http_error", True), ("temporary_http_error", True), ("temporary_http_error", False), ("timeout", True), ("temporary_http_error", True)]


def test_scores(spark):
    now = datetime(2025, 1, 15)
    e = spark.createDataFrame([(1, datetime(2025, 1, 1), 1.0), (1, datetime(2025, 1, 15), 0.0), (2, None, 1.0)], "k int, ts timestamp, value double")
    got = {r.k: r.score for r in scoring.faded_mean(e, "k", now).collect()}
    assert got[1] == pytest.approx(0.5 / 1.5) and got[2] == 0.5
    ev = spark.createDataFrame([("a", datetime(2025, 1, i), i < 3, i) for i in range(1, 8)], "k string, ts timestamp, ok boolean, id int")
    assert rows(scoring.leading_streak(ev, "k"), "k", "streak") == [("a", 5)]
    s = spark.createDataFrame([("l", "t", "p", i < 4) for i in range(40)], "lv2 string, type string, provider string, ok boolean")
    r = scoring.survival(s).select("tier", scoring.multiplier(F.col("rate")).alias("m")).first()
    assert (r.tier, r.m) == (1, 4.0)


def test_words_edge_cases(spark):
    df = spark.createDataFrame([("",), (None,), (" a　b a ",)], "c string")
    assert [r[0] for r in df.select(tx.words(F.col("c"))).collect()] == [[], [], ["a", "b"]]


def test_running_sums(spark):
    r = random.Random(9)
    data = [(r.choice("ab"), i, r.randint(1, 9)) for i in range(500)]
    df = spark.createDataFrame(data, "source string, h long, v long")
    got = {x.h: x.s for x in running(df, ["source"], F.col("h"), F.shiftright("h", 4), "v", "s").collect()}
    for k in "ab":
        total = 0
        for _, h, v in sorted(x for x in data if x[0] == k):
            assert got[h] == total
            total += v


def test_hot_title_loses_no_pair(spark):
    # 70 classes under one title, each pair at 20 of 56 words, 0.357
    docs = [(i, "같은 제목", " ".join([*(f"c{k}" for k in range(20)), *(f"u{i}x{k}" for k in range(18))])) for i in range(70)]
    got = similar_pairs(spark.createDataFrame(docs, "id long, title string, content string"))
    assert sorted((r.id_a, r.id_b) for r in got.collect()) == [(a, b) for a in range(70) for b in range(a + 1, 70)]


def test_split_join(spark):
    from cribble.operators import skew

    data = spark.createDataFrame([("a" if i % 3 else f"k{i}", i) for i in range(300)], "k string, v int")
    small = data.groupBy("k").agg(F.count("*").alias("n")).where("k <> 'k3'").withColumn("x", F.length("k"))
    for hot in (2, 5000):
        skew.HOT, before = hot, skew.HOT
        assert rows(skew.split_join(data, small, ["k"]), "v", "x") == sorted((i, 1 if i % 3 else len(f"k{i}")) for i in range(300) if i != 3)
        skew.HOT = before
