import json
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from cribble.functions import plan, rules as ru
from cribble.operators import filters, picks, scorers, store
from cribble.plans import search
from cribble.sources import files
from tests.test_operators import rows


def test_settings_by_precedence_and_ranges():
    assert (plan.effective(3, {"g": 2}, "g", 1), plan.effective(None, {"g": 2}, "g", 1), plan.effective(None, {}, "g", 1)) == (3, 2, 1)
    lo, hi = date(2025, 1, 1), date(2025, 2, 1)
    assert plan.date_range_fault(lo, hi, hi) is None and plan.date_range_fault(hi, lo, hi) == "end before start"
    assert plan.date_range_fault(lo, hi, lo) == "end in the future" and plan.date_range_fault(lo, hi, lo, future=True) is None
    assert plan.can_run([], [(0, 0), (1, 0)]) and not plan.can_run([], [(0, 0)]) and not plan.can_run(["K"], [(1, 1)])
    assert plan.new_run_id() != plan.new_run_id() and len(plan.new_run_id()) == 36


def test_states_of_queries():
    q = plan.added([], 1, "g", "t", "tavily", "글")
    assert plan.added(q, 2, "g", "t", "tavily", "글") == q and q[0]["status"] == "user_created"
    e = plan.edited(q, 1, "새 글", 5)
    assert [(x["id"], x["status"], x["query_text"], x["parent_query_id"]) for x in e] == [(1, "rejected", "글", None), (5, "user_edited", "새 글", 1)]
    assert plan.rejected(q, 1)[0]["status"] == "rejected"
    back, left = plan.reactivated([{**q[0], "status": "used"}], [{"query_id": 1}, {"query_id": 2}], 1)
    assert back[0]["status"] == "generated" and left == [{"query_id": 2}]


def test_throttle():
    now, slept = [0.0], []
    t = plan.Throttle(2.0, clock=lambda: now[0], sleep=slept.append)
    assert [t.wait("a"), t.wait("a"), t.wait("b")] == [0, 2.0, 0] and slept == [2.0]
    now[0] = 10.0
    assert t.wait("a") == 0 and t.call("a", lambda: 7) == 7
    with pytest.raises(ValueError):
        t.call("a", lambda: int("x"))
    assert t.call("a", lambda: 8) == 8


def test_breaker_quota_and_experiments():
    def attempt(e):
        if e["n"] in (1, 3, 4, 5, 6, 7):
            raise KeyError(e["n"])
        return {"status": "accepted", "reason": "quota" if e["n"] == 99 else None}

    out = list(plan.guarded([{"n": n} for n in range(12)], attempt))
    assert len(out) == 8 and out[1]["reason"] == "unexpected_error" and "KeyError" in out[1]["detail"]
    assert len(list(plan.guarded([{"n": 0}, {"n": 99}, {"n": 2}], attempt))) == 2
    log = plan.experiment(["a", "b"], [("queries", lambda g: len(g)), ("run", lambda g: 1 / (g == "a"))])
    assert log[0] == {"lv2_id": "a", "status": "completed", "queries": 1, "run": 1.0} and log[1]["step"] == "run" and log[1]["queries"] == 1
    assert plan.migrated(["a", "old", "gone"], {"old": "new"}, {"b": 0, "a": 1}, ["gone", "never"]) == [("rename", "old", "new"), ("add", "b", 0), ("drop", "gone")]
    assert plan.migrated(["a", "new", "b"], {"old": "new"}, {"b": 0}, ["gone"]) == []


def test_rules_of_results(spark):
    assert ru.date_window(date(2025, 1, 2), date(2025, 12, 31)) == "cdr:1,cd_min:01/02/2025,cd_max:12/31/2025"
    df = spark.createDataFrame([([("u", 4, 0.5), (None, 1, None), ("v", None, None)],)], "r array<struct<link:string,position:int,score:double>>")
    x = df.select(ru.ranked(F.col("r"), "link", F.lit(10)).alias("a"), ru.ranked(F.col("r"), "link").alias("b")).first()
    assert [(y.url, y.rank) for y in x.a] == [("u", 14), ("v", 13)] and [(y.url, y.rank, y.score) for y in x.b] == [("u", 1, 0.5), ("v", 3, None)]
    t = spark.createDataFrame([("제품 2025년 후기", "tavily"), ("지난 달 소식", "tavily"), ("최근 3개월", "x"), ("SITE : a.b", "serpapi"), ("하나 둘 및 셋 넷 다섯", "serpapi"), ("하나 둘 셋 넷 다섯 여섯", "serpapi"), ("하나 둘 셋 넷 다섯 여섯", "other"), ("가" * 41, "tavily"), ("가" * 41, "serpapi")], "t string, p string")
    assert [r[0] for r in t.select(ru.query_fault(F.col("t"), F.col("p"))).collect()] == ["date_expression", "date_expression", "date_expression", "site_operator", None, "too_many_words", None, "too_long", None]
    d = spark.createDataFrame([("가·나, 다/라 등 마 및 바. ", ["가", "사 ", "ㅏ" * 21])], "d string, c array<string>")
    assert d.select(ru.definition_terms(F.col("d"), F.col("c"))).first()[0] == ["가", "나", "다", "라", "마", "바", "사"]
    c = spark.createDataFrame([(["말 ([a.com](u)) ", "글 [1]"],)], "t array<string>")
    assert c.select(ru.without_citations(F.col("t"))).first()[0] == ["말", "글 [1]"]


def test_upserts_by_key(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x")], "id long, k string, v string")
    new = spark.createDataFrame([(7, "b", None), (8, "c", None), (9, "c", None)], "id long, k string, v string")
    assert rows(store.get_or_create(old, new, ["k"], "id"), "asked", "id", "already") == [(7, 2, True), (8, 8, False), (9, 8, True)]
    up = store.update_rows(old, spark.createDataFrame([(2, None), (5, "z")], "id long, v string"), ["id"])
    assert rows(up, "id", "k", "v") == [(1, "a", None), (2, "b", None)]


def test_outcomes_stop_at_the_first_failure(spark):
    df = spark.createDataFrame([(True, True), (False, True), (True, None)], "a boolean, b boolean")
    got = [r[0] for r in df.select(filters.executed(("x", F.col("a")), ("y", F.col("b")))).collect()]
    assert got == [{"x": "pass", "y": "pass"}, {"x": "fail"}, {"x": "pass", "y": "fail"}]


def test_picks(spark):
    b = spark.createDataFrame([("t", 0, 0.5, "2025-01-02"), ("t", 1, 0.5, None), ("t", 2, 0.9, "2025-01-01"), ("u", 0, 0.5, "2025-01-02"), ("u", 1, 0.5, "2025-01-01")], "type_name string, bundle int, score double, last_used_at string")
    assert rows(picks.best_bundle(b), "type_name", "bundle") == [("t", 2), ("u", 1)]
    assert rows(picks.oldest_bundle(b), "type_name", "bundle") == [("t", 1), ("u", 1)]
    # exploration only where scores differ, and of every bundle
    seen = {tuple(rows(picks.best_bundle(b, 1.0, seed), "type_name", "bundle")) for seed in range(12)}
    assert {dict(x)["u"] for x in seen} == {1} and len({dict(x)["t"] for x in seen}) == 3
    q = [("a", 0.1), ("b", 0.9), ("c", 0.5)]
    assert picks.explored(q, 0.0, random.Random(1)) == ["b", "c", "a"] and picks.explored([("a", 0.5), ("b", 0.5000000001)], 1.0, random.Random(1)) == ["a", "b"]
    assert sorted(picks.explored(q, 1.0, random.Random(1))) == ["a", "b", "c"] and picks.explored([], 0.5, random.Random(1)) == []


def test_lanes_take_turns():
    lanes = [search.Lane("g", t, "tavily", 9, [(i, f"{t}{i}") for i in range(3)]) for t in ("t1", "t2")]
    out, _ = search.drive(lanes, lambda x, text, start: [{"url": text, "rank": 1, "score": None}], lambda u: False, {}, {"tavily": 2}, robin=True)
    assert [r["url"] for r in out] == ["t10", "t20", "t11", "t21", "t12", "t22"]


def test_scores_that_are_there_stay(spark):
    docs = spark.createDataFrame([(1, "가나다"), (2, "라마바")], "id long, content string")
    done = scorers.score(docs.where("id = 1"), ["id"], lambda r: {"type_relevance": 5, "overall": 5.0})
    calls = spark.sparkContext.accumulator(0)

    def one(row):
        calls.add(1)
        return {"type_relevance": 1, "overall": 1.0}

    got = rows(scorers.score_new(docs, done, ["id"], one), "id", "overall")
    assert got == [(1, 5.0), (2, 1.0)] and calls.value == 1


def test_rubric(spark):
    part = {"score": 2, "evidence": [{"field": "title", "quote": "q"}], "reason": "r"}
    answer = json.dumps({**{k: part for k in scorers.SCALES}, "context_elements": {"place": "y"}, "issue_tags": ["a"]})
    a, b = spark.createDataFrame([(answer,), ("no json",)], "j string").select(*scorers.rubric_columns(F.col("j"))).collect()
    assert (a.quality_taxonomy_alignment, a.quality_issue_tags) == (2, '["a"]') and json.loads(a.quality_eval_detail)["context_elements"] == {"place": "y"}
    assert tuple(b) == (None,) * 5


def test_generated_queries_and_terms(spark):
    df = spark.createDataFrame([("tavily", "g", "t")], "provider string, taxonomy_lv2 string, type_name string")
    got = scorers.generated(df, lambda r: [" 좋은 글 ", "좋은 글", "", "올해 글", "올해 글"])
    assert sorted((r.query_text, r.rejected) for r in got.collect() if r.rejected) == [("올해 글", "date_expression"), ("올해 글", "date_expression"), ("좋은 글", "duplicate_within_batch")] and got.where("rejected is null").count() == 1
    a = spark.createDataFrame([(["은어 ([a.com](u))", "a@b", "열두 글자를 넘는 아주 긴 표현"], None), (["x1"], 3)], "terms array<string>, calls int")
    assert [(r.terms, r.calls) for r in scorers.fresh_terms(a).collect()] == [(["은어"], 1), ([], 3)]


def test_files_for_people(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    df = spark.createDataFrame([("제목", '줄\n"둘"', None, "u", "s")], "title string, content string, date string, url string, source_domain string")
    files.write_result_file(df, path)
    raw = open(path, "rb").read()
    assert raw.startswith(b"\xef\xbb\xbf") and not (tmp_path / "t.csv.tmp").exists()
    (tmp_path / "g").mkdir()
    (tmp_path / "g" / "k.csv").write_bytes(raw)
    assert [tuple(r)[:3] for r in files.read_results(spark, str(tmp_path / "g")).collect()] == [("제목", '줄\n"둘"', None)]
    assert files.read_baseline(spark, str(tmp_path / "none.csv")).count() == 0
    (tmp_path / "b.csv").write_text("LV2,건수,총_소요시간_초\ng,4,10\nh,0,1\n")
    assert rows(files.read_baseline(spark, str(tmp_path / "b.csv")), "lv2", "seconds_each") == [("g", 2.5), ("h", None)]
    assert files.render({"required_inputs": ["a"], "system": "s {a}", "user": "{{ a }} {b}"}, {"a": 1}) == ("s 1", "1 {b}")
    with pytest.raises(ValueError):
        files.render({"required_inputs": ["a"]}, {})
    assert files.markdown([{"a": 1, "b": None}]) == "| a | b |\n|-|-|\n| 1 |  |" and files.markdown([]) == ""
