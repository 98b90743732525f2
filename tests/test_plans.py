import json
import random

import pytest
from pyspark.sql import functions as F

from cribble.functions import html
from cribble.operators.export import merge_export
from cribble.operators.neardup import observations, verdicts
from cribble.plans import search
from cribble.sources import files
from cribble.streaming import intake
from tests import plain


def test_bundles():
    assert search.bundles(["d1", "d2", "d3", "d4"], {}) == [["d1", "d2", "d3"], ["d2", "d3", "d4"], ["d3", "d4", "d1"], ["d4", "d1", "d2"]]
    assert search.bundles([], {}) == [] and search.bundles(["a", "b"], {}) == [["a", "b"]]
    for b in search.bundles(["a", "b", "c", "d", "e"], {"a": ["d"]}):
        assert ("a" in b) == ("d" in b) and len(b) <= 3


def lanes(n=10, kinds=("t1", "t2"), q=3):
    queries = {("g", t, p): [(i, f"{t} {p} {i}") for i in range(q)] for t in kinds for p in ("tavily", "serpapi")}
    return search.plan_lanes([("g", t) for t in kinds], queries, n, lambda g: 70, lambda *k: 1.0, lambda g, t: True)


def test_lane_targets_and_budgets():
    x, notes = lanes(20)
    assert [(y.type, y.provider, y.target) for y in x] == [("t1", "tavily", 7), ("t1", "serpapi", 3), ("t2", "tavily", 7), ("t2", "serpapi", 3)] and not notes
    assert search.budgets(x, {"tavily": 20, "serpapi": 10}) == {("g", "tavily"): 2.0, ("g", "serpapi"): 2.0}


def test_drive_covers_types_first_and_stops_at_budget():
    x, _ = lanes(40)
    seen = []

    def find(lane, text, start):
        seen.append(lane.type)
        return [{"url": f"https://{text}/{start}/{i}", "rank": i, "score": None} for i in range(3)]

    cache: dict = {}
    out, notes = search.drive(x, find, lambda u: False, cache, {"tavily": 20, "serpapi": 10})
    assert set(seen[:2]) == {"t1", "t2"} and len(out) == 3 * len(seen) and any("budget" in n for n in notes)
    again, _ = search.drive(lanes(40)[0], find, lambda u: False, cache, {"tavily": 20, "serpapi": 10})
    assert len(seen) >= len(out) / 3 and not {o["url"] for o in again} & {o["url"] for o in out}


def test_drive_survives_an_error():
    def find(lane, text, start):
        if lane.provider == "tavily":
            raise RuntimeError("quota")
        return [{"url": text, "rank": 1, "score": 1.0}]

    out, notes = search.drive(lanes(4)[0], find, lambda u: False, {}, {"tavily": 20, "serpapi": 10})
    assert out and any("quota" in n for n in notes)


def test_export_keeps_what_was_exported(spark):
    cols = "seq int, title string, content string, date string, url string, source_domain string"
    old = spark.createDataFrame([(0, "a", "x", "", "https://h/1", "h"), (1, "b", "y", "", "https://h/2/", "h")], cols)
    new = spark.createDataFrame([(0, "a", "x", "", "https://h/9", "h"), (1, "c", "z", "", "https://h/2?ref=1", "h"), (2, "d", "w", "", "https://h/3", "h")], cols)
    assert sorted(r.title for r in merge_export(old, new).collect()) == ["a", "b", "d"]


def test_files(spark, tmp_path):
    df = spark.createDataFrame([("g", "t1", 'say "hi"\nthere', "c, d", "2025-01-01", "u", "s"), ("g", "t2", "x", "y", None, "v", "s")], "lv2 string, type string, title string, content string, date string, url string, source_domain string")
    files.write_results(df, str(tmp_path / "o"))
    path = tmp_path / "in" / "g"
    path.mkdir(parents=True)
    (path / "t1.csv").write_text('﻿title,content,date,url,source_domain\n"say ""hi""\nthere","c, d",2025-01-01,u,s\n', encoding="utf-8")
    got = files.read_results(spark, str(tmp_path / "in")).collect()
    assert [tuple(r) for r in got] == [('say "hi"\nthere', "c, d", "2025-01-01", "u", "s", "g", "t1")]
    (tmp_path / "log.jsonl").write_text("\n".join(json.dumps(x) for x in [{"lv2_id": "a", "run_id": "r1", "target_count": 30, "logged_at": "1"}, {"lv2_id": "a", "run_id": "r2", "target_count": 10, "status": "completed", "logged_at": "2"}, {"lv2_id": "a", "run_id": "r3", "status": "failed", "logged_at": "3"}]))
    assert [tuple(r) for r in files.latest_runs(files.read_run_log(spark, str(tmp_path / "log.jsonl"))).collect()] == [("a", "r2", 30)]


def test_settings(tmp_path):
    text = "# head\na: 1\nb:\n  c: [x, 'y z']\n  d: true\nlist:\n- name: n1\n  types:\n  - name: t\n  - name: u\n- name: n2\nempty:\n"
    cfg = files.parse_settings(text)
    assert cfg == {"a": 1, "b": {"c": ["x", "y z"], "d": True}, "list": [{"name": "n1", "types": [{"name": "t"}, {"name": "u"}]}, {"name": "n2"}], "empty": None}
    assert files.parse_settings("") == {}
    with pytest.raises(FileNotFoundError):
        files.read_settings(str(tmp_path / "none.yaml"))
    every = files.settings_issues({})
    assert len(every) > 15
    sound = {
        "app": {"database": {"path": "p"}, "export": {"final_dir": "f"}}, "blacklist": {"domains": ["x.com"]}, "domain_aliases": {"groups": {"a": ["b"]}}, "retry_policy": {"reasons": {"timeout": {"retry_mode": "immediate"}}, "rate_limit": {"fetch": {}}},
        "collection": {"defaults": {"target_count": 30, "candidate_multiplier": 2}, "candidate_multiplier_options": [2, 3], "query_generation": {"tavily_count_per_type": 1, "serpapi_count_per_type": 1}, "provider_ratio": {"default": {"tavily": 70, "serpapi": 30}}},
        "providers": {"openai": {"model": "m", "query_generation_model": "m", "query_generation_input_price_per_1m_usd": 0, "query_generation_output_price_per_1m_usd": 1, "web_search_price_per_1k_calls_usd": 10, "api_key_env": "K"}, "tavily": {"api_key_env": "K"}, "serpapi": {"api_key_env": "K", "max_pages_per_query": 10}},
        "taxonomy": {"taxonomy": [{"lv2_id": "g", "types": [{"name": "t", "definition": "", "description": "", "include_criteria": [], "exclude_criteria": [], "enabled": True}]}]}, "type_domains": {"types": {"t": {"serpapi_allowed_domains": ["d.com"]}, "g": {"t": {"serpapi_allowed_domains": ["e.com"]}}}},
        "extraction": {"cleaning": {"trailing_section_markers": [], "remove_duplicate_paragraphs": True, "duplicate_paragraph_min_length": 30}},
    }
    assert files.settings_issues(sound) == []
    for name, part, words in (
        ("blacklist", {"domains": ["e.com"]}, "allowed and blocked: e.com"), ("retry_policy", {"reasons": {"x": {"retry_mode": "odd"}}, "rate_limit": {"a": 1}}, "mode of x"), ("domain_aliases", {"groups": {"a": []}}, "domain_aliases: a"),
        ("collection", {**sound["collection"], "provider_ratio": {"default": {"tavily": 60, "serpapi": 30}}}, "sums to 90"), ("type_domains", {"types": {"t": {"u": 3}}}, "t.u"), ("extraction", {"cleaning": {**sound["extraction"]["cleaning"], "duplicate_paragraph_min_length": 0}}, "positive"),
        ("taxonomy", {"taxonomy": [{"lv2_id": "g", "lv2_fallback_vocabulary": "x", "types": sound["taxonomy"]["taxonomy"][0]["types"]}]}, "list of texts"), ("providers", {**sound["providers"], "serpapi": {"api_key_env": "K"}}, "max_pages"), ("app", {}, "database.path"),
    ):
        assert any(words in x for x in files.settings_issues({**sound, name: part})), name


def article(body, head=""):
    return f"<html><head><title>꼬리 제목 - 보배드림 : 게시판</title>{head}</head><body><nav>메뉴</nav>{body}<footer>바닥</footer></body></html>"


LONG = "본문의 문장이 이어진다. " * 20


def test_general_extraction():
    page = article(f"<article><h1>제목</h1><script>x()</script><p>{LONG}</p><img src=a></article>", "<meta property='article:published_time' content='2025-03-01T00:00:00'>")
    title, text, told, why = html.extract(page, "https://x.kr/1", "x.kr", "news")
    assert (title, told[:10], why) == ("제목", "2025-03-01", None) and "메뉴" not in text and "x()" not in text and text.startswith("제목\n본문")
    assert html.extract("", "u", "d")[3] == "extraction_empty" and html.extract("<article>짧다</article><title>t</title>", "u", "d")[3] == "extraction_too_short"
    assert html.extract(article(f"<p>{LONG}</p>", "<meta property='og:title' content=' 밖 제목 '>"), "u", "m.bobaedream.co.kr")[0] == "꼬리 제목"


def test_rules_of_sites():
    body = f"<div class='write_div'>{LONG}</div>"
    gall = lambda title, more="": html.extract(article(f"{title}{body}<span class='gall_date' title='2026-08-27 10:00:00'>08.27</span>", more), "u", "gall.dcinside.com", "community")
    assert gall("<span class='title_subject'>글 제목</span>")[::2] == ("글 제목", "2026-08-27 10:00:00")
    # an empty element of the title wins; without one, meta and then the title element
    assert gall("<span class='title_subject'> </span>", "<meta property='og:title' content='밖'>")[3] == "extraction_too_short"
    assert gall("", "<meta property='og:title' content='밖'>")[0] == "밖" and gall("")[0].startswith("꼬리 제목")
    item = article(f"<span class='subject_inner_text'>t</span><section itemprop='articleBody'>{LONG}</section><span class='regdate'>2025.01.02 (목)</span>")
    assert html.extract(item, "u", "bbs.ruliweb.com")[0::2] == ("t", "2025.01.02 (목)")
    # a short body of the rule isn't replaced by the general way, a missing one is
    assert html.extract(article(f"<span class='title_subject'>t</span><div class='write_div'>짧다</div><article>{LONG}</article>"), "u", "gall.dcinside.com", "community")[3] == "extraction_too_short"
    assert html.extract(article(f"<span class='title_subject'>t</span><article>{LONG}</article>"), "u", "gall.dcinside.com", "community")[3] is None
    insta = article(f"<article>{LONG}</article>", "<meta property='og:title' content='밖'>")
    assert html.extract(insta, "https://www.instiz.net/pt/123", "www.instiz.net", "community")[0] == "밖"


def test_questions_and_answers():
    qa = article(f"<div class='endTitleSection'><b>질문</b> 제목</div><div class='questionDetail'>물음 {LONG}</div><div class='answerDetail'>답 하나</div><div class='answerDetail'>답 둘</div><span class='infoItem'>조회 1</span><span class='infoItem'>작성일 2025.05.06</span>")
    url = "https://kin.naver.com/qna/detail.naver?d1id=1&docId=2"
    title, text, told, why = html.extract(qa, url, "kin.naver.com", "qna")
    assert (title, told, why) == ("질문 제목", "작성일 2025.05.06", None) and text.endswith("\n\n답 하나\n\n답 둘")
    node = {"questionContent": "첫 물음의 본문은 이렇게 시작한다 https://a.b/c", "x": [{"answer_body": "하나뿐인 대답의 본문은 이렇다고 한다"}, {"answer_body": "사진"}, {"replyText": "둘째 대답의 본문은 또 다르다고 한다"}, {"answerTitle": "본문이 아닌 것은 여기에 들지 않는다"}]}
    page = article(f"<script id='__NEXT_DATA__' type='application/json'>{json.dumps(node)}</script>")
    title, text, _, _ = html.extract(page, url, "kin.naver.com", "qna")
    assert title == "첫 물음의 본문은 이렇게 시작한다" and text.count("본문은") == 3
    # a list page is no article for the rule
    assert html.extract(qa, "https://kin.naver.com/qna/list.naver", "kin.naver.com", "qna")[0] != "질문 제목"


def test_extraction_columns(spark):
    html.register("own.example", lambda h, u: ("제목", LONG, "2025.07.08"))
    df = spark.createDataFrame([(article(f"<article>{LONG}</article>"), "u", "x.kr", "news"), (None, "u", "x.kr", None), ("<p>", "u", "own.example", None)], "h string, u string, d string, c string")
    got = df.select(html.extract_article(F.col("h"), F.col("u"), F.col("d"), F.col("c")).alias("x"), html.title_tag(F.col("h")).alias("t"), html.kind(F.lit("m.ruliweb.com")).alias("k"), html.kind(F.lit("x.kr")).alias("n"), html.least_length(F.col("c")).alias("l")).collect()
    assert (got[0].x.reason, got[0].t, got[0].k, got[0].n, got[0].l) == (None, "꼬리 제목 - 보배드림 : 게시판", "community", None, 200)
    assert got[1].x.reason == "extraction_empty" and got[2].x.published_date == "2025-07-08" and got[1].l == 100
    noisy = spark.createDataFrame([("a<script>x</script >b<IMG src=x>c<style>\n</style>d",)], "h string")
    assert noisy.select(html.without_noise(F.col("h"))).first()[0] == "abcd"
    raw = spark.createDataFrame([(bytearray("한글".encode("cp949")), None), (bytearray("한글".encode()), "text/html"), (bytearray("<meta charset=euc-kr>한글".encode("cp949")), ""), (None, None)], "b binary, h string")
    assert [r[0] for r in raw.select(html.decoded("b", "h")).collect()] == ["한글", "한글", "<meta charset=euc-kr>한글", None]


def test_near_duplicate_verdicts(spark):
    a = [f"w{i}" for i in range(40)]
    docs = [(1, "하나의 제목", " ".join(a)), (2, "다른 것", " ".join(a[:30] + ["x"] * 3)), (3, "하나의 제목", "전혀 다른 글"), (4, "끝", "y"), (5, "", " ".join(a[:20] + [f"z{i}" for i in range(20)])), (6, None, None)]
    got = {r.id: (r.matched_id, r.by_title) for r in verdicts(spark.createDataFrame(docs, "id long, title string, content string")).collect()}
    assert got == {2: (1, False), 3: (1, True)}


@pytest.mark.parametrize("block", [32768, 25])
def test_near_duplicate_observations(spark, block):
    r = random.Random(5)
    pool = [f"w{i}" for i in range(60)]
    docs = [(i, r.choice(["", None, f"제목 {r.randrange(40)}", f"같은 뜻의 긴 제목 하나 {r.randrange(5)}"]), " ".join(r.sample(pool, r.randint(5, 25)))) for i in range(150)]
    docs += [(150, "제목", docs[3][2]), (151, "끝", None), (152, "", ""), (153, "혼자", "아무도 안 쓴 낱말"), (154, "혼자", "또 다른 말")]
    # 14 of 34 words in common, 0.41: a duplicate by the help of its title only
    docs += [(155, "아주 길게 이어지는 하나의 특별한 제목이다", " ".join(f"p{i}" for i in range(24))), (156, "아주 길게 이어지는 하나의 특별한 제목이다.", " ".join(f"p{i}" for i in range(10, 34)))]
    want = plain.observations(docs)
    got = {x.id: (x.matched_id, round(x.title_similarity, 9), round(x.content_similarity, 9), x.would_exclude) for x in observations(spark.createDataFrame(docs, "id long, title string, content string"), block).collect()}
    assert got == want
    assert any(v[2] < 0.35 and not v[3] for v in want.values()) and any(v[1] == 1.0 for v in want.values()) and any(v[2] < 0.45 and v[3] and v[1] < 1 for v in want.values())


def test_stream(spark, tmp_path):
    rows = [(1, 1, "t", "c", "https://h/a?ref=1", "h", None), (2, 1, "t2", "c2", "https://h/b", "h", None), (3, 2, "t", "c", "https://h/z", "h", None), (4, 2, "t3", "c3", "https://h/a/", "h", None)]
    df = spark.createDataFrame(rows, intake.SCHEMA).withColumn("collected_at", F.lit("2025-01-01 00:00:00").cast("timestamp"))
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    for b in (1, 2):
        df.where(F.col("batch_no") == b).coalesce(1).write.mode("append").parquet(src)
        q = intake.candidates(spark, src).writeStream.foreachBatch(intake.store_new(spark, out)).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        q.awaitTermination(120)
    assert sorted(r.incoming_id for r in spark.read.parquet(out).collect()) == [1, 2]
