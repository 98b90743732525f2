import base64
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cribble.llm import boilerplate, cuts, lines, mixing, pii, residue, tokens


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


# -- repeated lines

LINES = [
    (1, "a", "공통으로 나오는 안내문 123\n본문 하나\n"), (2, "a", "다른 본문\r\n 공통으로  나오는 안내문 4\r\n"), (3, "a", "공통으로 나오는 안내문 9\n공통으로 나오는 안내문 10"), (4, "a", "x"), (5, "b", "공통으로 나오는 안내문 1"), (6, None, "공통으로 나오는 안내문 1"),
    (7, "a", None), (8, "a", ""),
]


def test_repeated_lines(spark):
    df = spark.createDataFrame(LINES, "id long, site string, content string").withColumn("line", F.lit(1)).withColumn("n", F.lit(1))
    assert rows(lines.repeated_lines(df, 3), "id", "line_no") == [(1, 0), (2, 1), (3, 0), (3, 1)]
    assert rows(lines.repeated_lines(df.limit(0), 3), "id", "line_no") == []


def plain_repeated(docs, least):
    """{id: line numbers} by counting in Python; lines here are already normal."""
    held = Counter((s, x) for _, s, c in docs for x in set(c.split("\n")) if len(x) >= 10)
    return {i: hit for i, s, c in docs if (hit := {k for k, x in enumerate(c.split("\n")) if held[s, x] >= least and len(x) >= 10})}


def test_deltas_equal_one_pass(spark):
    r = random.Random(1)
    docs = [(i, r.choice("ab"), "\n".join(f"반복되는 줄 번호{chr(97 + r.randrange(9))}" for _ in range(4))) for i in range(60)]
    df = spark.createDataFrame(docs, "id long, site string, content string")
    state = lines.LineCounts(spark, 10)
    crossed = [state.merge_partition(df.where(F.col("id") % 3 == k)) for k in range(3)]
    total = crossed[0].unionByName(crossed[1]).unionByName(crossed[2])
    keys = ["site", "h1", "h2"]
    assert rows(total, *keys) == rows(state.repeated(), *keys) and total.count() == total.select(*keys).distinct().count() > 0
    want = plain_repeated(docs, 10)
    for parts in (1, 2, 3):
        assert rows(lines.repeated_lines(df, 10, parts), "id", "line_no") == sorted((i, k) for i, hit in want.items() for k in hit)
    assert rows(state.holders(total), "id") == sorted((i,) for i in want)
    before = rows(state.repeated(), *keys, "n")
    state.compact()
    assert state.deltas == 1 and rows(state.repeated(), *keys, "n") == before and rows(state.holders(total), "id") == sorted((i,) for i in want)


def test_only_documents_of_crossed_lines_are_rebuilt(spark, monkeypatch):
    docs = [(i, "a", f"앞서 되풀이된 안내 줄\n글 {chr(0xAC00 + i)} 하나뿐인 줄이다") for i in range(6)] + [(10 + i, "a", f"뒤에 되풀이될 안내 줄\n글 {chr(0xAC00 + i)} 하나뿐인 줄이야") for i in range(4)] + [(20, "b", "앞서 되풀이된 안내 줄")]
    later = [(30, "a", "뒤에 되풀이될 안내 줄"), (31, "a", "앞서 되풀이된 안내 줄\n또 다른 글이 있는 줄"), (32, "a", "아무것도 되풀이되지 않는 줄"), (33, "c", None)]
    first, second = (spark.createDataFrame(x, "id long, site string, content string") for x in (docs, later))
    state, built = lines.LineCounts(spark, 5), []
    real = lines.rebuild
    monkeypatch.setattr(lines, "rebuild", lambda d, c: built.append(sorted(x.id for x in d.collect())) or real(d, c))
    got = {x.id: x.content for x in lines.maintain(state, [first, second]).collect()}
    assert built == [[0, 1, 2, 3, 4, 5], [10, 11, 12, 13, 30, 31]]
    assert set(got) == {0, 1, 2, 3, 4, 5, 10, 11, 12, 13, 30, 31}
    assert got[30] == "" and got[31] == "또 다른 글이 있는 줄" and got[0] == "글 가 하나뿐인 줄이다" and got[10] == "글 가 하나뿐인 줄이야"


# -- page bodies

BODY = ["처음", "가운데", "마지막", "새벽", "오후", "주말"]


def pages(n=24, host="h"):
    """Pages of one site: menus, a consent line, bodies with subheads, links under a heading, a byline, a long notice."""
    r = random.Random(3)
    out = []
    for i in range(n):
        body = [f"{r.choice(BODY)} {i}번 글의 {a} 문장은 {r.choice(BODY)} {chr(0xAC00 + i * 37 + k)}에서 이어진다." for k, a in enumerate(("첫", "둘째", "셋째"))]
        lines = ["대문 | 소식 | 알림", "쓰기 · 알림" if i % 2 else "대문", body[0], "무엇이 바뀌나", body[1], "새날 특가 모음 바로가기" if i % 3 else "끼어든 말", body[2]]
        lines += ["더 읽을거리", f"◇ “{r.choice(BODY)} {chr(0xAC00 + i * 91)}” 이야기", f"◇ {chr(0xB000 + i * 17)} 두고 논란", f"글쓴이 {chr(0xAC00 + i * 11)}솔 a{i}@b.co"]
        lines += ["이 자리에 놓인 글을 옮기려면 " + "미리 허락을 얻어야 하며 " * 12 + "그렇지 않으면 안 됩니다."]
        out.append((i, host, "새날" if i % 4 else None, "\n".join(lines)))
    return out


def test_tree_matching():
    assert boilerplate.match_lines(list("abcd"), list("axcd")) == [(0, 0), (2, 2), (3, 3)]
    assert boilerplate.match_trees([["m", "x"], ["f"]], [["m"], ["y"], ["f", "z"]]) == [(1, 0, 2, 0), (0, 0, 0, 0)]
    assert boilerplate.match_trees([], [["a"]]) == [] and boilerplate.match_trees([["a"]], [["b"]]) == []


@pytest.mark.parametrize("part", [512, 5])
def test_wrapper_decides(spark, part, monkeypatch):
    """Constants around the body, slots of the site, links under their heading and bylines go; subheads and sentences stay, however long the template's lines are."""
    monkeypatch.setattr(boilerplate, "PAGES", part)
    docs = pages() + [(900, "h", None, None), (901, "h", None, ""), (902, None, None, "하나뿐인 글이다.\n제목 없는 줄")]
    df = spark.createDataFrame(docs, "id long, host string, name string, content string").withColumn("spread", F.lit(1)).withColumn("part", F.lit(1))
    got = rows(boilerplate.furniture(df), "id", "line_no")
    want = sorted((i, k) for i, _, _, c in pages() for k in ([0, 1] + ([5] if i % 3 else []) + [7, 8, 9, 10, 11]))
    assert got == want
    body = {r.id: r.content for r in boilerplate.main_body(df).collect()}
    assert len(body) == len(docs) and body[1].split("\n")[1] == "무엇이 바뀌나" and len(body[1].split("\n")) == 4
    assert rows(boilerplate.furniture(df.limit(0)), "id") == []


def test_one_page_hosts_take_what_is_constant_over_hosts(spark):
    more = [(1000 + k, f"one{k}", "새날", c) for k, (_, _, _, c) in enumerate(pages(6))]
    df = spark.createDataFrame(pages() + more, "id long, host string, name string, content string")
    got = rows(boilerplate.furniture(df).where("id >= 1000"), "id", "line_no")
    assert {k for i, k in got if i == 1001} == {0, 1, 5, 7, 8, 9, 10, 11}


# -- personal information


def test_field_on_held_out_frames():
    """Sentences of frames that training never sees."""
    w, right, found, true = pii.weights(), 0, 0, 0
    assert not {f for k, v in pii.FRAMES.items() if k.startswith("held") for f in v} & {f for k, v in pii.FRAMES.items() if not k.startswith("held") for f in v}
    for t, gold in pii.training(800, seed=77, held=True):
        got = set(pii.decode(t, w))
        right += len(got & set(gold))
        found += len(got)
        true += len(gold)
    assert right / found > 0.93 and right / true > 0.9


def parts_of(cs):
    from itertools import combinations

    fits = lambda part: all(x[1] <= y[0] or y[1] <= x[0] for x, y in combinations(part, 2))
    return [p for n in range(len(cs) + 1) for p in combinations(cs, n) if fits(p)]


def test_decode_and_marginals_equal_enumeration():
    """The dynamic programs find the best segmentation, the partition function and each span's probability."""
    w = pii.weights()
    for t, _ in pii.training(150, seed=3):
        cs = pii.candidates(t)[:9]
        value = dict(zip(cs, pii.scores(t, cs, w)))
        every = parts_of(cs)
        total = [sum(value[c] for c in p) for p in every]
        assert sum(value[c] for c in pii.decode(t, w, cs)) == pytest.approx(max(total))
        small = {c: v / 8 for c, v in value.items()}
        weight = [math.exp(sum(small[c] for c in p)) for p in every]
        z, probability = pii.marginals(cs, [small[c] for c in cs])
        assert z == pytest.approx(math.log(sum(weight)))
        assert probability == pytest.approx([sum(x for x, p in zip(weight, every) if c in p) / sum(weight) for c in cs])


def test_finder_equals_the_plain_field():
    """Kept parts of scores and the bound that leaves spans out change nothing."""
    w = pii.weights()
    f = pii.Finder(w)
    for t, _ in [*pii.training(300, seed=12), *pii.training(100, seed=13, held=True)]:
        assert sorted(f.line(t)) == sorted(pii.decode(t, w))


def test_candidates_are_all_spans_of_a_form():
    t = "가람시 나루구 한울로 58 118동 814호, a.b@c.example 010-1234-5678"
    got = {(t[a:b], k) for a, b, k in pii.candidates(t)}
    assert {("가람시 나루구 한울로 58", "address"), ("가람시 나루구 한울로 58 118동", "address"), ("가람시 나루구 한울로 58 118동 814호", "address"), ("나루구 한울로 58", "address")} - got <= {("나루구 한울로 58", "address")}
    assert {("a.b@c.example", "email"), ("b@c.example", "email"), ("010-1234-5678", "phone"), ("나루", "name"), ("나루구", "name")} <= got
    assert pii.candidates("") == []


def test_find_and_redact(spark):
    text = "작성자는 남궁서름 씨로 확인됐다. 연락처 ０１０-１１１１-２２２２ 문자 주세요.\n메일 ab.c[at]mail[dot]example 로, 제보자 김모(33)씨와 A씨는 그대로. 택배 송장에는 한울시 나루구 한울로 58 118동 814호 주소가 있다."
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, "가" * 20000), (5, text)], "id long, content string").withColumn("pii_type", F.lit(1))
    got = rows(pii.find(df).where("id = 1"), "pii_type", "pii_value")
    assert got == [("address", "한울시 나루구 한울로 58 118동 814호"), ("email", "ab.c[at]mail[dot]example"), ("name", "남궁서름"), ("phone", "０１０-１１１１-２２２２")]
    out = {r.id: r.content for r in pii.redact(df).collect()}
    assert out[2] is None and out[3] == "" and "[NAME] 씨로" in out[1] and "김모(33)씨" in out[1] and "[PHONE] 문자" in out[1]


# -- residue

NOTICE = "404 Not Found\nThe requested resource was not found on this server."
DOCS = [
    (1, "글", NOTICE), (2, "글", NOTICE + "\n(code: bcdfghjklmnp)"), (3, "글", "본문에 {{ reporter.name }} 기자가 있다."), (4, "글", "화면에 ‘{{이름}}’ 같은 표시가 노출됐다."), (5, "undefined - 새날", "보통의 글이다."), (6, "글", "보통의 글이다. 404 Not Found 안내만 보였다고 한다."),
    (7, None, None), (8, "", ""), (10, "글", "${변수} 표기를 예로 들었다."), (11, "글", "교재는 undefined 값과 null 값을 적었다."), (12, "[단독] 제목", "글 [object Object] 글"), (13, "글", NOTICE + "\n" + " ".join(f"이 글에는 {k}째 낱말{k} 다음에{k} 또 본문{k} 이어진다." for k in range(20))), (14, "%%TITLE%%", "본문이다."), (15, "다른 글", NOTICE),
]


def residue_docs(spark, docs):
    return spark.createDataFrame(docs, "id long, site string, title string, content string").withColumn("main", F.lit(0)).withColumn("n", F.lit(0))


def test_residue(spark):
    df = residue_docs(spark, [(i, f"s{i % 3}", t, c) for i, t, c in DOCS])
    assert rows(residue.residue_ids(df), "id") == [(1,), (2,), (3,), (5,), (12,), (14,), (15,)]
    assert rows(residue.residue_ids(df.limit(0)), "id") == []


def test_templates_that_recur(spark):
    """A message of no known words is a template once many sites send it; a longer reposted article, and a page with a text of its own, are none."""
    said = "zq {} wertig\nupsala mortig donk"
    docs = [(i, f"s{i}", f"제목 {i}", said.format(i)) for i in range(20)]
    article = "\n".join(" ".join(f"낱말{a}x{k}" for k in range(40)) for a in range(5))
    docs += [(100 + i, f"s{i}", "글", article) for i in range(9)] + [(200, "s1", "글", "zq 7 wertig\n여기에는 글이 더 있다\nupsala mortig donk")] + [(300 + i, "s1", "글", "한 사이트에만 있는 짧은 글 모음") for i in range(9)]
    m = residue.messages(residue_docs(spark, docs)).cache()
    assert rows(residue.of_templates(m), "id") == [(i,) for i in range(20)]
    assert residue.templates(m).where("recurs").count() == 1


def test_fillers(spark):
    """Words of messages only make filler, wherever they come from; what longer texts use doesn't."""
    r = random.Random(2)
    filler, usual = [f"blor{k}" for k in range(12)], [f"낱말{k}" for k in range(400)]
    docs = [(i, f"s{i % 5}", "글", " ".join(r.choices(filler, k=15))) for i in range(15)] + [(100 + i, f"s{i % 5}", "글", " ".join(r.sample(usual, 150))) for i in range(30)] + [(200 + i, f"s{i % 5}", "글", " ".join(r.sample(usual, 12))) for i in range(15)]
    df = residue_docs(spark, [*docs, (300, "s", None, None), (301, "s", "", " \n ")])
    assert rows(residue.fillers(df), "id") == [(i,) for i in range(15)]


# -- tokens


@pytest.fixture(scope="module")
def enc():
    return tokens.encoding(tokens.vocabulary())


def test_chunks_stitch_exactly(enc):
    r = random.Random(5)
    pieces = ["가나다", "word", "don't", " ", "  ", "\n", "\t\n ", "123", "🙂", "é", "!!!", "'ll", "x" * 90, " " * 70, "한글과 English 섞임"]
    for size, overlap in ((60, 20), (200, 64), (33, 30)):
        for _ in range(60):
            t = "".join(r.choice(pieces) for _ in range(r.randint(0, 80)))
            ids = tokens.encode_chunked(t, enc, size, overlap)
            assert ids == enc.encode_ordinary(t)
            assert tokens.decode(ids, enc) == t


def test_encode_table(spark, enc):
    long = "긴 글 more words  " * 400
    df = spark.createDataFrame([(1, "짧은 글"), (2, ""), (3, None), (4, long), (5, "a" * 3000), (6, "짧은 글")], "id long, text string").withColumn("start", F.lit(1))
    got = {r.id: r.ids for r in tokens.encode(df, size=512, overlap=64).collect()}
    assert got == {1: enc.encode_ordinary("짧은 글"), 2: [], 3: [], 4: enc.encode_ordinary(long), 5: enc.encode_ordinary("a" * 3000), 6: enc.encode_ordinary("짧은 글")}
    for size in (512, tokens.CHUNK):
        assert {r.id: r.tokens for r in tokens.token_counts(df, size=size, overlap=64).collect()} == {k: len(v) for k, v in got.items()}
    assert len(long) > tokens.CHUNK


# -- mixing


def test_mixture(spark):
    r = random.Random(3)
    docs = [(i, "a" if i < 900 else "b" if i < 1000 else "c", r.randint(50, 400)) for i in range(1100)] + [(5000, "x", 10)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.3, 4), ("c", 0.1, 3), ("none", 0.1, 2)], "source string, target_share double, max_repeats int")
    m = mixing.mixture(sizes, targets).cache()
    rep = {r.source: r for r in mixing.report(m, targets).collect()}
    assert rep["none"].tokens == 0 and set(rep) == {"a", "b", "c", "none"}
    for s, share in (("a", 5 / 9), ("b", 3 / 9), ("c", 1 / 9)):
        assert abs(rep[s].actual_share - share) < 0.02
    assert rep["b"].most_repeats <= 4 and rep["a"].most_repeats <= 2 and rep["c"].most_repeats <= 3
    assert m.groupBy("doc_id", "copy_no").count().where("count > 1").isEmpty()
    # each stretch of slots is near the shares
    slots = m.select("slot", "source").distinct().orderBy("slot").collect()
    half = [x.source for x in slots[: len(slots) // 2]]
    assert abs(half.count("a") / len(half) - 5 / 9) < 0.1
    assert mixing.mixture(sizes.limit(0), targets).count() == 0


def test_repeat_cap_holds_for_texts(spark):
    # source a: 6 documents of 2 texts; text t0 also stands in b, which allows more
    docs = [(i, "a", f"t{i % 2}", 100) for i in range(6)] + [(10, "b", "t0", 100)] + [(11 + i, "b", f"u{i}", 100) for i in range(4)]
    sizes = spark.createDataFrame(docs, "doc_id long, source string, text_key string, tokens long")
    targets = spark.createDataFrame([("a", 0.5, 1), ("b", 0.5, 3)], "source string, target_share double, max_repeats int")
    m = mixing.mixture(sizes, targets).cache()
    text = {d: t for d, _, t, _ in docs}
    times = Counter(text[r.doc_id] for r in m.collect())
    assert times["t0"] == times["t1"] == 1 and max(times.values()) <= 3
    rep = {r.source: r for r in mixing.report(m, targets).collect()}
    assert (rep["a"].tokens, rep["a"].texts, rep["a"].most_repeats, rep["b"].tokens) == (200, 2, 1, 200)
    # the report counts texts, whatever documents they come from
    twice = spark.createDataFrame([(0, "a", "t0", 100), (2, "a", "t0", 100)], "doc_id long, source string, text_key string, tokens long")
    assert {r.source: (r.texts, r.most_repeats) for r in mixing.report(twice, targets).collect()} == {"a": (1, 2), "b": (0, 0)}


def test_every_block_gets_its_slot(spark):
    """Sources of tiny shares, and one whose goal rounds to nothing."""
    r = random.Random(1)
    for _ in range(6):
        goals = [(f"s{i}", float(r.choice([0, 1, 5, 8192, 100_000, 3_000_000, 40_000_000]))) for i in range(r.randint(1, 24))]
        g = spark.createDataFrame(goals, "source string, goal double").withColumn("goal", F.col("goal").cast("long"))
        got = {x.source: (x.n, x.top) for x in mixing.schedule(g).groupBy("source").agg(F.count_distinct("block").alias("n"), F.max("block").alias("top")).collect()}
        assert got == {s: (max(1, math.ceil(n / mixing.BLOCK)), max(1, math.ceil(n / mixing.BLOCK)) - 1) for s, n in goals}
    sizes = spark.createDataFrame([(i, "big", 9000) for i in range(300)] + [(1000, "small", 50)], "doc_id long, source string, tokens long")
    targets = spark.createDataFrame([("big", 0.999999, 1), ("small", 0.000001, 1)], "source string, target_share double, max_repeats int")
    m = mixing.mixture(sizes, targets)
    assert m.where("source = 'small'").count() == 1


# -- cuts


@pytest.mark.parametrize(
    "text, verdict",
    [
        ("온전한 문장이다.", 0), ("끝이 잘린 문장의 중", 1), ("문장이 끝났다. 다음 문장이 뒤늦...", 1), ("잘 모르겠어요…", 0), ("요약했다고 설명했... [전문보기]", 1), ("문장이다.\n- 글쓴이 드림", 0), ("문장이다.\n#태그 #둘", 0), ("글자가 깨�", 1), ("태그가 <a href=", 1), ("익명 파&quo", 1),
        ("문장이다.ㅋㅋㅋ", 0), ("도와주세요ㅠ", 0), ("문장이다. (끝)", 0), ("그렇게 저장했다고 밝혔다", 2), ("", 0), ("   ", 0), ("Parents in town before readers le", 1), ("All is said. Thanks in advance", 0), ("글의 끝.\n1) 신분증\n2) 신청서", 0), ("세 번째 … (계속)", 1), ("그가 물었다. 라고 물었다\"", 0),
    ],
)
def test_judge(text, verdict):
    assert cuts.judge(text) == verdict


def test_longer_copies(spark):
    full = "문장 하나가 여기에 길게 이어진다. " * 8 + "그렇게 저장했다고 밝혔다. 더 있는 글이다."
    part = full[: full.index("밝혔다") + 3]
    docs = [(1, "a", full), (2, "a", part), (3, "b", "짧게 말했다고 밝혔다"), (4, "b", None), (5, "b", ""), (6, "b", part), (7, None, "끊긴 글의 중")]
    df = spark.createDataFrame(docs, "id long, source string, text string").withColumn("key", F.lit(1)).withColumn("next", F.lit(1))
    v = cuts.verdicts(df)
    assert rows(v.where("cut"), "id") == [(2,), (6,), (7,)]
    assert {(r.source, r.texts, r.cut_texts) for r in cuts.rates(v).collect()} == {("a", 2, 1), ("b", 4, 1), (None, 1, 1)}
    assert cuts.verdicts(df.limit(0)).count() == 0


def test_every_text_is_looked_up(spark):
    """Short texts, texts that end like complete ones, texts with a mark behind a verb, and long ends of sounds."""
    full = "원주율은 3.14이다. 그는 \"끝났다.\"라고 말했다. 그리고 이어진 글이 더 있다"
    docs = [
        (1, "a", full + "."), (2, "a", "원주율은 3."), (3, "a", full[: full.index("라고")]), (4, "a", "원주율은 3.14이다. [전문보기]"), (5, "a", "그리고 이어진 글이 더 있다"), (6, "a", "원"), (7, "a", full + " ... [더보기]"), (8, "a", full + ".  "),
        (9, "b", "요"), (10, "b", "요 앞의 글."), (11, "b", "다른 글이다.\n둘째 줄이다."), (12, "b", "다른 글이다."), (13, "b", "문장이 끝났다" + "ㅋ" * 700), (14, "b", "문장의 가운데 뒤늦" + " " * 500 + "..." ), (15, "b", "그렇게 말했다 [전문보기]"), (16, "b", "그렇게 말했다고 전했다."),
    ]
    df = spark.createDataFrame(docs, "id long, source string, text string").withColumn("n", F.lit(1)).withColumn("whole", F.lit(1))
    plain = set()
    for i, _, x in docs:
        for y in {x.rstrip(), cuts.unmarked(x) or x.rstrip()}:
            longer = [z for _, _, z in docs if z.startswith(y) and len(z.rstrip()) > len(y)]
            if any(not z[len(y)].isspace() for z in longer) or longer and cuts.judge(x) == 2:
                plain.add(i)
        if cuts.judge(x) == 1:
            plain.add(i)
    got = {r.id for r in cuts.verdicts(df).where("cut").collect()}
    assert got == plain
    assert {2, 3, 6, 7, 14, 15} <= got and not got & {1, 4, 8, 10, 11, 12, 13, 16}


def test_marks_are_no_longer_copy(spark):
    """Dots of style behind a complete text are cut neither by themselves nor by texts that differ in marks alone."""
    docs = [
        (1, "a", "공지를 고지했다. 잘 모르겠어요…"), (2, "a", "모두 끝났다. 힘드네요..."), (3, "b", "모두 끝났다. 힘드네요"), (4, "b", "다음 회에 계속됩니다..."), (5, "b", "다음 회에 계속됩니다…  "), (6, "b", "그렇게 말했다고 밝혔다"), (7, "b", "그렇게 말했다고 밝혔다..."),
        (8, "c", "They copied printer cases, about 5 of them...."), (9, "c", "길게 쓴 글이다. 정말 힘드네요..."), (10, "c", "길게 쓴 글이다. 정말 힘드네요라고 말했다..."), (11, "c", "They copied licence li...."), (12, "c", "They copied licence links..."), (13, "c", "모르겠어요..."), (14, "c", "모르겠어요..."),
    ]
    df = spark.createDataFrame(docs, "id long, source string, text string")
    assert rows(cuts.verdicts(df).where("cut"), "id") == [(9,), (11,), (12,)]


@pytest.mark.parametrize("text, verdict", [("about 5 of them....", 0), ("about 5 of them.... [more]", 0), ("about 5 of the...", 1), ("about 5 of the ....", 1), ("about 5 of them. ...", 0), ("about 5 of them.…", 0)])
def test_stop_before_dots(text, verdict):
    assert cuts.judge(text) == verdict


def test_beginnings_against_brute_force(spark):
    r = random.Random(8)
    docs = [(i, "s", "".join(r.choice("ab ") for _ in range(r.randint(0, 70 if i % 5 else 3)))) for i in range(400)]
    docs += [(1000 + i, "s", docs[r.randrange(400)][2][: r.randint(0, 60)]) for i in range(100)]
    df = spark.createDataFrame(docs, "id long, source string, text string")
    found = {x.id: x.goes_on for x in cuts.longer_copies(df.select("id", "source", "text").mapInArrow(cuts._looks, cuts.LOOKS), df.where("text <> ''").select("id", "text")).collect()}
    want = {}
    texts = {x for _, _, x in docs}
    for i, _, x in docs:
        y = x.rstrip()
        hits = [z[len(y)] for z in texts if y and z.startswith(y) and len(z.rstrip()) > len(y)]
        if hits:
            want[i] = any(not h.isspace() for h in hits)
    assert found == want
