import hashlib
import random

import pytest
from pyspark.sql import functions as F

from cribble.functions import text as tx, urls as ur
from cribble.functions.clean import clean_text
from tests import plain

URLS = [
    "HTTP://Example.com/a/b/?utm_source=x&b=2&a=1#section", "http://example.com/a/b", "http://example.com/a/b/", "https://m.co.kr/news.html?idxno%5cu003d333363=", "https://m.co.kr/news.html?idxno\\u003d333363",
    "https://example.com/post/\\u003d-review", "https://www.newsis.com", "https://u:p@Host.COM:8080/x//?Ref=1&q=%EA%B0%80+b&q=&z", "https://a.b/?x=~*%2A&y=%zz&&k", "//host/p?b#f", "https://a.b/c?d=e?f=g&h=1#i?j", " https://a.b/c?UTM_Source=1 ", "", "plain text", "https://a.b/?%5Cu0026x=1", "https://a.b?q=1",
]
TEXTS = ["a  b\t\tc\r\nd\r\r\r\re\n\n\n\nf ", "", " 　 x y \x1c", "한글  텍스트\r\n\r\n\r\n끝", "\n\n\n", "A" * 50]
TITLES = ["[단독] 제목!!! - 새날일보", "[속보][제보]제목 | 매체", "모바일: 제목...", "재게시 - 재게시 제목??", "a · b", "", "[0123456789abc] 긴 태그", "끝 - " + "x" * 25, "제목 - 매체\n", "  공백 제목  "]


def run(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.select("i", f(F.col("v")).alias("o")).orderBy("i").select("o").collect()]


# The normal form of each of URLS, by hand from the rule: scheme and host lower, no fragment, no tracking keys, sorted pairs, form encoding.
NORMAL = [
    'http://example.com/a/b?a=1&b=2',
    'http://example.com/a/b',
    'http://example.com/a/b',
    'https://m.co.kr/news.html?idxno=333363',
    'https://m.co.kr/news.html?idxno=333363',
    'https://example.com/post/\\u003d-review',
    'https://www.newsis.com/',
    'https://u:p@host.com:8080/x?q=&q=%EA%B0%80+b&z=',
    'https://a.b/?k=&x=~%2A%2A&y=%25zz',
    '//host/p?b=',
    'https://a.b/c?d=e%3Ff%3Dg&h=1',
    'https://a.b/c',
    '/',
    'plain text',
    'https://a.b/?x=1',
    'https://a.b/?q=1',
]


def test_normalize_url(spark):
    assert run(spark, URLS, ur.normalize_url) == NORMAL


def test_normalize_url_properties(spark):
    """The normal form is its own; order and tracking keys don't matter, nor do fragments and final slashes."""
    r = random.Random(3)
    keys = ["a", "B", "가", "k%20x", "x+y", "~", "*", "1"]
    pairs = [[f"{r.choice(keys)}={r.choice(keys)}" for _ in range(r.randint(0, 5))] for _ in range(150)]
    plain_form = ["https://Host.example/p/q" + ("?" + "&".join(p) if p else "") for p in pairs]
    other = []
    for p in pairs:
        q = [*p, "utm_source=z", "Ref=1", "gclid="]
        r.shuffle(q)
        other.append("HTTPS://host.EXAMPLE/p/q/?" + "&".join(q) + r.choice(["", "#part", "#"]))
    once = run(spark, plain_form, ur.normalize_url)
    assert run(spark, other, ur.normalize_url) == once and run(spark, once, ur.normalize_url) == once
    assert all(x.startswith("https://host.example/p/q") and "utm" not in x and not x.endswith("/") for x in once)


def test_url_of_null(spark):
    assert run(spark, [None], ur.normalize_url) == [None]


def test_text_rules(spark):
    squeezed = ['a b c\nd\n\ne\n\nf', '', 'x y', '한글 텍스트\n\n끝', '', 'AAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAAA']
    assert run(spark, TEXTS, tx.normalize_whitespace) == squeezed
    assert run(spark, TITLES, tx.normalize_title) == ['제목!', '제목', '제목.', '', 'a', '', '[0123456789abc] 긴 태그', '끝 - xxxxxxxxxxxxxxxxxxxxxxxxx', '제목', '공백 제목']
    # the digest of the squeezed text in lower case; differing blanks and line ends at the end don't matter
    sound = (0, 1, 3, 4, 5)
    assert run(spark, [TEXTS[k] for k in sound], lambda c: tx.content_hash(F.lit("T"), c)) == [hashlib.sha256(f"t\n{squeezed[k].lower()}".rstrip().encode()).hexdigest() for k in sound]
    same = run(spark, ["a  b\n\n", "a b", "A\tB \r\n"], lambda c: tx.content_hash(F.lit("T"), c))
    assert len(set(same)) == 1
    assert run(spark, TEXTS, tx.fingerprint) == [" ".join(sorted(set(t.split()))) for t in TEXTS]


def test_title_cosine(spark):
    pairs = [("가나다라", "가나다마"), ("", "a"), ("a", "a"), ("aaaa", "aa"), ("x y", "xy")]
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "i int, a string, b string")
    got = [r.o for r in df.select("i", tx.title_cosine(F.col("a"), F.col("b")).alias("o")).orderBy("i").collect()]
    assert got == pytest.approx([plain.cosine(*p) for p in pairs])


def test_site(spark):
    assert run(spark, ["WWW.Narae.example:443", "narae.example..", "www.www.x", None, "a.b:80"], tx.site) == ["narae.example", "narae.example", "www.x", None, "a.b"]


def test_blocked_and_homepage(spark):
    assert run(spark, ["www.bad.com", "bad.com:80", "notbad.com", "x.bad.com."], lambda c: ur.is_blocked(c, ["bad.com"])) == [True, True, False, True]
    assert run(spark, ["https://www.newsis.com/", "https://x.com/view/?id=1", "https://x.com/a"], ur.is_homepage) == [True, False, False]


CFG = {"leading_short_line_max_length": 5, "trailing_section_markers": ["무단전재"], "trailing_bullet_prefixes": ["▶", "-"], "trailing_bullet_min_run": 2, "trailing_search_window": 6, "remove_duplicate_paragraphs": True, "duplicate_paragraph_min_length": 8}
BODY = "본문이 되는 긴 문장 하나입니다."
MANY = "\n".join(f"{i} 번째의 서로 다른 문장입니다." for i in range(8))


@pytest.mark.parametrize(
    "text, want",
    [
        (f"홈\n메뉴\n{BODY}", BODY), (f"{BODY}\n무단전재 금지\n남는 말", BODY), (f"{BODY}\n홍길동 기자 a@b.co\n뒤", BODY), (f"{BODY}\n관련\n▶ 하나\n▶ 둘", BODY), (f"{BODY}\n- 하나만\n이어지는 문장입니다.", f"{BODY}\n- 하나만\n이어지는 문장입니다."),
        (f"{BODY}\n{BODY}\n짧음\n짧음", f"{BODY}\n짧음\n짧음"), ("", ""), ("가\n나\n다\n라\n마\n바\n" + BODY, "바\n" + BODY), (f"{BODY}\n무단전재\n{MANY}", f"{BODY}\n무단전재\n{MANY}"),
    ],
)
def test_clean(text, want):
    assert clean_text(text, CFG) == want
