"""Extraction of articles from HTML, with rules by site; runs in Arrow batches on Python's own parser.

A site's rule names the elements of title, body and date. The first element that is there decides, even if it is empty.
Where a rule finds no body, the general way follows: the article element or the body, without menus and forms.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from itertools import islice
from urllib.parse import parse_qs, urlsplit

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from cribble.functions.clean import clean_text

# Elements whose text is none, elements that the general way leaves out too, elements without an end tag.
NOISE = {"script", "style", "template", "iframe", "img"}
FRAME = {"noscript", "nav", "footer", "header", "aside", "form", "button"}
VOID = {"br", "img", "meta", "link", "input", "hr", "source", "area", "base", "col", "embed", "wbr"}
#: Least length of a text by kind of source.
LEAST = {"news": 200, "community": 50, "qna": 80}
LEAST_ELSE = 100


class Page(HTMLParser):
    """The pieces of text of each element that is asked for, by name: a tag, .class, #id or [itemprop]; meta values; the embedded JSON."""

    def __init__(self, wanted: set[str]):
        super().__init__(convert_charrefs=True)
        self.wanted = wanted | {"article", "body", "title"}
        self.open: list[tuple[str, list[list[str]]]] = []
        self.found: dict[str, list[list[str]]] = {}
        self.values: dict[str, dict] = {}
        self.meta: dict[str, str] = {}
        self.data = ""

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "meta":
            self.meta.setdefault(a.get("property") or a.get("name") or "", a.get("content", ""))
        names = {tag, *(f".{c}" for c in a.get("class", "").split()), f"#{a.get('id', '')}", f"[{a.get('itemprop', '')}]"} & self.wanted
        for n in names:
            self.values.setdefault(n, a)
        if tag not in VOID:
            pieces: list[list[str]] = [[] for _ in names]
            for n, p in zip(names, pieces):
                self.found.setdefault(n, []).append(p)
            self.open.append((tag if a.get("id") != "__NEXT_DATA__" else "__NEXT_DATA__", pieces))

    def handle_endtag(self, tag):
        at = next((i for i in range(len(self.open) - 1, -1, -1) if self.open[i][0] in (tag, "__NEXT_DATA__")), None)
        if at is not None:
            del self.open[at:]

    def handle_data(self, data):
        tags = {t for t, _ in self.open}
        if "__NEXT_DATA__" in tags:
            self.data += data
        elif not tags & NOISE and (s := " ".join(data.split())):
            mark = bool(tags & FRAME)
            for _, pieces in self.open:
                for p in pieces:
                    p.append((s, mark))

    def texts(self, name: str, sep: str = "\n", general: bool = False) -> list[str]:
        """Text of each element of the name."""
        return [sep.join(s for s, framed in p if not (general and framed)) for p in self.found.get(name, [])]

    def first(self, names: list[str], sep: str = "\n") -> str | None:
        """Text of the first of the elements that is there."""
        return next((t[0] for n in names if (t := self.texts(n, sep))), None)


# By domain the elements of title, body and date (a second body is added to the first), the attribute that holds the date, the path of an article.
RULES: dict[str, dict] = {
    "82cook.com": {"title": [".bbstitle"], "body": ["#articleBody", ".articleBody"], "date": ".readRight"},
    "gall.dcinside.com": {"title": [".title_subject"], "body": [".write_div", "[articleBody]"], "date": ".gall_date", "attribute": "title"},
    "bbs.ruliweb.com": {"title": [".subject_inner_text"], "body": [".view_content", "[articleBody]"], "date": ".regdate"},
    "instiz.net": {"body": ["article"], "path": r"/\d+/?$", "meta": True},
    "kin.naver.com": {"title": [".endTitleSection"], "body": [".questionDetail"], "more": ".answerDetail", "date": ".infoItem", "label": "작성일", "path": r"^/qna/detail\.naver$", "query": "docId", "json": True},
}
RULES |= {"www." + d: RULES[d] for d in ("82cook.com", "instiz.net")}
# What the title element of a site carries behind the title, where the title element is the better one.
TITLE_SUFFIX = {"bobaedream.co.kr": r"\s*-\s*보배드림[^-]*$", "m.bobaedream.co.kr": r"\s*-\s*보배드림[^-]*$"}
# Kind of source by domain and the domains under it.
KINDS = {
    "ruliweb.com": "community", "82cook.com": "community", "gall.dcinside.com": "community", "kin.naver.com": "qna", "instiz.net": "community", "bobaedream.co.kr": "community", "coinpan.com": "community",
    "inven.co.kr": "community", "mlbpark.donga.com": "community", "okky.kr": "community", "paxnet.co.kr": "community", "ppomppu.co.kr": "community",
}
# Words of keys in embedded JSON, labels that are no text.
QUESTION, ANSWER, TEXT_KEYS = ("question", "inquiry"), ("answer", "reply"), ("content", "body", "detail", "text")
LABELS = {"이미지", "사진", "답변하기", "채택하기", "공유", "신고", "목록", "더보기"}

#: Readers of further sites: domain to function (html, url) -> (title, body, date text) or None where it finds no body.
READERS: dict[str, Callable[[str, str], tuple | None]] = {}


def register(domain: str, reader: Callable[[str, str], tuple | None]) -> None:
    """Sets the reader of a domain; it comes before any rule."""
    READERS[domain] = reader


def kind(domain: Column) -> Column:
    """The kind of a domain: that of the first listed domain that it is or lies under."""
    return F.coalesce(*[F.when((domain == d) | F.endswith(domain, F.lit("." + d)), F.lit(k)) for d, k in KINDS.items()])


def least_length(category: Column) -> Column:
    c = F.lit(LEAST_ELSE)
    for k, n in LEAST.items():
        c = F.when(category == k, n).otherwise(c)
    return c


def iso_date(text: Column) -> Column:
    """The first date with dots or hyphens in a text, with hyphens; null without one."""
    d = F.regexp_extract(text, r"(\d{4}\.\d{2}\.\d{2}|\d{4}-\d{2}-\d{2})", 1)
    return F.when(d != "", F.translate(d, ".", "-"))


def _pairs(node) -> Iterator[tuple[str, object]]:
    """(key, value) of nested JSON, in order."""
    if isinstance(node, dict):
        for k, v in node.items():
            yield k, v
            yield from _pairs(v)
    elif isinstance(node, list):
        for v in node:
            yield from _pairs(v)


def readable(value) -> str | None:
    """A text of at least 15 characters with Korean letters, without addresses; null for anything else."""
    t = " ".join(re.sub(r"https?://\S+", "", value).split()) if isinstance(value, str) else ""
    return t if len(t) >= 15 and re.search("[가-힣]", t) and t not in LABELS else None


def json_texts(node, about: tuple[str, ...], most: int) -> list[str]:
    """Up to most distinct texts of nested JSON whose key speaks of one of the words and of content."""
    has = lambda key, words: any(w in key.lower().replace("_", "") for w in words)
    texts = (t for k, v in _pairs(node) if has(k, about) and has(k, TEXT_KEYS) and (t := readable(v)))
    return list(islice(dict.fromkeys(texts), most))


def _embedded(data: str) -> tuple[str, str] | None:
    """(title, body) from a page's JSON: the question and up to three answers."""
    try:
        node = json.loads(data)
    except ValueError:
        return None
    asked, told = json_texts(node, QUESTION, 1), json_texts(node, ANSWER, 3)
    parts = asked + told
    return (parts[0][:60], "\n\n".join(parts)) if parts else None


def by_rule(page: Page, rule: dict, url: str) -> tuple | None:
    """(title, body, date text) by a site's rule; null where it finds no body."""
    parts = urlsplit(url)
    if not re.search(rule.get("path", ""), parts.path) or rule.get("query", "") and not parse_qs(parts.query).get(rule["query"]):
        return None
    if rule.get("meta"):
        body = page.first(rule["body"])
        return None if body is None or "og:title" not in page.meta else (page.meta["og:title"].strip(), body, page.meta.get("article:published_time"))
    title, body = page.first(rule["title"], " " if rule.get("json") else ""), page.first(rule["body"])
    if rule.get("json"):
        if title is None or body is None:
            title, body = _embedded(page.data) or (None, None)
        else:
            body = "\n\n".join([body, *page.texts(rule["more"])])
    elif title is None:
        title = page.meta.get("og:title", "").strip() or (page.first(["title"], "") or "")
    if body is None:
        return None
    dates = page.texts(rule["date"], " ")
    told = page.values.get(rule["date"], {}).get(rule["attribute"]) if "attribute" in rule else next((x for x in dates if rule.get("label", "") in x), None)
    return title, body, told


def extract(html: str | None, url: str, domain: str, category: str | None = None, cleaning: dict | None = None) -> tuple:
    """(title, content, date text, reason): reason is null, extraction_empty or extraction_too_short.

    The rule of the domain comes first; only where it finds no body does the general way follow. cleaning: settings of
    the line cleaner.
    """
    if not html:
        return None, None, None, "extraction_empty"
    rule = RULES.get(domain)
    asked = {n for k in ("title", "body") for n in (rule or {}).get(k, [])} | {(rule or {}).get(k, "") for k in ("date", "more")} - {""}
    page = Page(asked | {"h1"})
    page.feed(html)
    got = READERS[domain](html, url) if domain in READERS else by_rule(page, rule, url) if rule else None
    if got is None:
        body = next((t[0] for n in ("article", "body") if (t := page.texts(n, general=True)) and t[0]), None)
        if body is None:
            return None, None, None, "extraction_empty"
        title = page.meta.get("og:title", "").strip() or page.first(["h1"], "") or page.first(["title"], "") or ""
        if domain in TITLE_SUFFIX:
            title = re.sub(TITLE_SUFFIX[domain], "", page.first(["title"], "") or "").strip() or title
        got = title, body, page.meta.get("article:published_time")
    title, body, told = got
    content = clean_text(body, cleaning or {})
    short = not title or len(content) < LEAST.get(category or "", LEAST_ELSE)
    return title, content, told, "extraction_too_short" if short else None


EXTRACTED = T.StructType([T.StructField(n, T.StringType()) for n in ("title", "content", "told", "reason")])


def extract_article(html: Column, url: Column, domain: Column, category: Column, cleaning: dict | None = None) -> Column:
    """Struct (title, content, published_date, reason) of each page."""

    @F.pandas_udf(EXTRACTED)
    def run(h: pd.Series, u: pd.Series, d: pd.Series, c: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([extract(a, b or "", e or "", f, cleaning) for a, b, e, f in zip(h, u, d, c)], columns=EXTRACTED.names)

    x = run(html, url, domain, category)
    return F.struct(x["title"].alias("title"), x["content"].alias("content"), iso_date(x["told"]).alias("published_date"), x["reason"].alias("reason"))


def title_tag(html: Column) -> Column:
    """Text of the first title element, entities left as they are."""
    from cribble.functions.text import normalize_whitespace

    return normalize_whitespace(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1))


def without_noise(html: Column) -> Column:
    """HTML without script, style, template, iframe and img elements."""
    return F.regexp_replace(html, r"(?is)<(script|style|template|iframe)\b.*?</\1\s*>|<img\b[^>]*>", "")


@F.pandas_udf(T.StringType())
def decoded(body: pd.Series, header: pd.Series) -> pd.Series:
    """Bytes of a page as text: by the charset that the header names, else by one that the page names, else UTF-8 or Korean EUC where UTF-8 fails."""

    def one(b, h):
        if b is None:
            return None
        told = re.search(r"charset=[\"']?([\w-]+)", h or "", re.I) or re.search(rb"<meta[^>]{0,200}charset=[\"']?([\w-]+)", b[:4096], re.I)
        name = told.group(1) if told else None
        for c in [name.decode() if isinstance(name, bytes) else name, "utf-8", "cp949"]:
            try:
                if c:
                    return b.decode(c)
            except (UnicodeDecodeError, LookupError):
                continue
        return b.decode("utf-8", "replace")

    return pd.Series([one(b, h) for b, h in zip(body, header)], dtype=object)
