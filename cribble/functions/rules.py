"""Small rules of the reference as column expressions."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from cribble.functions.text import strip

# Retry mode and most attempts by reason; other reasons are never retried.
RETRY = {
    "timeout": ("immediate", 3),
    "temporary_http_error": ("immediate", 3),
    "extraction_empty": ("after_parser_update", 1),
    "extraction_too_short": ("immediate", 2),
    "unexpected_error": ("immediate", 2),
}
# Words and characters that a provider takes in a query, and words that don't count.
QUERY_LIMITS = {"tavily": (5, 40), "serpapi": (5, 45)}
LINK_WORDS = ("그리고", "또는", "및", "혹은")
# Expressions of time, the operator of sites, marks of citations.
DATE_EXPRESSION = r"\d{4}\s*년|\d{1,2}\s*월|최근\s*\d*\s*(년|개월|달)|올해|작년|재작년|지난\s*(달|주|해|년)|이번\s*(년|해|달)"
SITE_OPERATOR = r"site\s*:"
CITATION = r"\s*\(\[[^\]]*\]\([^)]*\)\)"


def most_attempts(reason: Column) -> Column:
    """How often a reason may occur for an address; once where nothing is said."""
    table = F.create_map(*[F.lit(x) for k, (_, n) in RETRY.items() for x in (k, n)])
    return F.coalesce(F.try_element_at(table, reason), F.lit(1))


def is_retryable(reason: Column) -> Column:
    """Whether a discard of the reason may be fetched again at once."""
    return F.coalesce(reason.isin(*[k for k, (mode, _) in RETRY.items() if mode == "immediate"]), F.lit(False))


def query_words(text: Column) -> Column:
    """Words of a query that count."""
    return F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: (w != "") & ~w.isin(*LINK_WORDS))


def _limit(provider: Column, at: int) -> Column:
    c = F.lit(None).cast("int")
    for name, limits in QUERY_LIMITS.items():
        c = F.when(provider == name, limits[at]).otherwise(c)
    return c


def query_fault(text: Column, provider: Column) -> Column:
    """Why a stripped query isn't taken, apart from repetition; null for a sound one. An unknown provider sets no limits."""
    return (
        F.when(text.rlike("(?U)" + DATE_EXPRESSION), "date_expression").when(text.rlike("(?iU)" + SITE_OPERATOR), "site_operator")
        .when(F.size(query_words(text)) > _limit(provider, 0), "too_many_words").when(F.length(text) > _limit(provider, 1), "too_long")
    )


def fits(text: Column, provider: Column) -> Column:
    """Whether a variant of a query keeps the limits of its provider; here all words count."""
    words = F.size(F.filter(F.split(text, r"(?U)[\s\x1c-\x1f]+"), lambda w: w != ""))
    return ~F.coalesce(words > _limit(provider, 0), F.lit(False)) & ~F.coalesce(F.length(text) > _limit(provider, 1), F.lit(False))


def reason_code(c: Column) -> Column:
    """What stands before the first colon."""
    return F.split_part(c, F.lit(":"), F.lit(1))


def decision_reason(code: Column, detail: Column, locality: Column | None = None) -> Column:
    """``code: detail`` and, where given, a note on the relation to Korea; null without a code."""
    text = F.concat_ws(": ", code, detail)
    if locality is not None:
        text = F.when(locality.isNotNull(), F.concat(text, F.lit(" | 한국 관련성: "), locality)).otherwise(text)
    return F.when(code.isNotNull(), text)


def relevance_gate(fit: Column, locality: Column, least: int = 1) -> Column:
    """taxonomy_mismatch, else low_korea_relevance, else null; a missing score passes nothing."""
    bad = lambda c: F.coalesce(c < least, F.lit(True))
    return F.when(bad(fit), "taxonomy_mismatch").when(bad(locality), "low_korea_relevance")


def better_type(name: Column, fit: Column, candidates: Column) -> Column:
    """The proposed type if it is a candidate and fits with at least 3."""
    return F.when((fit >= 3) & F.array_contains(candidates, name), name)


def fetch_guard(blocked: Column, homepage: Column, provider: Column, score: Column, least: float = 0.15) -> Column:
    """Why an address isn't fetched: blocked, a home page, or a low score of the provider that gives scores."""
    return F.when(blocked, "blacklisted_domain").when(homepage, "homepage_url").when((provider == "tavily") & (score < least), "low_relevance_score")


def without_citations(terms: Column) -> Column:
    """Terms without the citation that may follow them."""
    return F.transform(terms, lambda t: strip(F.regexp_replace(t, "(?U)" + CITATION, "")))


def merged_terms(static: Column, fresh: Column, definition: Column, group: Column) -> tuple[Column, Column]:
    """(terms, state): static terms and fresh ones, in this order and distinct; else those of the definition, else of the group."""
    some = lambda c: F.coalesce(F.size(c) > 0, F.lit(False))
    empty = F.array().cast("array<string>")
    both = F.array_distinct(F.concat(F.coalesce(static, empty), F.coalesce(fresh, empty)))
    state = F.when(some(static) & some(fresh), "static_and_fresh").when(some(static), "static_only").when(some(fresh), "fresh_only").when(some(definition), "definition_fallback").otherwise("lv2_fallback")
    return F.when(some(static) | some(fresh), both).when(some(definition), definition).otherwise(F.coalesce(group, empty)), state


def definition_terms(definition: Column, criteria: Column | None = None) -> Column:
    """Terms of a definition and criteria: split at list signs and words, stripped of blanks and stops, up to 20 characters, distinct in order."""
    texts = F.concat(F.array(definition), F.coalesce(criteria, F.array().cast("array<string>"))) if criteria is not None else F.array(definition)
    parts = F.flatten(F.transform(F.filter(texts, lambda x: x.isNotNull()), lambda x: F.split(x, r"(?U)[·,、/]|\s+등\s+|\s+및\s+")))
    parts = F.transform(parts, lambda x: F.regexp_replace(x, r"^[ .]+|[ .]+$", ""))
    return F.array_distinct(F.filter(parts, lambda x: F.length(x).between(1, 20)))


def first_filled(preferred: Column, other: Column) -> Column:
    """The preferred list, or the other where it is missing or empty."""
    return F.when(F.coalesce(F.size(preferred) > 0, F.lit(False)), preferred).otherwise(other)


def months_back(c: Column, n: int) -> Column:
    """The date n months earlier, at the end of a shorter month."""
    return F.add_months(c, -n)


def default_range(today: date, years: int) -> tuple[Column, Column]:
    return F.add_months(F.lit(today), -12 * years), F.lit(today)


def site_query(domains: Column, text: Column) -> Column:
    """A query limited to domains: (site:a OR site:b) text."""
    return F.concat(F.lit("("), F.array_join(F.transform(domains, lambda d: F.concat(F.lit("site:"), d)), " OR "), F.lit(") "), text)


def date_window(lo: date, hi: date) -> str:
    """The date window of a search, ends included."""
    return f"cdr:1,cd_min:{lo:%m/%d/%Y},cd_max:{hi:%m/%d/%Y}"


def ranked(results: Column, link: str, start: Column | None = None) -> Column:
    """(url, rank, score) of search results (array of structs with link, position and score) in order, those without a link left out.

    Without start, ranks are places from 1; with it, start and the result's own position, or its place.
    """
    def one(r: Column, i: Column) -> Column:
        rank = i + 1 if start is None else start + F.coalesce(r["position"], i + 1)
        return F.struct(r[link].alias("url"), rank.cast("int").alias("rank"), r["score"].alias("score"))

    return F.filter(F.transform(results, one), lambda x: x["url"].isNotNull())


def bullet_list(items: Column, empty: str = "(지정된 기준 없음)") -> Column:
    """One line for each item; a text of its own for none."""
    return F.when(F.coalesce(F.size(items) > 0, F.lit(False)), F.array_join(F.transform(items, lambda x: F.concat(F.lit("- "), x)), "\n")).otherwise(F.lit(empty))


def excluded_domains(others: Column, blocked: Column) -> Column:
    return F.array_sort(F.array_union(others, blocked))


def request_digest(*parts: Column) -> Column:
    """A digest of the parts, whatever their order in the call; parts must have names of their own."""
    return F.sha2(F.to_json(F.struct(*parts)), 256)
