"""Queries of single rules, one or a few columns each, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cribble.functions import html, rules as ru
from cribble.operators import filters
from cribble.sources.tables import table

Q: dict = {}
SQL: dict = {}


def query(sql: str):
    def add(f):
        Q[f.__name__], SQL[f.__name__] = f, sql
        return f

    return add


@query(
    """WITH e AS (SELECT event_id, [200, 401, 404, 429, 503, 418, 403, NULL][event_id % 8 + 1] AS s, CASE WHEN event_id % 8 = 7 THEN CASE WHEN event_id % 3 = 0 THEN 'timeout' ELSE 'connection' END END AS e FROM events),
r AS (SELECT event_id, s, e, CASE WHEN e = 'timeout' THEN 'timeout' WHEN e = 'connection' THEN 'temporary_http_error' WHEN s IN (401, 403) THEN 'access_denied' WHEN s = 404 THEN 'not_found' WHEN s >= 400 THEN 'temporary_http_error' END AS reason FROM e)
SELECT event_id, reason, CASE WHEN reason IS NOT NULL THEN e IS NOT NULL OR coalesce(s >= 500 OR s = 429, false) END AS again FROM r"""
)
def fetch_outcomes(s: SparkSession, d: str) -> DataFrame:
    """Reasons of fetches by status and error; both are made from the event's number."""
    n = F.col("event_id") % 8
    status = F.try_element_at(F.array(*[F.lit(x) for x in (200, 401, 404, 429, 503, 418, 403)]), (n + 1).cast("int"))
    error = F.when(n == 7, F.when(F.col("event_id") % 3 == 0, "timeout").otherwise("connection"))
    e = table(s, d, "events").select("event_id", status.alias("s"), error.alias("e"))
    reason, again = filters.fetch_reason(F.col("s"), F.col("e"))
    return e.select("event_id", reason.alias("reason"), again.alias("again"))


@query(
    """SELECT id, list_sort(list_distinct(list_filter(list_transform(list_concat(regexp_split_to_array(query_text || '·' || type_name || ' 및 ' || provider || '.', '[·,、/]|\\s+등\\s+|\\s+및\\s+'), [created_by || ' ']), lambda x: trim(x, ' .')), lambda x: len(x) BETWEEN 1 AND 20))) AS terms FROM search_queries"""
)
def definition_pieces(s: SparkSession, d: str) -> DataFrame:
    text = F.concat("query_text", F.lit("·"), "type_name", F.lit(" 및 "), "provider", F.lit("."))
    return table(s, d, "search_queries").select("id", F.array_sort(ru.definition_terms(text, F.array(F.concat("created_by", F.lit(" "))))).alias("terms"))


@query("SELECT id, CASE WHEN id % 3 = 0 THEN '(지정된 기준 없음)' ELSE '- ' || type_name || chr(10) || '- ' || query_text END AS text FROM search_queries")
def criteria_text(s: SparkSession, d: str) -> DataFrame:
    items = F.when(F.col("id") % 3 != 0, F.array("type_name", "query_text"))
    return table(s, d, "search_queries").select("id", ru.bullet_list(items).alias("text"))


@query("SELECT id, [trim(query_text), 'b [1] (x)'] AS terms FROM search_queries")
def cited_terms(s: SparkSession, d: str) -> DataFrame:
    terms = F.array(F.concat("query_text", F.lit(" ([a.com](https://a.com/x))")), F.lit("b [1] (x)"))
    return table(s, d, "search_queries").select("id", ru.without_citations(terms).alias("terms"))


@query("SELECT taxonomy_lv2 AS lv2, list_sort(list_distinct(list_concat(list(DISTINCT provider || '.example'), ['a.example', 'serpapi.example']))) AS excluded FROM search_queries GROUP BY 1")
def excluded_domains(s: SparkSession, d: str) -> DataFrame:
    own = F.collect_set(F.concat("provider", F.lit(".example")))
    blocked = F.array(F.lit("a.example"), F.lit("serpapi.example"))
    return table(s, d, "search_queries").groupBy(F.col("taxonomy_lv2").alias("lv2")).agg(ru.excluded_domains(own, blocked).alias("excluded"))


PAGE_SQL = "'<html><head><TITLE lang=\"ko\"> ' || title || '  끝</TITLE><script>var a = \"</b>\";</script ><img src=\"x\">' || coalesce(published_date, '') || '</head>'"


@query(
    f"""SELECT id, regexp_replace(trim(title || '  끝'), '[ \\t]+', ' ', 'g') AS page_title, regexp_replace(regexp_replace({PAGE_SQL}, '<script>.*</script >', ''), '<img[^>]*>', '') AS rest,
  CASE WHEN regexp_matches(coalesce(published_date, ''), '[0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') THEN replace(regexp_extract(published_date, '([0-9]{{4}}\\.[0-9]{{2}}\\.[0-9]{{2}}|[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})', 1), '.', '-') END AS told,
  CASE source_category WHEN 'news' THEN 200 WHEN 'community' THEN 50 WHEN 'qna' THEN 80 ELSE 100 END AS least, CASE WHEN id % 3 = 0 THEN 'community' WHEN id % 3 = 1 THEN 'qna' END AS kind FROM contents"""
)
def page_parts(s: SparkSession, d: str) -> DataFrame:
    """Rules of pages on pages made of titles and dates, and of domains made of ids."""
    page = F.concat(F.lit('<html><head><TITLE lang="ko"> '), "title", F.lit('  끝</TITLE><script>var a = "</b>";</script ><img src="x">'), F.coalesce("published_date", F.lit("")), F.lit("</head>"))
    domain = F.when(F.col("id") % 3 == 0, "m.ruliweb.com").when(F.col("id") % 3 == 1, "kin.naver.com").otherwise(F.lit("ruliweb.com.example"))
    return table(s, d, "contents").select("id", html.title_tag(page).alias("page_title"), html.without_noise(page).alias("rest"), html.iso_date(F.col("published_date")).alias("told"), html.least_length(F.col("source_category")).alias("least"), html.kind(domain).alias("kind"))


@query("SELECT id, returned_url AS url, 10 + coalesce(rank, 1) AS rank, 1 AS place, relevance_score AS score FROM content_discoveries")
def ranked_results(s: SparkSession, d: str) -> DataFrame:
    """Results of one page: ranks from the page's start and the result's own position, and places; a result without a link is left out."""
    one = lambda link, position: F.struct(link.alias("link"), position.cast("int").alias("position"), F.col("relevance_score").alias("score"))
    results = F.array(one(F.col("returned_url"), F.col("rank")), one(F.lit(None).cast("string"), F.lit(9)))
    r = table(s, d, "content_discoveries").select("id", ru.ranked(results, "link", F.lit(10)).alias("a"), ru.ranked(results, "link").alias("b"))
    return r.select("id", F.explode(F.arrays_zip("a", "b")).alias("x")).select("id", "x.a.url", "x.a.rank", F.col("x.b.rank").alias("place"), "x.a.score")


@query("SELECT content_id, run_id, taxonomy_lv2, type_name, scored_at, CASE WHEN type_relevance >= 3 AND type_name IN (SELECT DISTINCT type_name FROM search_queries WHERE provider = 'serpapi') THEN type_name END AS better FROM content_quality_scores")
def better_types(s: SparkSession, d: str) -> DataFrame:
    """The scored type where it fits and is among the candidates, a list of settings."""
    known = sorted(r[0] for r in table(s, d, "search_queries").where("provider = 'serpapi'").select("type_name").distinct().collect())
    return table(s, d, "content_quality_scores").select("content_id", "run_id", "taxonomy_lv2", "type_name", "scored_at", ru.better_type(F.col("type_name"), F.col("type_relevance"), F.array(*map(F.lit, known))).alias("better"))


@query("SELECT id, sha256(CAST(json_object('provider', provider, 'query_text', query_text) AS VARCHAR)) AS digest FROM search_queries")
def request_digests(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "search_queries").select("id", ru.request_digest(F.col("provider"), F.col("query_text")).alias("digest"))


@query("SELECT id, CASE WHEN id % 2 = 0 THEN [query_text] ELSE [type_name] END AS criteria, strftime(created_at::DATE - INTERVAL 12 MONTH, '%Y-%m-%d') AS since FROM search_queries")
def effective_criteria(s: SparkSession, d: str) -> DataFrame:
    """A type's own list where it isn't empty, else the common one; and the day a year before."""
    own = F.when(F.col("id") % 2 == 0, F.array("query_text")).when(F.col("id") % 3 == 0, F.array().cast("array<string>"))
    return table(s, d, "search_queries").select("id", ru.first_filled(own, F.array("type_name")).alias("criteria"), ru.months_back(F.col("created_at").cast("date"), 12).cast("string").alias("since"))


@query("SELECT lv2, CAST(ceil(target * 2.0) AS BIGINT) AS candidates, greatest(0, 60 - found) AS deficit FROM (SELECT q.taxonomy_lv2 AS lv2, 50 AS target, count(*) AS found FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id WHERE q.provider = 'serpapi' GROUP BY 1)")
def lane_deficits(s: SparkSession, d: str) -> DataFrame:
    """Candidates to look for, and how many a group still lacks of sixty."""
    q = table(s, d, "search_queries").where("provider = 'serpapi'").select(F.col("id").alias("query_id"), F.col("taxonomy_lv2").alias("lv2"))
    n = table(s, d, "content_discoveries").select("query_id").join(q, "query_id").groupBy("lv2").agg(F.count("*").alias("found"))
    return n.select("lv2", F.ceil(F.lit(50) * F.lit(2.0)).alias("candidates"), F.greatest(F.lit(0), F.lit(60) - F.col("found")).alias("deficit"))


def queries() -> dict:
    return Q


def oracle_sql() -> dict:
    return SQL

