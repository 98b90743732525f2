"""Queries of the reference's own operators: texts, addresses, filters, deduplication, tables and their changes."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cribble.functions import rules as ru, text as tx, urls as ur
from cribble.functions.clean import clean_article
from cribble.operators import dedup, filters, neardup, store
from cribble.plans import reports, rules
from cribble.sources.tables import table

#: The fixed present of queries with ages.
NOW = datetime(2025, 9, 1)
DATES = (date(2024, 1, 1), date(2025, 6, 30))
BLOCKED = ["narae-news.example", "solbit-blog.example"]
CLEANING = {
    "leading_short_line_max_length": 12, "leading_short_line_max_count": 5, "trailing_section_markers": ["저작권자", "무단전재"], "trailing_bullet_prefixes": ["▶", "■", "-"],
    "trailing_bullet_min_run": 2, "trailing_search_window": 15, "remove_duplicate_paragraphs": True, "duplicate_paragraph_min_length": 30,
}
Q: dict = {}
SQL: dict = {}
# The same patterns in the oracle's dialect.
S = {
    "ws": r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]",
    "norm": r"regexp_replace(regexp_replace(regexp_replace(regexp_replace({x}, '\r\n?', chr(10), 'g'), '[ \t]+', ' ', 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), '^{ws}+|{ws}+$', '', 'g')",
}


def norm_sql(x: str) -> str:
    return S["norm"].format(x=x, ws=S["ws"])


def title_sql(x: str) -> str:
    x = rf"regexp_replace(regexp_replace(regexp_replace({x}, '\[[^\]]{{0,12}}\]', '', 'g'), '{S['ws']}*[-|·]{S['ws']}*[^-|·]{{1,20}}$', ''), '(모바일|재게시|전재|송고){S['ws']}*[:\-]?{S['ws']}*', '', 'g')"
    x = rf"regexp_replace({x}, '(!)!+|(\?)\?+|(\.)\.+|(…)…+|(,),+|(~)~+', '\1\2\3\4\5\6', 'g')"
    return f"regexp_replace(regexp_replace({x}, '{S['ws']}+', ' ', 'g'), '^ | $', '', 'g')"


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


# -- texts and addresses


@query(f"SELECT id, {norm_sql('content')} AS content FROM contents")
def normalize_whitespace(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", tx.normalize_whitespace(F.col("content")).alias("content"))


@query(f"SELECT id, sha256(lower({norm_sql('title || chr(10) || content')})) AS digest, content_hash AS stored FROM contents")
def content_hash(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", tx.content_hash(F.col("title"), F.col("content")).alias("digest"), F.col("content_hash").alias("stored"))


@query(f"SELECT id, {title_sql('title')} AS title FROM contents")
def normalize_title(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", tx.normalize_title(F.col("title")).alias("title"))


@query(f"SELECT id, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(content, '{S['ws']}+'), lambda x: x <> ''))), ' ') AS fingerprint FROM contents")
def content_fingerprint(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", tx.fingerprint(F.col("content")).alias("fingerprint"))


@query("SELECT id, normalized_url AS url FROM discarded_candidates")
def normalize_url(s: SparkSession, d: str) -> DataFrame:
    """The stored normalised address is the oracle."""
    return table(s, d, "discarded_candidates").select("id", ur.normalize_url(F.col("original_url")).alias("url"))


@query("SELECT d.id, c.canonical_url AS url FROM content_discoveries d JOIN contents c ON c.id = d.content_id")
def discovered_url(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "contents").select(F.col("id").alias("content_id"))
    return table(s, d, "content_discoveries").join(c, "content_id", "left_semi").select("id", ur.normalize_url(F.col("returned_url")).alias("url"))


@query("SELECT id, regexp_matches(normalized_url, '^[a-z][a-z0-9+.-]*://[^/?#]*/$') AS homepage, regexp_extract(original_url, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1) AS domain FROM discarded_candidates")
def homepage_and_domain(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "discarded_candidates").select("id", ur.is_homepage(F.col("normalized_url")).alias("homepage"), ur.authority(F.col("original_url")).alias("domain"))


@query(
    """WITH h AS (SELECT id, regexp_replace(regexp_replace(lower(source_domain), ':.*$', ''), '\\.+$', '') AS h FROM contents)
SELECT id, h IN ('narae-news.example', 'solbit-blog.example') OR ends_with(h, '.narae-news.example') OR ends_with(h, '.solbit-blog.example') AS blocked FROM h"""
)
def blacklist_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", ur.is_blocked(F.col("source_domain"), BLOCKED).alias("blocked"))


DATE_SQL = r"CASE WHEN regexp_matches(published_date, '^\d{4}-\d{2}-\d{2}$') THEN try_cast(published_date AS DATE) END"


@query(f"SELECT id, coalesce({DATE_SQL} BETWEEN DATE '2024-01-01' AND DATE '2025-06-30', true) AS ok FROM contents")
def date_range_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", filters.in_dates(F.col("published_date"), *DATES).alias("ok"))


RATIO_SQL = f"(len(regexp_replace(t, '[^가-힣]', '', 'g')) / nullif(len(t), 0))"
STRIPPED_SQL = f"regexp_replace(title || ' ' || content, '^{S['ws']}+|{S['ws']}+$', '', 'g')"


@query(f"SELECT id, coalesce({RATIO_SQL} >= 0.3, false) AS ok FROM (SELECT id, {STRIPPED_SQL} AS t FROM contents)")
def script_ratio_filter(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", filters.enough_script(F.col("title"), F.col("content")).alias("ok"))


CASCADE_SQL = f"""SELECT id, CASE WHEN h IN ('narae-news.example', 'solbit-blog.example') OR ends_with(h, '.narae-news.example') OR ends_with(h, '.solbit-blog.example') THEN 'blacklisted_domain'
  WHEN NOT coalesce({DATE_SQL} BETWEEN DATE '2024-01-01' AND DATE '2025-06-30', true) THEN 'date_out_of_range'
  WHEN NOT coalesce({RATIO_SQL} >= 0.3, false) THEN 'low_korea_relevance' END AS reason
FROM (SELECT *, regexp_replace(regexp_replace(lower(source_domain), ':.*$', ''), '\\.+$', '') AS h, {STRIPPED_SQL} AS t FROM contents)"""


@query(CASCADE_SQL)
def filter_cascade(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", filters.cascade(*DATES, BLOCKED).alias("reason"))


@query(f"SELECT coalesce(reason, 'accepted') AS outcome, count(*) AS n FROM ({CASCADE_SQL}) GROUP BY ALL")
def cascade_summary(s: SparkSession, d: str) -> DataFrame:
    return filter_cascade(s, d).groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n"))


@query()
def clean_articles(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", clean_article(F.col("content"), CLEANING).alias("content"))


@query(
    """WITH t AS (SELECT id, regexp_replace(coalesce(title_normalized, ''), '\\s', '', 'g') AS x FROM contents),
g AS (SELECT id, CASE WHEN len(x) = 1 THEN [x] ELSE list_transform(range(1, greatest(len(x), 1)), lambda i: x[i:i + 1]) END AS g FROM t),
j AS (SELECT a.id, a.g AS ga, b.g AS gb FROM g a JOIN g b ON b.id = a.id + 1),
n AS (SELECT *, list_sum(list_transform(ga, lambda y: len(list_filter(gb, lambda z: z = y)))) AS ab, list_sum(list_transform(ga, lambda y: len(list_filter(ga, lambda z: z = y)))) AS aa,
  list_sum(list_transform(gb, lambda y: len(list_filter(gb, lambda z: z = y)))) AS bb FROM j)
SELECT id, CASE WHEN len(ga) > 0 AND len(gb) > 0 THEN round(ab / (sqrt(aa) * sqrt(bb)), 9) ELSE 0.0 END AS similarity FROM n"""
)
def title_cosine(s: SparkSession, d: str) -> DataFrame:
    """Titles of records with neighbouring ids."""
    t = table(s, d, "contents").select("id", F.col("title_normalized").alias("t"))
    n = t.select((F.col("id") - 1).alias("id"), F.col("t").alias("u"))
    return t.join(n, "id").select("id", F.round(tx.title_cosine(F.col("t"), F.col("u")), 9).alias("similarity"))


@query(
    """WITH w AS (SELECT incoming_id, content_id, i.content AS x, c.content AS y FROM incoming_contents i JOIN (SELECT min(id) AS content_id, content_hash FROM contents GROUP BY 2) m USING (content_hash) JOIN contents c ON c.id = m.content_id),
f AS (SELECT incoming_id, content_id, list_distinct(list_filter(regexp_split_to_array(x, '\\s+'), lambda z: z <> '')) AS a, list_distinct(list_filter(regexp_split_to_array(y, '\\s+'), lambda z: z <> '')) AS b FROM w)
SELECT incoming_id, content_id, CASE WHEN len(a) > 0 AND len(b) > 0 THEN len(list_intersect(a, b)) / (len(a) + len(b) - len(list_intersect(a, b))) ELSE 0.0 END AS similarity FROM f"""
)
def exact_duplicates(s: SparkSession, d: str) -> DataFrame:
    """Incoming records whose digest is stored, with the least such record and the bodies' similarity."""
    c = table(s, d, "contents")
    # digests and ids first; only the texts of matches are fetched
    first = c.groupBy("content_hash").agg(F.min("id").alias("content_id"))
    j = table(s, d, "incoming_contents").select("incoming_id", "content_hash", F.col("content").alias("x")).join(first, "content_hash")
    j = j.join(c.select(F.col("id").alias("content_id"), F.col("content").alias("y")), "content_id")
    return j.select("incoming_id", "content_id", tx.jaccard(tx.words(F.col("x")), tx.words(F.col("y"))).alias("similarity"))


# -- deduplication and changes of tables


@query("SELECT content_hash, min(id) AS first_id, count(*) AS n FROM contents GROUP BY content_hash HAVING count(*) > 1")
def duplicate_groups(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").groupBy("content_hash").agg(F.min("id").alias("first_id"), F.count("*").alias("n")).where("n > 1")


@query("SELECT id, normalized_url, reason FROM (SELECT *, row_number() OVER (PARTITION BY normalized_url ORDER BY discarded_at, id) AS k FROM discarded_candidates) WHERE k = 1")
def first_discard_per_url(s: SparkSession, d: str) -> DataFrame:
    return store.first_per_key(table(s, d, "discarded_candidates").select("id", "normalized_url", "reason", "discarded_at"), ["normalized_url"], F.col("discarded_at"), F.col("id")).drop("discarded_at")


@query(
    """WITH n AS (SELECT normalized_url AS url, max(discarded_at) AS seen FROM discarded_candidates GROUP BY 1)
SELECT c.canonical_url AS url, false AS created, greatest(c.last_discovered_at, n.seen) AS seen FROM contents c LEFT JOIN n ON n.url = c.canonical_url
UNION ALL SELECT url, true, seen FROM n WHERE url NOT IN (SELECT canonical_url FROM contents)"""
)
def upsert_first_wins(s: SparkSession, d: str) -> DataFrame:
    """Discarded addresses seen as sightings of contents."""
    old = table(s, d, "contents").select(F.col("canonical_url").alias("url"), F.col("last_discovered_at").alias("seen"))
    new = table(s, d, "discarded_candidates").select(F.col("normalized_url").alias("url"), F.col("discarded_at").alias("seen"), "id")
    return store.first_wins(old, new, "url", "seen", F.col("seen"), F.col("id"))


@query(
    """SELECT content_id, taxonomy_lv2, type_name, decision FROM (
  SELECT q.content_id, s.taxonomy_lv2, s.type_name, 'pending' AS decision, row_number() OVER (PARTITION BY q.content_id, s.taxonomy_lv2, s.type_name ORDER BY q.id) AS k
  FROM content_discoveries q JOIN search_queries s ON s.id = q.query_id WHERE NOT EXISTS (
    SELECT 1 FROM content_taxonomy_mappings m WHERE m.content_id = q.content_id AND m.taxonomy_lv2 = s.taxonomy_lv2 AND m.type_name = s.type_name)) WHERE k = 1"""
)
def insert_ignore_mappings(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "search_queries").select(F.col("id").alias("query_id"), "taxonomy_lv2", "type_name")
    new = table(s, d, "content_discoveries").select("id", "content_id", "query_id").join(q, "query_id").withColumn("decision", F.lit("pending"))
    keys = ["content_id", "taxonomy_lv2", "type_name"]
    return store.insert_ignore(table(s, d, "content_taxonomy_mappings"), new, keys, F.col("id")).select(*keys, "decision")


@query("SELECT run_id, content_id, taxonomy_lv2, type_name, max(scored_at) AS scored_at FROM content_quality_scores GROUP BY ALL")
def upsert_last_wins(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "content_quality_scores").select("run_id", "content_id", "taxonomy_lv2", "type_name", "scored_at")
    keys = ["run_id", "content_id", "taxonomy_lv2", "type_name"]
    return store.last_wins(c.where("content_id % 2 = 0"), c, keys, "scored_at")


@query(
    """WITH b AS (SELECT type_name, source_domain AS d FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE status = 'accepted' GROUP BY ALL),
l AS (SELECT type_name, source_domain AS d, max(collected_at) AS last_used_at FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE decision = 'excluded' GROUP BY ALL)
SELECT b.type_name, b.d AS domain, l.last_used_at FROM b LEFT JOIN l USING (type_name, d)"""
)
def sync_set(s: SparkSession, d: str) -> DataFrame:
    """Domains of a type made anew, with what is known of those that stay."""
    j = table(s, d, "content_taxonomy_mappings").join(table(s, d, "contents").select(F.col("id").alias("content_id"), F.col("source_domain").alias("domain"), "status", "collected_at"), "content_id")
    new = j.where("status = 'accepted'").select("type_name", "domain").distinct()
    old = j.where("decision = 'excluded'").groupBy("type_name", "domain").agg(F.max("collected_at").alias("last_used_at"))
    return store.sync_set(old, new, ["type_name", "domain"], ["last_used_at"])


@query("SELECT d.* EXCLUDE (requested_date_from, requested_date_to) FROM discarded_candidates d WHERE NOT EXISTS (SELECT 1 FROM contents c WHERE c.canonical_url = d.normalized_url)")
def not_stored_yet(s: SparkSession, d: str) -> DataFrame:
    keys = table(s, d, "contents").select(F.col("canonical_url").alias("normalized_url"))
    return store.delete_keys(table(s, d, "discarded_candidates").drop("requested_date_from", "requested_date_to"), keys)


@query("SELECT id, query_text, provider FROM search_queries WHERE provider = 'tavily' AND status IN ('generated', 'user_edited', 'user_created')")
def active_queries(s: SparkSession, d: str) -> DataFrame:
    q = store.matching(table(s, d, "search_queries"), provider="tavily", taxonomy_lv2=None)
    return q.where(F.col("status").isin(*reports.ACTIVE)).select("id", "query_text", "provider")


@query(
    """WITH RECURSIVE t AS (SELECT row_number() OVER (ORDER BY id) AS n, id, normalized_url AS u, array_to_string(list_filter([lower(source_domain), reason, strftime(discarded_at, '%Y-%m-%d')], lambda x: x IS NOT NULL), '|') AS h FROM discarded_candidates),
g AS (SELECT CAST(0 AS BIGINT) AS n, CAST(NULL AS BIGINT) AS id, CAST([] AS VARCHAR[]) AS us, CAST([] AS VARCHAR[]) AS hs, false AS ok
  UNION ALL SELECT n, id, CASE WHEN ok THEN list_append(us, u) ELSE us END, CASE WHEN ok THEN list_append(hs, h) ELSE hs END, ok
  FROM (SELECT t.n, t.id, t.u, t.h, g.us, g.hs, NOT coalesce(list_contains(g.us, t.u), false) AND NOT coalesce(list_contains(g.hs, t.h), false) AS ok FROM g JOIN t ON t.n = g.n + 1))
SELECT d.id, d.normalized_url, array_to_string(list_filter([lower(d.source_domain), d.reason, strftime(d.discarded_at, '%Y-%m-%d')], lambda x: x IS NOT NULL), '|') AS k2 FROM g JOIN discarded_candidates d USING (id) WHERE ok"""
)
def greedy_two_key_dedup(s: SparkSession, d: str) -> DataFrame:
    """Discards taken by id, at most one for an address and one for an (original address, reason)."""
    t = table(s, d, "discarded_candidates").select("id", "normalized_url", F.concat_ws("|", F.lower("source_domain"), "reason", F.date_format("discarded_at", "yyyy-MM-dd")).alias("k2"))
    return dedup.greedy_two_key(t, "id", "normalized_url", "k2")


@query(
    """SELECT taxonomy_lv2, type_name, id, title, coalesce(published_date, '') AS date, canonical_url AS url, source_domain FROM (
  SELECT taxonomy_lv2, type_name, c.*, row_number() OVER (PARTITION BY taxonomy_lv2, type_name, content_hash ORDER BY published_date NULLS LAST, c.id) AS k
  FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE c.status = 'accepted' AND m.decision = 'accepted') WHERE k = 1"""
)
def export_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted contents of each (lv2, type), the first of each digest by date (unknown last) and id."""
    c = table(spark, sf_dir, "contents").where("status = 'accepted'")
    m = table(spark, sf_dir, "content_taxonomy_mappings").where("decision = 'accepted'").select("content_id", "taxonomy_lv2", "type_name")
    j = m.join(c.select("id", "title", "published_date", "canonical_url", "source_domain", "content_hash"), F.col("content_id") == F.col("id"))
    first = store.first_per_key(j, ["taxonomy_lv2", "type_name", "content_hash"], F.col("published_date").asc_nulls_last(), F.col("id"))
    return first.select("taxonomy_lv2", "type_name", "id", "title", F.coalesce("published_date", F.lit("")).alias("date"), F.col("canonical_url").alias("url"), "source_domain")


@query(
    """WITH s AS (SELECT content_id, taxonomy_lv2, type_name, min(overall) AS low FROM content_quality_scores WHERE overall < 2.5 AND NOT isnan(overall) GROUP BY ALL)
SELECT content_id, taxonomy_lv2, type_name, CASE WHEN low IS NOT NULL AND decision = 'accepted' THEN 'excluded' ELSE decision END AS decision,
  CASE WHEN low IS NOT NULL AND decision = 'accepted' THEN 'quality_score_overall=' || CAST(low AS VARCHAR) || '(<2.5)' ELSE decision_reason END AS decision_reason
FROM content_taxonomy_mappings m LEFT JOIN s USING (content_id, taxonomy_lv2, type_name)"""
)
def quality_gate(s: SparkSession, d: str) -> DataFrame:
    """Accepted mappings with a score below 2.5 are demoted, with the least score as the reason."""
    keys = ["content_id", "taxonomy_lv2", "type_name"]
    low = table(s, d, "content_quality_scores").where("overall < 2.5 and not isnan(overall)").groupBy(*keys).agg(F.min("overall").alias("low"))
    hit = F.col("low").isNotNull() & (F.col("decision") == "accepted")
    reason = F.concat(F.lit("quality_score_overall="), F.col("low").cast("string"), F.lit("(<2.5)"))
    j = table(s, d, "content_taxonomy_mappings").join(low, keys, "left")
    return j.select(*keys, F.when(hit, "excluded").otherwise(F.col("decision")).alias("decision"), F.when(hit, reason).otherwise(F.col("decision_reason")).alias("decision_reason"))


@query(
    """WITH x AS (SELECT d.id, d.normalized_url AS url, q.taxonomy_lv2, q.type_name FROM discarded_candidates d JOIN search_queries q ON q.id = d.query_id)
SELECT x.id, CASE WHEN c.id IS NULL THEN 'fetch' WHEN m.id IS NOT NULL THEN 'duplicate' ELSE 'reuse' END AS way
FROM x LEFT JOIN contents c ON c.canonical_url = x.url LEFT JOIN content_taxonomy_mappings m ON m.content_id = c.id AND m.taxonomy_lv2 = x.taxonomy_lv2 AND m.type_name = x.type_name"""
)
def reuse_or_fetch(s: SparkSession, d: str) -> DataFrame:
    """A stored address not yet mapped to the candidate's type is filtered again, one that is mapped is a duplicate; all others are fetched."""
    q = table(s, d, "search_queries").select(F.col("id").alias("query_id"), "taxonomy_lv2", "type_name")
    x = table(s, d, "discarded_candidates").select("id", F.col("normalized_url").alias("url"), "query_id").join(q, "query_id")
    c = table(s, d, "contents").select(F.col("canonical_url").alias("url"), F.col("id").alias("content_id"))
    m = table(s, d, "content_taxonomy_mappings").select("content_id", "taxonomy_lv2", "type_name", F.lit(True).alias("mapped"))
    j = x.join(c, "url", "left").join(m, ["content_id", "taxonomy_lv2", "type_name"], "left")
    return j.select("id", F.when(F.col("content_id").isNull(), "fetch").when(F.col("mapped"), "duplicate").otherwise("reuse").alias("way"))


FAULT_SQL = """CASE WHEN regexp_matches(t, '[0-9]{4}\\s*년|[0-9]{1,2}\\s*월|최근\\s*[0-9]*\\s*(년|개월|달)|올해|작년|재작년|지난\\s*(달|주|해|년)|이번\\s*(년|해|달)') THEN 'date_expression'
  WHEN regexp_matches(t, 'site\\s*:', 'i') THEN 'site_operator'
  WHEN len(list_filter(regexp_split_to_array(t, '\\s+'), lambda x: x NOT IN ('', '그리고', '또는', '및', '혹은'))) > 5 THEN 'too_many_words' WHEN len(t) > CASE provider WHEN 'tavily' THEN 40 ELSE 45 END THEN 'too_long' END"""


@query(
    f"""WITH q AS (SELECT id, provider, taxonomy_lv2, type_name, trim(query_text, chr(32) || chr(9) || chr(10)) AS t FROM search_queries),
f AS (SELECT *, {FAULT_SQL} AS fault, row_number() OVER (PARTITION BY provider, taxonomy_lv2, type_name, t ORDER BY id) AS k FROM q WHERE t <> '')
SELECT id, coalesce(fault, CASE WHEN k > 1 THEN 'duplicate_within_batch' END) AS rejected FROM f"""
)
def query_text_validator(s: SparkSession, d: str) -> DataFrame:
    """Why a query isn't taken. Blank ones are dropped; only a sound text can be repeated, as rejected ones aren't kept."""
    q = table(s, d, "search_queries").select("id", "provider", "taxonomy_lv2", "type_name", tx.strip(F.col("query_text")).alias("t")).where("t <> ''")
    fault = ru.query_fault(F.col("t"), F.col("provider"))
    # an aggregate, not a window: one text may be repeated any number of times
    keys = ["provider", "taxonomy_lv2", "type_name", "t"]
    first = q.groupBy(*keys).agg(F.min("id").alias("first"))
    return q.join(first, keys).select("id", F.coalesce(fault, F.when(F.col("id") > F.col("first"), "duplicate_within_batch")).alias("rejected"))


@query(
    """SELECT id, v AS query_text FROM (SELECT id, provider, query_text || ' ' || y || '년' AS v FROM search_queries, (SELECT unnest(range(2024, 2026)) AS y) WHERE status = 'used')
WHERE len(v) <= CASE provider WHEN 'tavily' THEN 40 ELSE 45 END AND len(list_filter(regexp_split_to_array(v, '\\s+'), lambda x: x <> '')) <= 5"""
)
def year_variants(s: SparkSession, d: str) -> DataFrame:
    """Used queries with each year of the date range, as far as their provider takes so long a query."""
    years = F.explode(F.sequence(F.lit(DATES[0].year), F.lit(DATES[1].year)))
    q = table(s, d, "search_queries").where("status = 'used'").select("id", "provider", "query_text", years.alias("y"))
    q = q.select("id", "provider", F.format_string("%s %d년", "query_text", "y").alias("query_text"))
    return q.where(ru.fits(F.col("query_text"), F.col("provider"))).select("id", "query_text")


@query(
    """SELECT type_name, list_sort(list_distinct(list_filter(flatten(list(string_split(query_text, ' '))), lambda t: len(t) BETWEEN 1 AND 12 AND NOT regexp_matches(t, '[0-9]|@|https?://|www\\.')))) AS terms
FROM search_queries GROUP BY type_name"""
)
def safe_terms(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "search_queries").select("type_name", F.explode(F.split("query_text", " ")).alias("t"))
    q = q.where((F.length("t").between(1, 12)) & ~F.col("t").rlike(r"(?U)\d|@|https?://|www\."))
    return q.groupBy("type_name").agg(F.sort_array(F.collect_set("t")).alias("terms"))


@query(
    """WITH d AS (SELECT DISTINCT type_name, source_domain AS d FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id),
a AS (SELECT type_name, list_sort(list(d)) AS d FROM d GROUP BY 1),
n AS (SELECT *, len(d) AS n FROM a)
SELECT type_name, CAST(i AS INTEGER) AS bundle, list_slice(list_concat(d, d), i + 1, i + 3) AS domains FROM (SELECT *, unnest(CASE WHEN n <= 3 THEN [0] ELSE range(n) END) AS i FROM n) WHERE n > 3
UNION ALL SELECT type_name, 0, d FROM n WHERE n <= 3"""
)
def domain_bundles(s: SparkSession, d: str) -> DataFrame:
    """Rolling circular windows of three domains of each type; up to three make one bundle.

    Domains are ranked by type; each one's bundle takes it and the next two, the last ones going on with the first.
    """
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), "source_domain")
    m = table(s, d, "content_taxonomy_mappings").select("content_id", "type_name").join(c, "content_id").select("type_name", "source_domain").distinct()
    w = Window.partitionBy("type_name").orderBy("source_domain")
    r = m.withColumn("at", F.row_number().over(w) - 1).withColumn("b", F.lead("source_domain", 1).over(w)).withColumn("c", F.lead("source_domain", 2).over(w))
    n = r.groupBy("type_name").agg(F.count("*").alias("n"), F.min_by("source_domain", "at").alias("first"), F.min_by("b", "at").alias("second"))
    j = r.join(n, "type_name").where("n > 3 or at = 0")
    b, third = F.coalesce("b", "first"), F.coalesce("c", F.when(F.col("b").isNull(), F.col("second")).otherwise(F.col("first")))
    few = F.filter(F.array("source_domain", "b", "c"), lambda x: x.isNotNull())
    return j.select("type_name", F.col("at").cast("int").alias("bundle"), F.when(F.col("n") <= 3, few).otherwise(F.array("source_domain", b, third)).alias("domains"))


WORDS_SQL = "list_distinct(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> ''))"
GRAMS_SQL = "CASE WHEN len({x}) = 1 THEN [{x}] ELSE list_transform(range(1, greatest(len({x}), 1)), lambda z: {x}[z:z + 1]) END"


@query(
    f"""WITH d AS (SELECT id, {WORDS_SQL} AS t, coalesce(title_normalized, '') AS x FROM contents),
u AS (SELECT id, len(t) AS n, unnest(t) AS k FROM d),
c AS (SELECT a.id AS id, b.id AS o, count(*) / (a.n + b.n - count(*)) AS j FROM u a JOIN u b ON a.k = b.k AND b.id < a.id GROUP BY a.id, b.id, a.n, b.n HAVING count(*) / (a.n + b.n - count(*)) >= 0.35),
s AS (SELECT c.*, regexp_replace(p.x, '\\s', '', 'g') AS xa, regexp_replace(q.x, '\\s', '', 'g') AS xb FROM c JOIN d p ON p.id = c.id JOIN d q ON q.id = c.o),
g AS (SELECT *, {GRAMS_SQL.format(x='xa')} AS ga, {GRAMS_SQL.format(x='xb')} AS gb FROM s),
v AS (SELECT *, list_sum(list_transform(ga, lambda y: len(list_filter(gb, lambda z: z = y)))) / (sqrt(list_sum(list_transform(ga, lambda y: len(list_filter(ga, lambda z: z = y))))) * sqrt(list_sum(list_transform(gb, lambda y: len(list_filter(gb, lambda z: z = y)))))) AS cos FROM g),
f AS (SELECT x, min(id) AS m FROM d WHERE x <> '' GROUP BY 1),
e AS (SELECT d.id, f.m AS matched_id FROM d JOIN f USING (x) WHERE f.m < d.id)
SELECT id, matched_id, true AS by_title, CAST(NULL AS DOUBLE) AS jaccard FROM e
UNION ALL SELECT id, o, false, round(j, 9) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY j DESC, o) AS k FROM v WHERE j >= 0.45 OR (j >= 0.35 AND len(ga) > 0 AND len(gb) > 0 AND cos >= 0.9)) WHERE k = 1 AND id NOT IN (SELECT id FROM e)"""
)
def near_duplicate_check(s: SparkSession, d: str) -> DataFrame:
    """Each stored record against all before it."""
    v = neardup.verdicts(table(s, d, "contents").select("id", F.col("title_normalized").alias("title"), "content"))
    return v.select("id", "matched_id", "by_title", F.round("jaccard", 9).alias("jaccard"))


@query()
def near_duplicate_observations(s: SparkSession, d: str) -> DataFrame:
    """The best earlier partner of each stored record, from a similarity of 0.15 up."""
    o = neardup.observations(table(s, d, "contents").select("id", F.col("title_normalized").alias("title"), "content"))
    return o.select("id", "matched_id", F.round("title_similarity", 9).alias("title_similarity"), F.round("content_similarity", 9).alias("content_similarity"), "would_exclude")


def queries() -> dict:
    return {**Q, **reports.Q, **rules.Q}


def oracle_sql() -> dict:
    return {**SQL, **reports.SQL, **rules.SQL}
