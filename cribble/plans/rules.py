"""Queries of the reference's small rules: gates, guards, orders, picks, vocabularies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cribble.functions import rules as ru, urls as ur
from cribble.operators import scorers
from cribble.operators.scoring import latest_score
from cribble.plans import reports
from cribble.sources.tables import table

BLOCKED = ["narae-news.example", "solbit-blog.example"]
Q: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT content_id, run_id, taxonomy_lv2, type_name, CASE WHEN coalesce(type_relevance < 2, true) THEN 'taxonomy_mismatch' WHEN coalesce(korean_locality < 2, true) THEN 'low_korea_relevance' END AS reason FROM content_quality_scores")
def relevance_gate(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "content_quality_scores")
    return t.select("content_id", "run_id", "taxonomy_lv2", "type_name", ru.relevance_gate(F.col("type_relevance"), F.col("korean_locality"), 2).alias("reason"))


@query(
    """SELECT d.id, CASE WHEN h IN ('narae-news.example', 'solbit-blog.example') OR ends_with(h, '.narae-news.example') OR ends_with(h, '.solbit-blog.example') THEN 'blacklisted_domain'
  WHEN regexp_matches(url, '^[a-z][a-z0-9+.-]*://[^/?#]*/$') THEN 'homepage_url' WHEN provider = 'tavily' AND relevance_score < 0.15 THEN 'low_relevance_score' END AS reason
FROM (SELECT d.*, c.canonical_url AS url, regexp_replace(regexp_replace(lower(c.source_domain), ':.*$', ''), '\\.+$', '') AS h FROM content_discoveries d JOIN contents c ON c.id = d.content_id) d"""
)
def fetch_guards(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), "canonical_url", "source_domain")
    j = table(s, d, "content_discoveries").select("id", "content_id", "provider", "relevance_score").join(c, "content_id")
    return j.select("id", ru.fetch_guard(ur.is_blocked(F.col("source_domain"), BLOCKED), ur.is_homepage(F.col("canonical_url")), F.col("provider"), F.col("relevance_score")).alias("reason"))


@query(
    """SELECT content_id, id, k FROM (SELECT *, CAST(row_number() OVER (PARTITION BY content_id ORDER BY relevance_score DESC NULLS LAST, rank DESC NULLS LAST, id) AS INTEGER) AS k FROM content_discoveries) WHERE k <= 3"""
)
def top_three(s: SparkSession, d: str) -> DataFrame:
    """The three best sightings of each record by score, then rank, all descending, then in order; the limit is the feature."""
    w = Window.partitionBy("content_id").orderBy(F.col("relevance_score").desc_nulls_last(), F.col("rank").desc_nulls_last(), "id")
    return table(s, d, "content_discoveries").select("content_id", "id", "relevance_score", "rank").withColumn("k", F.row_number().over(w)).where("k <= 3").select("content_id", "id", "k")


@query(
    f"""WITH s AS ({reports.SQL['query_score']}) SELECT q.id AS query_id, CAST(row_number() OVER (PARTITION BY taxonomy_lv2, type_name, provider ORDER BY round(score, 6) DESC, q.id) AS INTEGER) AS place
FROM search_queries q JOIN s ON s.query_id = q.id WHERE status IN ('generated', 'user_edited', 'user_created')"""
)
def query_order(s: SparkSession, d: str) -> DataFrame:
    """Queries of a lane by score; equal to six places, they keep their order."""
    active = table(s, d, "search_queries").where(F.col("status").isin(*reports.ACTIVE)).select(F.col("id").alias("query_id"), "taxonomy_lv2", "type_name", "provider")
    w = Window.partitionBy("taxonomy_lv2", "type_name", "provider").orderBy(F.round("score", 6).desc(), "query_id")
    return active.join(reports.query_score(s, d), "query_id").select("query_id", F.row_number().over(w).alias("place"))


@query("SELECT DISTINCT a.taxonomy_lv2, a.type_name, b.type_name AS sibling FROM search_queries a JOIN search_queries b ON a.taxonomy_lv2 = b.taxonomy_lv2 AND a.type_name <> b.type_name")
def sibling_types(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "search_queries").select("taxonomy_lv2", "type_name").distinct()
    return t.join(t.withColumnRenamed("type_name", "sibling"), "taxonomy_lv2").where("type_name <> sibling")


@query(
    "SELECT id, reason, CASE WHEN reason IN ('timeout', 'temporary_http_error', 'extraction_too_short', 'unexpected_error') THEN 'immediate' WHEN reason = 'extraction_empty' THEN 'after_parser_update' ELSE 'never' END AS mode, "
    "CASE WHEN reason IN ('timeout', 'temporary_http_error') THEN 3 WHEN reason IN ('unexpected_error', 'extraction_too_short') THEN 2 ELSE 1 END AS attempts, "
    "coalesce(reason IN ('timeout', 'temporary_http_error', 'extraction_too_short', 'unexpected_error'), false) AS again FROM discarded_candidates"
)
def retry_policy(s: SparkSession, d: str) -> DataFrame:
    policy = s.createDataFrame([(k, mode) for k, (mode, _) in ru.RETRY.items()], "reason string, mode string")
    j = table(s, d, "discarded_candidates").select("id", "reason").join(F.broadcast(policy), "reason", "left")
    return j.select("id", "reason", F.coalesce("mode", F.lit("never")).alias("mode"), ru.most_attempts(F.col("reason")).alias("attempts"), ru.is_retryable(F.col("reason")).alias("again"))


@query(
    """SELECT id, split_part(decision_reason, ':', 1) AS code, CASE WHEN starts_with(decision_reason, 'reclassified') THEN try_cast(regexp_extract(decision_reason, 'fit=([0-9]+)', 1) AS INTEGER) END AS fit,
  CASE WHEN decision = 'excluded' THEN decision_reason || ' | 한국 관련성: -' END AS note FROM content_taxonomy_mappings"""
)
def decision_labels(s: SparkSession, d: str) -> DataFrame:
    r = F.col("decision_reason")
    fit = F.when(F.startswith(r, F.lit("reclassified")), F.regexp_extract(r, "fit=([0-9]+)", 1).try_cast("int"))
    code, detail = ru.reason_code(r), F.regexp_replace(r, "^[^:]*: ", "")
    return table(s, d, "content_taxonomy_mappings").select("id", code.alias("code"), fit.alias("fit"), F.when(F.col("decision") == "excluded", ru.decision_reason(code, detail, F.lit("-"))).alias("note"))


@query(
    """WITH t AS (SELECT type_name, taxonomy_lv2, list_distinct(list(query_text) FILTER (created_by = 'user' AND status = 'user_created')) AS a, list_distinct(list(query_text) FILTER (created_by = 'openai' AND status = 'used')) AS b FROM search_queries GROUP BY ALL)
SELECT type_name, taxonomy_lv2, CASE WHEN len(a) > 0 AND len(b) > 0 THEN 'static_and_fresh' WHEN len(a) > 0 THEN 'static_only' WHEN len(b) > 0 THEN 'fresh_only' ELSE 'lv2_fallback' END AS state,
  CASE WHEN coalesce(len(a), 0) + coalesce(len(b), 0) > 0 THEN list_sort(list_distinct(list_concat(coalesce(a, []), coalesce(b, [])))) ELSE [taxonomy_lv2] END AS terms FROM t"""
)
def vocabulary_merge(s: SparkSession, d: str) -> DataFrame:
    pick = lambda who, status: F.sort_array(F.collect_set(F.when((F.col("created_by") == who) & (F.col("status") == status), F.col("query_text"))))
    t = table(s, d, "search_queries").groupBy("type_name", "taxonomy_lv2").agg(pick("user", "user_created").alias("a"), pick("openai", "used").alias("b"))
    terms, state = ru.merged_terms(F.col("a"), F.col("b"), F.lit(None).cast("array<string>"), F.array("taxonomy_lv2"))
    return t.select("type_name", "taxonomy_lv2", state.alias("state"), F.sort_array(terms).alias("terms"))


@query("SELECT run_id, strftime(started_at::DATE - INTERVAL 5 MONTH, '%Y-%m-%d') AS date_from FROM collection_runs")
def months_back(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "collection_runs").select("run_id", ru.months_back(F.col("started_at").cast("date"), 5).cast("string").alias("date_from"))


@query(
    """SELECT run_id, count(*) FILTER (w = 'accepted') AS accepted, count(*) FILTER (w = 'excluded') AS excluded, count(*) FILTER (w = 'discarded') AS discarded FROM (
  SELECT d.run_id, c.status AS w FROM content_discoveries d JOIN contents c ON c.id = d.content_id UNION ALL SELECT run_id, 'discarded' FROM discarded_candidates WHERE run_id IS NOT NULL) GROUP BY 1"""
)
def run_summary(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), F.col("status").alias("w"))
    seen = table(s, d, "content_discoveries").select("run_id", "content_id").join(c, "content_id").select("run_id", "w")
    lost = table(s, d, "discarded_candidates").where("run_id is not null").select("run_id", F.lit("discarded").alias("w"))
    return seen.unionByName(lost).groupBy("run_id").agg(*[F.count_if(F.col("w") == x).alias(x) for x in ("accepted", "excluded", "discarded")])


@query(
    """SELECT m.taxonomy_lv2, m.type_name, list_sort(list_distinct(list(c.source_domain))) AS allowed FROM content_taxonomy_mappings m JOIN (SELECT *, regexp_replace(regexp_replace(lower(source_domain), ':.*$', ''), '\\.+$', '') AS h FROM contents) c ON c.id = m.content_id
WHERE m.decision = 'accepted' AND NOT (h IN ('narae-news.example', 'solbit-blog.example') OR ends_with(h, '.narae-news.example') OR ends_with(h, '.solbit-blog.example')) GROUP BY ALL"""
)
def allowed_domains(s: SparkSession, d: str) -> DataFrame:
    c = table(s, d, "contents").where(~ur.is_blocked(F.col("source_domain"), BLOCKED)).select(F.col("id").alias("content_id"), "source_domain")
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'").join(c, "content_id")
    return m.groupBy("taxonomy_lv2", "type_name").agg(F.sort_array(F.collect_set("source_domain")).alias("allowed"))


@query(
    """WITH c AS (SELECT id, content, list_filter(regexp_split_to_array(content, '[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{3000}]+'), lambda x: x <> '') AS w FROM contents WHERE status = 'accepted'),
p AS (SELECT id, CAST(1 + len(content) % 5 AS INT) AS type_relevance, CAST(1 + round_even(4.0 * len(regexp_replace(content, '[^가-힣]', '', 'g')) / len(content), 0) AS INT) AS korean_locality,
  CAST(1 + len(list_distinct(w)) % 5 AS INT) AS specificity, CAST(1 + len(w) % 5 AS INT) AS injection_suitability, CASE WHEN len(content) < 100 THEN ['too_short'] ELSE [] END AS issues FROM c)
SELECT *, (type_relevance + korean_locality + specificity + injection_suitability) / 4 AS overall FROM p"""
)
def stub_scores(s: SparkSession, d: str) -> DataFrame:
    """Scores of a deterministic stand-in for the accepted records."""
    t = table(s, d, "contents").where("status = 'accepted'").select("id", "content")
    return scorers.score(t, ["id"], scorers.stub)


@query(
    """SELECT n.id AS mapping_id, coalesce(e.last_overall, -1.0) AS overall FROM content_taxonomy_mappings n LEFT JOIN (
  SELECT content_id, arg_max(overall, (scored_at, run_id, taxonomy_lv2, type_name)) AS last_overall FROM content_quality_scores WHERE overall >= 1 AND overall <= 5 AND NOT isnan(overall) GROUP BY 1) e ON e.content_id = n.content_id"""
)
def mapping_scores(s: SparkSession, d: str) -> DataFrame:
    q = latest_score(table(s, d, "content_quality_scores"))
    return table(s, d, "content_taxonomy_mappings").select(F.col("id").alias("mapping_id"), "content_id").join(q, "content_id", "left").select("mapping_id", F.coalesce("score", F.lit(-1.0)).alias("overall"))
