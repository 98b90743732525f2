"""Further queries of the reference: lookups with fallbacks, guards in batches, picks, outcomes, the full report."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cribble.functions import rules as ru, urls as ur
from cribble.operators import filters, picks, store
from cribble.operators.running import running
from cribble.plans import reference, reports
from cribble.sources.tables import table

Q: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


@query("SELECT id, content_fingerprint FROM contents WHERE content_fingerprint IS NOT NULL")
def stored_fingerprints(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "contents").select("id", "content_fingerprint").where("content_fingerprint is not null")


@query(
    """WITH t AS (SELECT DISTINCT taxonomy_lv2 AS lv2, type_name AS type FROM search_queries WHERE provider = 'tavily'), u AS (SELECT type, min(lv2) AS lv2 FROM t GROUP BY 1 HAVING count(*) = 1)
SELECT m.id, coalesce(t.lv2, u.lv2) AS lv2, CASE WHEN t.lv2 IS NOT NULL THEN 'exact' WHEN u.lv2 IS NOT NULL THEN 'unique_name' END AS way
FROM content_taxonomy_mappings m LEFT JOIN t ON t.lv2 = m.taxonomy_lv2 AND t.type = m.type_name LEFT JOIN u ON u.type = m.type_name"""
)
def type_lookup(s: SparkSession, d: str) -> DataFrame:
    """The entry of a type: under its group, else the only entry of that name anywhere."""
    t = table(s, d, "search_queries").where("provider = 'tavily'").select(F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type")).distinct()
    m = table(s, d, "content_taxonomy_mappings").select("id", F.col("taxonomy_lv2").alias("own"), F.col("type_name").alias("type"))
    return picks.lookup(m, t).select("id", "lv2", "way")


HOST_SQL = "regexp_replace(regexp_replace(lower({x}), ':.*$', ''), '\\.+$', '')"
BAD_SQL = "(h IN ('narae-news.example', 'solbit-blog.example') OR ends_with(h, '.narae-news.example') OR ends_with(h, '.solbit-blog.example'))"


@query(
    f"""WITH c AS (SELECT DISTINCT m.taxonomy_lv2 AS lv2, m.type_name AS type, c.source_domain AS d, {HOST_SQL.format(x='c.source_domain')} AS h FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE m.decision = 'accepted' AND c.source_category = 'news'),
f AS (SELECT DISTINCT m.type_name AS type, c.source_domain AS d, {HOST_SQL.format(x='c.source_domain')} AS h FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE m.decision = 'accepted'),
t AS (SELECT DISTINCT taxonomy_lv2 AS lv2, type_name AS type FROM search_queries),
a AS (SELECT lv2, type, list_sort(list(d) FILTER (NOT {BAD_SQL})) AS own FROM c GROUP BY ALL), b AS (SELECT type, list_sort(list(d) FILTER (NOT {BAD_SQL})) AS flat FROM f GROUP BY 1)
SELECT lv2, type, coalesce(CASE WHEN a.lv2 IS NOT NULL THEN own ELSE flat END, []) AS allowed, len(coalesce(CASE WHEN a.lv2 IS NOT NULL THEN own ELSE flat END, [])) > 0 AS any_domain
FROM t LEFT JOIN a USING (lv2, type) LEFT JOIN b USING (type)"""
)
def allow_list(s: SparkSession, d: str) -> DataFrame:
    """Domains of a type to search in: the entry of its group, else the entry of its name; blocked ones go out.

    Entries stand in for the settings: news domains of a group's type, all domains of a type's name.
    """
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), F.col("source_domain").alias("domain"), "source_category")
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'").select("content_id", F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type")).join(c, "content_id")
    types = table(s, d, "search_queries").select(F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type")).distinct()
    return picks.allowed(types, m.where("source_category = 'news'").select("lv2", "type", "domain").distinct(), m.select("type", "domain").distinct(), reference.BLOCKED)


@query(
    f"""WITH x AS (SELECT d.id, d.content_id, d.provider, d.relevance_score, q.taxonomy_lv2 AS lv2, q.type_name AS type, (row_number() OVER (ORDER BY d.id) - 1) // 25 AS chunk FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id),
k AS (SELECT *, min(chunk) OVER (PARTITION BY content_id) < chunk AS known, min(chunk) OVER (PARTITION BY content_id, lv2, type) < chunk AS mapped FROM x),
g AS (SELECT k.*, c.canonical_url AS url, {HOST_SQL.format(x='c.source_domain')} AS h, c.status = 'accepted' AS ok FROM k JOIN contents c ON c.id = k.content_id),
r AS (SELECT *, coalesce(sum(ok::INT) OVER (PARTITION BY lv2 ORDER BY chunk RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 30 AS enough FROM g)
SELECT id, CASE WHEN enough THEN 'target_reached' WHEN provider = 'tavily' AND relevance_score < 0.15 THEN 'low_relevance_score' WHEN mapped THEN 'duplicate' WHEN known THEN 'reuse' WHEN {BAD_SQL} THEN 'blacklisted_domain'
  WHEN regexp_matches(url, '^[a-z][a-z0-9+.-]*://[^/?#]*/$') THEN 'homepage_url' ELSE 'fetch' END AS way FROM r"""
)
def batch_guards(s: SparkSession, d: str) -> DataFrame:
    """What becomes of each candidate of a batch, in the order of the guards of a batch: target, score, reuse, blocked domain, home page.

    Candidates come in chunks of 25; what is stored, mapped and counted is what earlier chunks left.
    """
    q = table(s, d, "search_queries").select(F.col("id").alias("query_id"), F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type"))
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), "canonical_url", "source_domain", (F.col("status") == "accepted").cast("long").alias("ok"))
    x = table(s, d, "content_discoveries").select("id", "query_id", "content_id", "provider", "relevance_score").join(q, "query_id").withColumn("one", F.lit(1)).withColumn("every", F.lit(0))
    x = running(x, ["every"], F.col("id"), F.shiftright("id", 12), "one", "before").withColumn("chunk", F.floor(F.col("before") / 25)).join(c, "content_id")
    known = x.groupBy("content_id").agg(F.min("chunk").alias("known"))
    mapped = x.groupBy("content_id", "lv2", "type").agg(F.min("chunk").alias("mapped"))
    sums = running(x.groupBy("lv2", "chunk").agg(F.sum("ok").alias("ok")), ["lv2"], F.col("chunk"), F.shiftright("chunk", 12), "ok", "sofar").select("lv2", "chunk", "sofar")
    j = x.join(known, "content_id").join(mapped, ["content_id", "lv2", "type"]).join(sums, ["lv2", "chunk"])
    way = (
        F.when(F.col("sofar") >= 30, "target_reached").when((F.col("provider") == "tavily") & (F.col("relevance_score") < 0.15), "low_relevance_score").when(F.col("mapped") < F.col("chunk"), "duplicate")
        .when(F.col("known") < F.col("chunk"), "reuse").when(ur.is_blocked(F.col("source_domain"), reference.BLOCKED), "blacklisted_domain").when(ur.is_homepage(F.col("canonical_url")), "homepage_url").otherwise("fetch")
    )
    return j.select("id", way.alias("way"))


OUTCOME_SQL = "CASE WHEN {ok} THEN 'pass' ELSE 'fail' END"


@query(
    f"""WITH f AS (SELECT id, NOT {BAD_SQL} AS a, coalesce({reference.DATE_SQL} BETWEEN DATE '2024-01-01' AND DATE '2025-06-30', true) AS b, coalesce({reference.RATIO_SQL} >= 0.3, false) AS c
  FROM (SELECT *, {HOST_SQL.format(x='source_domain')} AS h, {reference.STRIPPED_SQL} AS t FROM contents))
SELECT id, {OUTCOME_SQL.format(ok='a')} AS domain, CASE WHEN a THEN {OUTCOME_SQL.format(ok='b')} END AS dates, CASE WHEN a AND b THEN {OUTCOME_SQL.format(ok='c')} END AS script FROM f"""
)
def filter_outcomes(s: SparkSession, d: str) -> DataFrame:
    """What each filter of the cascade said, as far as they ran; the one that failed is the last."""
    out = filters.outcomes(*reference.DATES, reference.BLOCKED)
    return table(s, d, "contents").select("id", out.alias("o")).select("id", *[F.try_element_at("o", F.lit(k)).alias(n) for k, n in (("blacklisted_domain", "domain"), ("date_out_of_range", "dates"), ("low_korea_relevance", "script"))])


@query(
    """WITH n AS (SELECT id, taxonomy_lv2, type_name, query_text, provider, row_number() OVER (PARTITION BY provider, taxonomy_lv2, type_name, query_text ORDER BY id) AS k FROM search_queries WHERE created_by = 'user'),
o AS (SELECT min(id) AS id, provider, taxonomy_lv2, type_name, query_text FROM search_queries WHERE created_by <> 'user' GROUP BY ALL), f AS (SELECT * FROM n WHERE k = 1)
SELECT n.id AS asked, coalesce(o.id, f.id) AS id, o.id IS NOT NULL OR n.k > 1 AS already FROM n JOIN f USING (provider, taxonomy_lv2, type_name, query_text) LEFT JOIN o USING (provider, taxonomy_lv2, type_name, query_text)"""
)
def get_or_create_query(s: SparkSession, d: str) -> DataFrame:
    """Queries that people added, got where their key is stored already and else created once."""
    q = table(s, d, "search_queries")
    return store.get_or_create(q.where("created_by <> 'user'"), q.where("created_by = 'user'"), ["provider", "taxonomy_lv2", "type_name", "query_text"], "id")


@query(
    """WITH u AS (SELECT run_id, max(discovered_at) AS last FROM content_discoveries GROUP BY 1)
SELECT r.run_id, CASE WHEN r.status = 'running' AND u.run_id IS NOT NULL THEN 'completed' ELSE r.status END AS status, CASE WHEN r.status = 'running' THEN coalesce(u.last, r.finished_at) ELSE r.finished_at END AS finished_at
FROM collection_runs r LEFT JOIN u USING (run_id)"""
)
def finished_runs(s: SparkSession, d: str) -> DataFrame:
    """Open runs finished at their last discovery: a point update of rows by key."""
    last = table(s, d, "content_discoveries").groupBy("run_id").agg(F.max("discovered_at").alias("finished_at")).withColumn("status", F.lit("completed"))
    r = table(s, d, "collection_runs").select("run_id", "status", "finished_at")
    open_ = r.where("status = 'running'").select("run_id")
    return store.update_rows(r, last.join(open_, "run_id", "left_semi"), ["run_id"])


@query(
    f"""WITH b AS ({reference.SQL['domain_bundles']}), s AS ({reports.SQL['domain_score']}), u AS (SELECT source_domain AS domain, max(collected_at) AS used FROM contents WHERE status <> 'accepted' GROUP BY 1),
x AS (SELECT type_name, bundle, unnest(domains) AS domain FROM b),
m AS (SELECT type_name, bundle, round(avg(coalesce(score, 0.5)), 6) AS score, max(used) AS last_used_at FROM x LEFT JOIN s USING (domain) LEFT JOIN u USING (domain) GROUP BY ALL)
SELECT type_name, bundle, score FROM (SELECT *, row_number() OVER (PARTITION BY type_name ORDER BY score DESC, last_used_at NULLS FIRST, bundle) AS k FROM m) WHERE k = 1"""
)
def bundle_pick(s: SparkSession, d: str) -> DataFrame:
    """The bundle of each type with the best mean domain score, unknown domains at one half; then one never used, then the one used longest ago."""
    return picks.best_bundle(_bundles(s, d)).select("type_name", "bundle", "score")


def _bundles(s: SparkSession, d: str) -> DataFrame:
    b = reference.domain_bundles(s, d).select("type_name", "bundle", F.explode("domains").alias("domain"))
    used = table(s, d, "contents").where("status <> 'accepted'").groupBy(F.col("source_domain").alias("domain")).agg(F.max("collected_at").alias("used"))
    j = b.join(reports.domain_score(s, d), "domain", "left").join(used, "domain", "left")
    return j.groupBy("type_name", "bundle").agg(F.round(F.avg(F.coalesce("score", F.lit(0.5))), 6).alias("score"), F.max("used").alias("last_used_at"))


@query(
    f"""WITH b AS ({reference.SQL['domain_bundles']}), u AS (SELECT source_domain AS domain, max(collected_at) AS used FROM contents WHERE status <> 'accepted' GROUP BY 1),
m AS (SELECT type_name, bundle, max(used) AS last_used_at FROM (SELECT type_name, bundle, unnest(domains) AS domain FROM b) LEFT JOIN u USING (domain) GROUP BY ALL)
SELECT type_name, bundle FROM (SELECT *, row_number() OVER (PARTITION BY type_name ORDER BY last_used_at NULLS FIRST, bundle) AS k FROM m) WHERE k = 1"""
)
def bundle_lru(s: SparkSession, d: str) -> DataFrame:
    """The bundle of each type that was never used, or longest ago."""
    return picks.oldest_bundle(_bundles(s, d)).select("type_name", "bundle")


@query(
    """WITH n AS (SELECT i.incoming_id, i.canonical_url, c.id AS stored FROM incoming_contents i JOIN contents c ON c.content_hash = i.content_hash)
SELECT incoming_id, min(stored) AS stored FROM n GROUP BY 1"""
)
def hash_duplicate(s: SparkSession, d: str) -> DataFrame:
    """Incoming records whose digest a stored record has, with the least such record."""
    c = table(s, d, "contents").groupBy("content_hash").agg(F.min("id").alias("stored"))
    return table(s, d, "incoming_contents").select("incoming_id", "content_hash").join(c, "content_hash").select("incoming_id", "stored")


@query("SELECT d.id, c.id AS stored FROM content_discoveries d JOIN contents f ON f.id = d.content_id JOIN contents c ON c.canonical_url = f.canonical_url WHERE d.returned_url <> f.canonical_url")
def redirected_duplicate(s: SparkSession, d: str) -> DataFrame:
    """Discoveries whose final address differs from the one they were found at and is stored."""
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), "canonical_url")
    f = table(s, d, "content_discoveries").select("id", "content_id", "returned_url").join(c, "content_id")
    stored = c.select(F.col("canonical_url"), F.col("content_id").alias("stored"))
    return f.where("returned_url <> canonical_url").join(stored, "canonical_url").select("id", "stored")


@query(
    """WITH m AS (SELECT * FROM content_taxonomy_mappings WHERE decision = 'excluded' AND starts_with(decision_reason, 'taxonomy_mismatch')), t AS (SELECT DISTINCT taxonomy_lv2, type_name FROM search_queries),
b AS (SELECT m.content_id, m.taxonomy_lv2, min(t.type_name) AS type_name FROM m JOIN t ON t.taxonomy_lv2 = m.taxonomy_lv2 AND t.type_name <> m.type_name GROUP BY ALL)
SELECT content_id, taxonomy_lv2, type_name, 'accepted' AS decision, 'reclassified' AS decision_reason FROM b WHERE NOT EXISTS (SELECT 1 FROM content_taxonomy_mappings x WHERE x.content_id = b.content_id AND x.taxonomy_lv2 = b.taxonomy_lv2 AND x.type_name = b.type_name)"""
)
def reclassified(s: SparkSession, d: str) -> DataFrame:
    """Mappings that a mismatch adds under a sibling type; the record's own status stays. The first sibling stands in for the better type of a scorer."""
    m = table(s, d, "content_taxonomy_mappings")
    t = table(s, d, "search_queries").select("taxonomy_lv2", F.col("type_name").alias("sibling")).distinct()
    bad = m.where(F.col("decision") == "excluded").where(F.startswith("decision_reason", F.lit("taxonomy_mismatch"))).join(t, "taxonomy_lv2").where("sibling <> type_name")
    new = bad.groupBy("content_id", "taxonomy_lv2").agg(F.min("sibling").alias("type_name")).withColumn("decision", F.lit("accepted")).withColumn("decision_reason", F.lit("reclassified"))
    keys = ["content_id", "taxonomy_lv2", "type_name"]
    return new.join(m.select(*keys), keys, "left_anti").select(*keys, "decision", "decision_reason")


@query(
    """WITH x AS (SELECT unnest([k, CASE WHEN k = '' THEN NULL ELSE upper(k) END, ' ' || k || ' ', '']) AS l, lv2 FROM (SELECT DISTINCT source_domain AS k, m.taxonomy_lv2 AS lv2 FROM contents c JOIN content_taxonomy_mappings m ON m.content_id = c.id))
SELECT lv2, list_sort(list_distinct(list(trim(l)) FILTER (trim(l) <> ''))) AS domains FROM x GROUP BY 1"""
)
def typed_domains(s: SparkSession, d: str) -> DataFrame:
    """Domains from lines that people type: trimmed, blank ones left out, distinct and sorted."""
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), F.col("source_domain").alias("k"))
    x = table(s, d, "content_taxonomy_mappings").select("content_id", F.col("taxonomy_lv2").alias("lv2")).join(c, "content_id").select("lv2", "k").distinct()
    lines = x.groupBy("lv2").agg(F.flatten(F.collect_list(F.array("k", F.upper("k"), F.concat(F.lit(" "), "k", F.lit(" ")), F.lit("")))).alias("l"))
    return lines.select("lv2", picks.typed_lines(F.col("l")).alias("domains"))


@query(
    """WITH t AS (SELECT taxonomy_lv2 AS lv2, type_name AS type, min(id) AS nth FROM search_queries GROUP BY ALL), g AS (SELECT lv2, list(type ORDER BY nth) AS types, min(nth) AS nth FROM t GROUP BY 1)
SELECT split_part(lv2, '_', 1) AS lv1, list(lv2 ORDER BY nth) AS groups, flatten(list(types ORDER BY nth)) AS types FROM g GROUP BY 1"""
)
def taxonomy_tree(s: SparkSession, d: str) -> DataFrame:
    """Groups and types under the first level, in the order in which they are listed; a configuration table."""
    t = table(s, d, "search_queries").groupBy(F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type")).agg(F.min("id").alias("at"))
    return picks.tree(t.withColumn("lv1", F.split_part("lv2", F.lit("_"), F.lit(1))))


@query(
    """WITH e AS (SELECT d.run_id, c.status AS w, NULL AS reason FROM content_discoveries d JOIN contents c ON c.id = d.content_id UNION ALL SELECT run_id, 'discarded', reason FROM discarded_candidates WHERE run_id IS NOT NULL),
r AS (SELECT run_id, list_sort(list(reason || '=' || n)) AS reasons FROM (SELECT run_id, reason, count(*) AS n FROM e WHERE reason IS NOT NULL GROUP BY ALL) GROUP BY 1)
SELECT run_id, count(*) AS candidates, count(*) FILTER (w = 'accepted') AS accepted, count(*) FILTER (w = 'excluded') AS excluded, count(*) FILTER (w = 'discarded') AS discarded, any_value(r.reasons) AS reasons,
  any_value(list_sort(json_keys(u.provider_usage_summary))) AS providers FROM e LEFT JOIN r USING (run_id) LEFT JOIN collection_runs u USING (run_id) GROUP BY 1"""
)
def run_outcomes(s: SparkSession, d: str) -> DataFrame:
    """A run's candidates by outcome, its discards by reason, the providers it used."""
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), F.col("status").alias("w"))
    seen = table(s, d, "content_discoveries").select("run_id", "content_id").join(c, "content_id").select("run_id", "w", F.lit(None).cast("string").alias("reason"))
    lost = table(s, d, "discarded_candidates").where("run_id is not null").select("run_id", F.lit("discarded").alias("w"), "reason")
    e = seen.unionByName(lost).groupBy("run_id", "w", "reason").agg(F.count("*").alias("n"))
    out = e.groupBy("run_id").agg(
        F.sum("n").alias("candidates"), *[F.coalesce(F.sum(F.when(F.col("w") == x, F.col("n"))), F.lit(0)).alias(x) for x in ("accepted", "excluded", "discarded")],
        F.array_sort(F.collect_list(F.when(F.col("reason").isNotNull(), F.concat_ws("=", "reason", "n")))).alias("reasons"),
    )
    used = table(s, d, "collection_runs").select("run_id", F.array_sort(F.json_object_keys("provider_usage_summary")).alias("providers"))
    return out.withColumn("reasons", F.when(F.size("reasons") > 0, F.col("reasons"))).join(used, "run_id", "left")


@query("SELECT taxonomy_lv2 AS lv2, round(sum(elapsed_s) / count(*), 1) AS seconds_each FROM content_quality_scores GROUP BY 1")
def seconds_per_item(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "content_quality_scores").groupBy(F.col("taxonomy_lv2").alias("lv2")).agg(F.round(F.sum("elapsed_s") / F.count("*"), 1).alias("seconds_each"))


# Reasons given after a text was extracted, reasons of failed extraction, reasons of repetition.
AFTER_EXTRACTION = ("extraction_empty", "extraction_too_short", "date_out_of_range", "low_korea_relevance", "taxonomy_mismatch", "same_content_hash", "near_duplicate", "unexpected_error")
REPEATED = ("duplicate", "near_duplicate", "same_content_hash")


@query(
    f"""WITH t AS (SELECT DISTINCT run_id, id, settings_snapshot, provider_usage_summary, started_at, finished_at, split_part(unnest(CAST(settings_snapshot::JSON->'targets' AS VARCHAR[])), '::', 1) AS lv2 FROM collection_runs),
r AS (SELECT lv2, count(*) AS runs, max(CAST(settings_snapshot::JSON->>'target_count' AS INT)) AS target, sum(greatest(epoch_us(coalesce(finished_at, {reports.NOW_SQL})) - epoch_us(started_at), 0) / 1e6) AS elapsed_s FROM t GROUP BY 1),
u AS (SELECT lv2, k.provider, unnest(CAST(json_extract(provider_usage_summary, '$.' || k.provider) AS JSON[])) AS x FROM t, (SELECT unnest(['tavily', 'serpapi', 'openai']) AS provider) k WHERE provider_usage_summary IS NOT NULL),
uc AS (SELECT lv2, count(*) FILTER (provider = 'tavily') AS tavily_calls, count(*) FILTER (provider = 'serpapi') AS serpapi_calls, coalesce(sum(CAST(x->>'prompt_tokens' AS BIGINT)) FILTER (provider = 'openai'), 0) * 0.15 / 1e6 + coalesce(sum(CAST(x->>'completion_tokens' AS BIGINT)) FILTER (provider = 'openai'), 0) * 0.6 / 1e6 AS cost FROM u GROUP BY 1),
d AS (SELECT t.lv2, d.* EXCLUDE (run_id), m.decision, c.source_domain FROM t JOIN content_discoveries d USING (run_id) JOIN search_queries q ON q.id = d.query_id JOIN contents c ON c.id = d.content_id LEFT JOIN content_taxonomy_mappings m ON m.content_id = d.content_id AND m.taxonomy_lv2 = q.taxonomy_lv2 AND m.type_name = q.type_name),
x AS (SELECT t.lv2, x.reason, q.provider FROM t JOIN discarded_candidates x USING (run_id) LEFT JOIN search_queries q ON q.id = x.query_id),
da AS (SELECT lv2, count(*) AS found, count(*) FILTER (provider = 'tavily') AS ft, count(*) FILTER (provider = 'serpapi') AS fs, count(DISTINCT content_id) FILTER (decision = 'accepted') AS accepted, count(DISTINCT content_id) FILTER (decision = 'accepted' AND provider = 'tavily') AS ta, count(DISTINCT content_id) FILTER (decision = 'accepted' AND provider = 'serpapi') AS sa, count(DISTINCT source_domain) FILTER (decision = 'accepted') AS domains FROM d GROUP BY 1),
dt AS (SELECT lv2, max(n) AS top FROM (SELECT lv2, source_domain, count(DISTINCT content_id) AS n FROM d WHERE decision = 'accepted' GROUP BY ALL) GROUP BY 1),
xa AS (SELECT lv2, count(*) AS lost, count(*) FILTER (provider = 'tavily') AS xt, count(*) FILTER (provider = 'serpapi') AS xs, count(*) FILTER (provider IS NOT NULL) AS xp, count(*) FILTER (reason IN {AFTER_EXTRACTION}) AS tried, count(*) FILTER (reason IN {reports.FAILED}) AS failed, count(*) FILTER (reason IN {REPEATED}) AS repeated FROM x GROUP BY 1),
q AS (SELECT taxonomy_lv2 AS lv2, avg(overall) AS quality, count(*) FILTER (overall >= 4) / count(*) AS high, sum(prompt_tokens) * 0.15 / 1e6 + sum(completion_tokens) * 0.6 / 1e6 AS cost FROM content_quality_scores WHERE overall BETWEEN 1 AND 5 AND NOT isnan(overall) GROUP BY 1)
SELECT lv2, runs, target, accepted, accepted / target AS target_rate, accepted / (found + coalesce(lost, 0)) AS accept_rate, found + coalesce(lost, 0) - accepted AS failures, found + coalesce(lost, 0) AS candidates,
  coalesce(tavily_calls, 0) AS tavily_calls, coalesce(serpapi_calls, 0) AS serpapi_calls, (ft + coalesce(xt, 0)) / (found + coalesce(xp, 0)) AS tavily_share, (fs + coalesce(xs, 0)) / (found + coalesce(xp, 0)) AS serpapi_share,
  ta / nullif(accepted, 0) AS tavily_accepted, sa / nullif(accepted, 0) AS serpapi_accepted, (accepted + coalesce(tried, 0) - coalesce(failed, 0)) / nullif(accepted + coalesce(tried, 0), 0) AS extraction_rate, coalesce(repeated, 0) / (found + coalesce(lost, 0)) AS duplicate_rate,
  quality, high, uc.cost AS collection_cost, q.cost AS scoring_cost, uc.cost / nullif(accepted, 0) AS cost_each, elapsed_s, elapsed_s / nullif(accepted, 0) AS seconds_each, domains, top / nullif(accepted, 0) AS top_domain_share
FROM r JOIN da USING (lv2) LEFT JOIN dt USING (lv2) LEFT JOIN xa USING (lv2) LEFT JOIN uc USING (lv2) LEFT JOIN q USING (lv2) ORDER BY lv2"""
)
def group_report(s: SparkSession, d: str) -> DataFrame:
    """The full row of figures of each group over its runs, by group: targets, outcomes, calls, shares, rates, quality, cost, time, domains."""
    r = table(s, d, "collection_runs").withColumn("t", F.from_json("settings_snapshot", "target_count int, targets array<string>"))
    t = r.withColumn("lv2", F.explode(F.array_distinct(F.transform("t.targets", lambda x: F.split_part(x, F.lit("::"), F.lit(1))))))
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    spent = F.greatest(us(F.coalesce("finished_at", F.lit(reports.NOW).cast("timestamp_ntz"))) - us(F.col("started_at")), F.lit(0)) / 1e6
    runs = t.groupBy("lv2").agg(F.count("*").alias("runs"), F.max("t.target_count").alias("target"), F.sum(spent).alias("elapsed_s"))
    calls = t.select("lv2", F.explode(F.from_json("provider_usage_summary", reports.USAGE)).alias("provider", "entries")).select("lv2", "provider", F.explode("entries").alias("x"))
    paid = lambda c: F.coalesce(F.sum(F.when(F.col("provider") == "openai", F.col(f"x.{c}"))), F.lit(0))
    calls = calls.groupBy("lv2").agg(*[F.count_if(F.col("provider") == p).alias(f"{p}_calls") for p in ("tavily", "serpapi")], (paid("prompt_tokens") * 0.15 / 1e6 + paid("completion_tokens") * 0.6 / 1e6).alias("collection_cost"))
    of = t.select("lv2", "run_id")
    q = table(s, d, "search_queries").select(F.col("id").alias("query_id"), "taxonomy_lv2", "type_name", F.col("provider").alias("asked"))
    m = table(s, d, "content_taxonomy_mappings").select("content_id", "taxonomy_lv2", "type_name", "decision")
    c = table(s, d, "contents").select(F.col("id").alias("content_id"), "source_domain")
    f = table(s, d, "content_discoveries").select("run_id", "query_id", "content_id", "provider").join(q, "query_id").join(c, "content_id").join(m, ["content_id", "taxonomy_lv2", "type_name"], "left").join(of, "run_id")
    good = F.col("decision") == "accepted"
    some = lambda w: F.countDistinct(F.when(w, F.col("content_id")))
    by = {p: F.col("provider") == p for p in ("tavily", "serpapi")}
    found = f.groupBy("lv2").agg(F.count("*").alias("found"), *[F.count_if(w).alias(f"f_{p}") for p, w in by.items()], some(good).alias("accepted"), *[some(good & w).alias(f"a_{p}") for p, w in by.items()], F.countDistinct(F.when(good, F.col("source_domain"))).alias("domains"))
    top = f.where(good).groupBy("lv2", "source_domain").agg(F.countDistinct("content_id").alias("n")).groupBy("lv2").agg(F.max("n").alias("top"))
    x = table(s, d, "discarded_candidates").select("run_id", "query_id", "reason").join(q, "query_id", "left").join(of, "run_id")
    lost = x.groupBy("lv2").agg(
        F.count("*").alias("lost"), *[F.count_if(F.col("asked") == p).alias(f"x_{p}") for p in by], F.count("asked").alias("x_any"),
        *[F.count_if(F.col("reason").isin(*w)).alias(n) for n, w in (("tried", AFTER_EXTRACTION), ("failed", reports.FAILED), ("repeated", REPEATED))],
    )
    ok = table(s, d, "content_quality_scores").where(F.col("overall").between(1, 5) & ~F.isnan("overall"))
    score = ok.groupBy(F.col("taxonomy_lv2").alias("lv2")).agg(F.avg("overall").alias("quality"), (F.count_if(F.col("overall") >= 4) / F.count("*")).alias("high"), (F.sum("prompt_tokens") * 0.15 / 1e6 + F.sum("completion_tokens") * 0.6 / 1e6).alias("scoring_cost"))
    j = runs.join(found, "lv2").join(top, "lv2", "left").join(lost, "lv2", "left").join(calls, "lv2", "left").join(score, "lv2", "left")
    j = j.fillna(0, ["lost", "x_tavily", "x_serpapi", "x_any", "tried", "failed", "repeated", "tavily_calls", "serpapi_calls"])
    rate = F.try_divide
    col = F.col
    every, met, named = col("found") + col("lost"), col("accepted") + col("tried"), col("found") + col("x_any")
    return j.select(
        "lv2", "runs", "target", "accepted", rate(col("accepted"), col("target")).alias("target_rate"), rate(col("accepted"), every).alias("accept_rate"), (every - col("accepted")).alias("failures"), every.alias("candidates"),
        "tavily_calls", "serpapi_calls", *[rate(col(f"f_{p}") + col(f"x_{p}"), named).alias(f"{p}_share") for p in by], *[rate(col(f"a_{p}"), col("accepted")).alias(f"{p}_accepted") for p in by],
        rate(met - col("failed"), met).alias("extraction_rate"), rate(col("repeated"), every).alias("duplicate_rate"), "quality", "high", "collection_cost", "scoring_cost", rate(col("collection_cost"), col("accepted")).alias("cost_each"),
        "elapsed_s", rate(col("elapsed_s"), col("accepted")).alias("seconds_each"), "domains", rate(col("top"), col("accepted")).alias("top_domain_share"),
    ).orderBy("lv2")


@query("SELECT id FROM contents WHERE id IN (SELECT id FROM contents ORDER BY id LIMIT 100)")
def first_rows(s: SparkSession, d: str) -> DataFrame:
    """The first hundred rows; the limit is the feature."""
    return table(s, d, "contents").select("id").orderBy("id").limit(100)


def queries() -> dict:
    return Q


def oracle_sql() -> dict:
    return SQL
