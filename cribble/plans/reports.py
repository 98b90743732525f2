"""Queries of the reference's reports: joins over provenance, rates, fading scores, budgets, run statistics."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from cribble.functions import rules
from cribble.operators import scoring
from cribble.operators.running import running
from cribble.sources.tables import table

NOW = datetime(2025, 9, 1)
NOW_SQL = "TIMESTAMP '2025-09-01 00:00:00'"
# States of a query in which it is searched for.
ACTIVE = ("generated", "user_edited", "user_created")
PRICES = {"prompt": 0.15, "completion": 0.6, "web_call": 10.0}
Q: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(f):
        Q[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


def _queries(s, d, *cols):
    return table(s, d, "search_queries").select(F.col("id").alias("query_id"), *cols)


def _contents(s, d, *cols):
    return table(s, d, "contents").select(F.col("id").alias("content_id"), *cols)


@query("SELECT DISTINCT taxonomy_lv2, type_name FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE c.status = 'accepted' AND m.decision = 'accepted'")
def accepted_type_pairs(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'")
    return m.join(_contents(s, d, "status").where("status = 'accepted'"), "content_id").select("taxonomy_lv2", "type_name").distinct()


@query(
    """SELECT DISTINCT d.run_id, q.taxonomy_lv2, q.type_name, c.id AS content_id, c.canonical_url FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id JOIN contents c ON c.id = d.content_id
JOIN content_taxonomy_mappings m ON m.content_id = c.id AND m.taxonomy_lv2 = q.taxonomy_lv2 AND m.type_name = q.type_name WHERE m.decision = 'accepted' AND c.status = 'accepted'"""
)
def export_run_join(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'").select("content_id", "taxonomy_lv2", "type_name")
    c = _contents(s, d, "status", "canonical_url").where("status = 'accepted'").drop("status")
    j = table(s, d, "content_discoveries").select("run_id", "query_id", "content_id").join(_queries(s, d, "taxonomy_lv2", "type_name"), "query_id")
    return j.join(m, ["content_id", "taxonomy_lv2", "type_name"]).join(c, "content_id").select("run_id", "taxonomy_lv2", "type_name", "content_id", "canonical_url").distinct()


@query(
    """SELECT d.id, d.run_id, q.taxonomy_lv2, q.type_name, c.source_domain, m.decision FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id JOIN contents c ON c.id = d.content_id
LEFT JOIN content_taxonomy_mappings m ON m.content_id = c.id AND m.taxonomy_lv2 = q.taxonomy_lv2 AND m.type_name = q.type_name"""
)
def discoveries_by_run(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "content_taxonomy_mappings").select("content_id", "taxonomy_lv2", "type_name", "decision")
    j = table(s, d, "content_discoveries").select("id", "run_id", "query_id", "content_id").join(_queries(s, d, "taxonomy_lv2", "type_name"), "query_id").join(_contents(s, d, "source_domain"), "content_id")
    return j.join(m, ["content_id", "taxonomy_lv2", "type_name"], "left").select("id", "run_id", "taxonomy_lv2", "type_name", "source_domain", "decision")


@query(
    """SELECT m.id, m.content_id, m.decision, c.title, (SELECT provider FROM content_discoveries d WHERE d.content_id = c.id ORDER BY discovered_at, id LIMIT 1) AS provider
FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id"""
)
def content_with_first_provider(s: SparkSession, d: str) -> DataFrame:
    first = table(s, d, "content_discoveries").groupBy("content_id").agg(F.min_by("provider", F.struct("discovered_at", "id")).alias("provider"))
    m = table(s, d, "content_taxonomy_mappings").select("id", "content_id", "decision")
    return m.join(_contents(s, d, "title"), "content_id").join(first, "content_id", "left").select("id", "content_id", "decision", "title", "provider")


@query(
    """SELECT taxonomy_lv2, type_name, count(*) AS n FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id
WHERE c.status = 'accepted' AND m.decision = 'accepted' GROUP BY ROLLUP (taxonomy_lv2, type_name)"""
)
def accepted_counts_rollup(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'")
    return m.join(_contents(s, d, "status").where("status = 'accepted'"), "content_id").rollup("taxonomy_lv2", "type_name").agg(F.count("*").alias("n"))


# Reasons that say that a page was fetched and gave no text.
FAILED = ("extraction_empty", "extraction_too_short")


@query(
    f"""WITH a AS (SELECT source_domain, count(*) AS ok FROM contents GROUP BY 1), b AS (SELECT source_domain, count(*) AS bad FROM discarded_candidates WHERE reason IN {FAILED} AND source_domain IS NOT NULL GROUP BY 1)
SELECT source_domain, coalesce(ok, 0) AS ok, coalesce(bad, 0) AS bad, coalesce(ok, 0) / (coalesce(ok, 0) + coalesce(bad, 0)) AS success_rate FROM a FULL JOIN b USING (source_domain)"""
)
def domain_success_rate(s: SparkSession, d: str) -> DataFrame:
    """Whatever is stored, accepted or not, was extracted; only pages without a text failed."""
    ok = table(s, d, "contents").groupBy("source_domain").agg(F.count("*").alias("ok"))
    bad = table(s, d, "discarded_candidates").where(F.col("reason").isin(*FAILED) & F.col("source_domain").isNotNull()).groupBy("source_domain").agg(F.count("*").alias("bad"))
    j = ok.join(bad, "source_domain", "full").fillna(0, ["ok", "bad"])
    return j.withColumn("success_rate", scoring.rate(F.col("ok"), F.col("ok") + F.col("bad")))


@query(
    """SELECT * FROM (SELECT source_domain, success_rate, CAST(row_number() OVER (ORDER BY coalesce(success_rate, 1.0), source_domain) AS INTEGER) AS place FROM ("""
    + f"""WITH a AS (SELECT source_domain, count(*) AS ok FROM contents GROUP BY 1), b AS (SELECT source_domain, count(*) AS bad FROM discarded_candidates WHERE reason IN {FAILED} AND source_domain IS NOT NULL GROUP BY 1)
SELECT source_domain, coalesce(ok, 0) / (coalesce(ok, 0) + coalesce(bad, 0)) AS success_rate FROM a FULL JOIN b USING (source_domain))) WHERE place <= 50"""
)
def worst_domains(s: SparkSession, d: str) -> DataFrame:
    """The fifty domains of the least success, an unknown rate counting as 1; the limit is the feature."""
    top = domain_success_rate(s, d).select("source_domain", "success_rate").orderBy(F.coalesce("success_rate", F.lit(1.0)), "source_domain").limit(50)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.coalesce("success_rate", F.lit(1.0)), "source_domain")))


@query("SELECT provider, count(DISTINCT query_id) AS queries, count(*) AS results, count(DISTINCT content_id) AS contents FROM content_discoveries GROUP BY 1")
def provider_counts(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "content_discoveries")
    return t.groupBy("provider").agg(F.countDistinct("query_id").alias("queries"), F.count("*").alias("results"), F.countDistinct("content_id").alias("contents"))


@query("SELECT count(*) AS calls, coalesce(sum(prompt_tokens), 0)::BIGINT AS prompt_tokens, coalesce(sum(completion_tokens), 0)::BIGINT AS completion_tokens, round(coalesce(sum(elapsed_s), 0), 4) AS elapsed_s FROM content_quality_scores")
def usage_totals(s: SparkSession, d: str) -> DataFrame:
    zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    return table(s, d, "content_quality_scores").agg(F.count("*").alias("calls"), zero("prompt_tokens"), zero("completion_tokens"), F.round(F.coalesce(F.sum("elapsed_s"), F.lit(0.0)), 4).alias("elapsed_s"))


USAGE = "map<string,array<struct<prompt_tokens:bigint,completion_tokens:bigint,elapsed_s:double>>>"


@query(
    """WITH p AS (SELECT u.run_id, k.provider, json_extract(u.provider_usage_summary, '$.' || k.provider) AS a FROM collection_runs u, (SELECT unnest(['tavily', 'serpapi', 'openai']) AS provider) k WHERE provider_usage_summary IS NOT NULL),
e AS (SELECT provider, unnest(CAST(a AS JSON[])) AS x FROM p)
SELECT provider, count(*) AS entries, CAST(coalesce(sum(CAST(x->>'prompt_tokens' AS BIGINT)), 0) AS BIGINT) AS prompt_tokens, CAST(coalesce(sum(CAST(x->>'completion_tokens' AS BIGINT)), 0) AS BIGINT) AS completion_tokens,
  round(coalesce(sum(CAST(x->>'elapsed_s' AS DOUBLE)), 0), 4) AS elapsed_s FROM e GROUP BY 1"""
)
def nested_usage_totals(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "collection_runs").select(F.explode(F.from_json("provider_usage_summary", USAGE)).alias("provider", "entries"))
    e = m.select("provider", F.explode("entries").alias("x"))
    zero = lambda c: F.coalesce(F.sum(f"x.{c}"), F.lit(0)).alias(c)
    return e.groupBy("provider").agg(F.count("*").alias("entries"), zero("prompt_tokens"), zero("completion_tokens"), F.round(F.coalesce(F.sum("x.elapsed_s"), F.lit(0.0)), 4).alias("elapsed_s"))


def _events(s, d):
    q = _queries(s, d, F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type"), "provider")
    found = table(s, d, "content_discoveries").select("query_id", "content_id").join(_contents(s, d, "status"), "content_id").select("query_id", (F.col("status") == "accepted").alias("ok"))
    lost = table(s, d, "discarded_candidates").where("query_id is not null").select("query_id", F.lit(False).alias("ok"))
    return found.unionByName(lost).join(q, "query_id").select("lv2", "type", "provider", "ok")


EVENTS_SQL = """e AS (SELECT q.taxonomy_lv2 AS lv2, q.type_name AS type, q.provider, x.ok FROM (
  SELECT query_id, c.status = 'accepted' AS ok FROM content_discoveries d JOIN contents c ON c.id = d.content_id UNION ALL SELECT query_id, false FROM discarded_candidates WHERE query_id IS NOT NULL) x JOIN search_queries q ON q.id = x.query_id)"""
TIERS_SQL = f"""WITH {EVENTS_SQL},
a AS (SELECT lv2, type, provider, count(*) AS n, sum(ok::INT) AS k FROM e GROUP BY ALL), b AS (SELECT lv2, provider, count(*) AS n, sum(ok::INT) AS k FROM e GROUP BY ALL), c AS (SELECT provider, count(*) AS n, sum(ok::INT) AS k FROM e GROUP BY ALL),
t AS (SELECT a.lv2, a.type, a.provider, CASE WHEN a.n >= 30 THEN a.k / a.n WHEN b.n >= 30 THEN b.k / b.n WHEN c.n >= 30 THEN c.k / c.n END AS rate, CASE WHEN a.n >= 30 THEN 1 WHEN b.n >= 30 THEN 2 WHEN c.n >= 30 THEN 3 END AS tier
  FROM a JOIN b USING (lv2, provider) JOIN c USING (provider))"""


@query(TIERS_SQL + " SELECT lv2, type, provider, rate, tier FROM t")
def survival_tiers(s: SparkSession, d: str) -> DataFrame:
    return scoring.survival(_events(s, d))


@query(TIERS_SQL + " SELECT lv2, type, provider, coalesce(least(greatest(1.1 / greatest(rate, 0.25), 1.1), 4.0), 2.0) AS multiplier FROM t")
def adaptive_multiplier(s: SparkSession, d: str) -> DataFrame:
    return scoring.survival(_events(s, d)).select("lv2", "type", "provider", scoring.multiplier(F.col("rate")).alias("multiplier"))


@query(
    """WITH r AS (SELECT provider, run_id, query_id, count(*) AS n FROM content_discoveries GROUP BY ALL), y AS (SELECT provider, CASE WHEN count(*) >= 10 AND avg(n) <> 0 THEN avg(n) ELSE 10.0 END AS avg_yield FROM r GROUP BY 1)
SELECT provider, avg_yield, 100.0 * avg_yield / sum(avg_yield) OVER () AS percent FROM y"""
)
def yield_weighted_ratio(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "content_discoveries").groupBy("provider", "run_id", "query_id").agg(F.count("*").alias("n"))
    y = r.groupBy("provider").agg(F.when((F.count("*") >= 10) & (F.avg("n") != 0), F.avg("n")).otherwise(F.lit(10.0)).alias("avg_yield"))
    return y.withColumn("percent", F.lit(100.0) * F.col("avg_yield") / F.sum("avg_yield").over(Window.partitionBy(F.lit(0))))


def _decay_sql(ts: str) -> str:
    return f"pow(0.5, greatest(epoch_us({NOW_SQL}) - epoch_us({ts}), 0) / 86400000000.0 / 14.0)"


@query(
    f"""WITH v AS (SELECT d.query_id AS id, {_decay_sql('d.discovered_at')} AS w, CASE WHEN c.status = 'accepted' THEN 1.0 ELSE 0.3 END AS v FROM content_discoveries d JOIN contents c ON c.id = d.content_id),
s AS (SELECT id, sum(w * v) / sum(w) AS score FROM v GROUP BY 1) SELECT q.id AS query_id, round(coalesce(s.score, 0.5), 9) AS score FROM search_queries q LEFT JOIN s ON s.id = q.id"""
)
def query_score(s: SparkSession, d: str, executions: DataFrame | None = None) -> DataFrame:
    """Faded mean of what a query found: 1 for an accepted record, 0.3 for another.

    executions (query_id, result_count, started_at), where they are recorded, count 1 with results and 0 without. The
    test tables have none.
    """
    found = table(s, d, "content_discoveries").select("query_id", "content_id", F.col("discovered_at").alias("ts")).join(_contents(s, d, "status"), "content_id")
    events = found.select("query_id", "ts", F.when(F.col("status") == "accepted", 1.0).otherwise(0.3).alias("value"))
    if executions is not None:
        events = events.unionByName(executions.select("query_id", F.col("started_at").alias("ts"), F.when(F.col("result_count") > 0, 1.0).otherwise(0.0).alias("value")))
    scores = scoring.faded_mean(events, "query_id", NOW)
    return _queries(s, d).join(scores, "query_id", "left").select("query_id", F.round(F.coalesce("score", F.lit(scoring.NEUTRAL)), 9).alias("score"))


def _outcomes(s, d):
    good = table(s, d, "contents").select(F.col("source_domain").alias("domain"), F.col("first_discovered_at").alias("ts"), F.lit(True).alias("ok"), F.col("id"))
    bad = table(s, d, "discarded_candidates").where(F.col("reason").isin(*FAILED) & F.col("source_domain").isNotNull())
    return good.unionByName(bad.select(F.col("source_domain").alias("domain"), F.col("discarded_at").alias("ts"), F.lit(False).alias("ok"), (-F.col("id")).alias("id")))


OUTCOMES_SQL = f"""o AS (SELECT source_domain AS domain, first_discovered_at AS ts, true AS ok, id FROM contents
  UNION ALL SELECT source_domain, discarded_at, false, -id FROM discarded_candidates WHERE reason IN {FAILED} AND source_domain IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY ts DESC, id DESC) AS rn FROM o),
f AS (SELECT domain, CAST(coalesce(min(CASE WHEN ok THEN rn END) - 1, count(*)) AS INTEGER) AS streak FROM r WHERE rn <= 5 GROUP BY 1)"""


@query(f"WITH {OUTCOMES_SQL} SELECT domain, streak FROM f")
def failure_streak(s: SparkSession, d: str) -> DataFrame:
    return scoring.leading_streak(_outcomes(s, d), "domain")


@query(
    f"""WITH {OUTCOMES_SQL}, m AS (SELECT domain, sum({_decay_sql('ts')} * ok::INT) / sum({_decay_sql('ts')}) AS base FROM o GROUP BY 1)
SELECT domain, round(greatest(base - least(0.1 * streak, 0.4), 0.0), 9) AS score FROM m JOIN f USING (domain)"""
)
def domain_score(s: SparkSession, d: str) -> DataFrame:
    o = _outcomes(s, d)
    base = scoring.faded_mean(o.select("domain", "ts", F.col("ok").cast("int").alias("value")), "domain", NOW)
    j = base.join(scoring.leading_streak(o, "domain"), "domain")
    return j.select("domain", F.round(F.greatest(F.col("score") - F.least(0.1 * F.col("streak"), F.lit(0.4)), F.lit(0.0)), 9).alias("score"))


@query(
    f"""WITH a AS (SELECT *, count(*) OVER (PARTITION BY normalized_url, reason) AS attempts FROM discarded_candidates),
l AS (SELECT a.*, q.taxonomy_lv2, q.type_name, row_number() OVER (PARTITION BY a.normalized_url, q.taxonomy_lv2, q.type_name ORDER BY a.discarded_at DESC, a.id DESC) AS k FROM a JOIN search_queries q ON q.id = a.query_id WHERE a.retryable)
SELECT id, normalized_url, taxonomy_lv2, type_name, reason, attempts FROM l WHERE k = 1 AND attempts < CASE {" ".join(f"WHEN reason = '{k}' THEN {n}" for k, (_, n) in rules.RETRY.items())} ELSE 1 END
  AND NOT EXISTS (SELECT 1 FROM contents c WHERE c.canonical_url = l.normalized_url)"""
)
def retry_queue(s: SparkSession, d: str) -> DataFrame:
    """The latest discard that may be retried of each address and type, if attempts are left, counted over all discards."""
    a = table(s, d, "discarded_candidates").select("id", "normalized_url", "reason", "query_id", "retryable", "discarded_at")
    # counted before any filter; an aggregate, not a window, as one address may have any number of discards
    a = a.join(a.groupBy("normalized_url", "reason").agg(F.count("*").alias("attempts")), ["normalized_url", "reason"])
    j = a.where("retryable").join(_queries(s, d, "taxonomy_lv2", "type_name"), "query_id")
    last = j.groupBy("normalized_url", "taxonomy_lv2", "type_name").agg(F.max_by(F.struct("id", "reason", "attempts"), F.struct("discarded_at", "id")).alias("x"))
    last = last.select("x.*", "normalized_url", "taxonomy_lv2", "type_name").where(F.col("attempts") < rules.most_attempts(F.col("reason")))
    stored = table(s, d, "contents").select(F.col("canonical_url").alias("normalized_url"))
    return last.join(stored, "normalized_url", "left_anti").select("id", "normalized_url", "taxonomy_lv2", "type_name", "reason", "attempts")


@query("SELECT query_id, arg_max(n, t) AS result_count FROM (SELECT query_id, run_id, count(*) AS n, (max(discovered_at), run_id) AS t FROM content_discoveries GROUP BY query_id, run_id) GROUP BY 1")
def latest_result_count(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "content_discoveries").groupBy("query_id", "run_id").agg(F.count("*").alias("n"), F.max("discovered_at").alias("t"))
    return r.groupBy("query_id").agg(F.max_by("n", F.struct("t", "run_id")).alias("result_count"))


@query(
    """SELECT url, overall FROM (SELECT c.canonical_url AS url, s.overall, row_number() OVER (PARTITION BY c.canonical_url ORDER BY s.scored_at DESC, s.run_id DESC, s.taxonomy_lv2 DESC, s.type_name DESC, s.overall DESC NULLS LAST) AS k
FROM content_quality_scores s JOIN contents c ON c.id = s.content_id WHERE NOT coalesce(isnan(s.overall), false)) WHERE k = 1"""
)
def latest_score_by_url(s: SparkSession, d: str) -> DataFrame:
    q = table(s, d, "content_quality_scores").where(~F.coalesce(F.isnan("overall"), F.lit(False)))
    last = q.groupBy("content_id").agg(F.max(F.struct("scored_at", "run_id", "taxonomy_lv2", "type_name", "overall")).alias("x"))
    return last.join(_contents(s, d, F.col("canonical_url").alias("url")), "content_id").select("url", "x.overall")


@query("SELECT lv2, arg_max(run_id, (started_at, id)) AS run_id FROM (SELECT *, split_part(unnest(CAST(settings_snapshot::JSON->'targets' AS VARCHAR[])), '::', 1) AS lv2 FROM collection_runs) WHERE lv2 IS NOT NULL GROUP BY 1")
def latest_run(s: SparkSession, d: str) -> DataFrame:
    r = table(s, d, "collection_runs").withColumn("target", F.explode(F.from_json("settings_snapshot", "targets array<string>")["targets"]))
    r = r.withColumn("lv2", F.split_part("target", F.lit("::"), F.lit(1)))
    return r.where("lv2 is not null").groupBy("lv2").agg(F.max_by("run_id", F.struct("started_at", "id")).alias("run_id"))


@query(
    """WITH x AS (SELECT id, run_id, reason, row_number() OVER (PARTITION BY run_id ORDER BY id) AS i, row_number() OVER (PARTITION BY run_id, reason = 'unexpected_error' ORDER BY id) AS j FROM discarded_candidates WHERE run_id IS NOT NULL),
g AS (SELECT *, CASE WHEN reason = 'unexpected_error' THEN row_number() OVER (PARTITION BY run_id, i - j ORDER BY id) END AS streak FROM x WHERE reason = 'unexpected_error'),
b AS (SELECT run_id, min(id) AS broke FROM g WHERE streak = 5 GROUP BY 1)
SELECT x.id, x.run_id FROM x LEFT JOIN b USING (run_id) WHERE b.broke IS NULL OR x.id <= b.broke"""
)
def circuit_breaker(s: SparkSession, d: str) -> DataFrame:
    """Discards of a run up to its fifth unexpected error in a row."""
    t = table(s, d, "discarded_candidates").where("run_id is not null").select("id", "run_id", (F.col("reason") == "unexpected_error").alias("bad"))
    # errors since the last other outcome: running sums over ranges of ids, so that no run is gathered in one task
    t = running(t.withColumn("good", (~F.col("bad")).cast("long")), ["run_id"], F.col("id"), F.shiftright("id", 12), "good", "goods")
    bad = running(t.where("bad").withColumn("one", F.lit(1)), ["run_id", "goods"], F.col("id"), F.shiftright("id", 12), "one", "before")
    broke = bad.where("before = 4").groupBy("run_id").agg(F.min("id").alias("broke"))
    return t.join(broke, "run_id", "left").where("broke is null or id <= broke").select("id", "run_id")


@query(
    """WITH x AS (SELECT d.id, q.taxonomy_lv2 AS lv2, c.status = 'accepted' AS ok, (row_number() OVER (PARTITION BY q.taxonomy_lv2 ORDER BY d.id) - 1) // 25 AS chunk FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id JOIN contents c ON c.id = d.content_id)
SELECT id, lv2, chunk, coalesce(sum(ok::INT) OVER (PARTITION BY lv2 ORDER BY chunk RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) >= 30 AS skipped FROM x"""
)
def target_cutoff(s: SparkSession, d: str) -> DataFrame:
    """Candidates that come after their group reached 30 accepted, seen from whole chunks of 25."""
    j = table(s, d, "content_discoveries").select("id", "query_id", "content_id").join(_queries(s, d, F.col("taxonomy_lv2").alias("lv2")), "query_id").join(_contents(s, d, "status"), "content_id")
    x = j.select("id", "lv2", (F.col("status") == "accepted").cast("long").alias("ok"), F.lit(1).alias("one"))
    x = running(x, ["lv2"], F.col("id"), F.shiftright("id", 12), "one", "before").withColumn("chunk", F.floor(F.col("before") / 25))
    c = x.groupBy("lv2", "chunk").agg(F.sum("ok").alias("ok"))
    c = running(c, ["lv2"], F.col("chunk"), F.shiftright("chunk", 12), "ok", "sofar")
    return x.select("id", "lv2", "chunk").join(c.select("lv2", "chunk", "sofar"), ["lv2", "chunk"]).select("id", "lv2", "chunk", (F.col("sofar") >= 30).alias("skipped"))


@query("SELECT reason, count(*) AS n, count(*) / sum(count(*)) OVER () AS rate FROM (SELECT reason FROM discarded_candidates UNION ALL SELECT split_part(decision_reason, ':', 1) FROM content_taxonomy_mappings WHERE decision = 'excluded') GROUP BY 1")
def reason_histogram(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'excluded'").select(F.split_part("decision_reason", F.lit(":"), F.lit(1)).alias("reason"))
    n = table(s, d, "discarded_candidates").select("reason").unionByName(m).groupBy("reason").agg(F.count("*").alias("n"))
    return n.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


@query("WITH p AS (SELECT provider, count(*) AS n FROM (SELECT provider FROM content_discoveries UNION ALL SELECT q.provider FROM discarded_candidates x JOIN search_queries q ON q.id = x.query_id) GROUP BY 1) SELECT provider, n, n / sum(n) OVER () AS share FROM p")
def provider_share(s: SparkSession, d: str) -> DataFrame:
    lost = table(s, d, "discarded_candidates").select("query_id").join(_queries(s, d, "provider"), "query_id").select("provider")
    p = table(s, d, "content_discoveries").select("provider").unionByName(lost).groupBy("provider").agg(F.count("*").alias("n"))
    return p.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0))))


@query("SELECT lv2, count(*) AS domains, max(n) / sum(n) AS top_share FROM (SELECT m.taxonomy_lv2 AS lv2, c.source_domain, count(DISTINCT c.id) AS n FROM content_taxonomy_mappings m JOIN contents c ON c.id = m.content_id WHERE m.decision = 'accepted' GROUP BY ALL) GROUP BY 1")
def top_domain_share(s: SparkSession, d: str) -> DataFrame:
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'").select("content_id", F.col("taxonomy_lv2").alias("lv2")).join(_contents(s, d, "source_domain"), "content_id")
    n = m.groupBy("lv2", "source_domain").agg(F.countDistinct("content_id").alias("n"))
    return n.groupBy("lv2").agg(F.count("*").alias("domains"), (F.max("n") / F.sum("n")).alias("top_share"))


@query(
    """SELECT q.taxonomy_lv2 AS lv2, q.type_name AS type, q.provider, count(*) AS samples, avg(CAST(starts_with(coalesce(m.decision_reason, ''), 'date_out_of_range') AS INT)) AS rate, count(*) >= 20 AND rate >= 0.30 AS inject
FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id JOIN content_taxonomy_mappings m ON m.content_id = d.content_id AND m.taxonomy_lv2 = q.taxonomy_lv2 AND m.type_name = q.type_name GROUP BY ALL"""
)
def date_out_rate(s: SparkSession, d: str) -> DataFrame:
    """By provider, the share of what was found outside the date range, and whether years go into queries."""
    m = table(s, d, "content_taxonomy_mappings").select("content_id", F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type"), F.startswith(F.coalesce("decision_reason", F.lit("")), F.lit("date_out_of_range")).cast("int").alias("hit"))
    q = _queries(s, d, F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type"), "provider")
    j = table(s, d, "content_discoveries").select("query_id", "content_id").join(q, "query_id").join(m, ["content_id", "lv2", "type"])
    g = j.groupBy("lv2", "type", "provider").agg(F.count("*").alias("samples"), F.avg("hit").alias("rate"))
    return g.withColumn("inject", (F.col("samples") >= 20) & (F.col("rate") >= 0.30))


@query("SELECT taxonomy_lv2 AS lv2, count(*) AS scored, avg(overall) AS mean, count(*) FILTER (overall >= 4) / count(*) AS high, count(*) FILTER (overall < 2.5) AS low, sum(prompt_tokens)::BIGINT AS prompt_tokens FROM content_quality_scores WHERE overall BETWEEN 1 AND 5 AND NOT isnan(overall) GROUP BY 1")
def quality_summary(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "content_quality_scores").where(F.col("overall").between(1, 5) & ~F.isnan("overall"))
    return t.groupBy(F.col("taxonomy_lv2").alias("lv2")).agg(F.count("*").alias("scored"), F.avg("overall").alias("mean"), (F.count_if(F.col("overall") >= 4) / F.count("*")).alias("high"), F.count_if(F.col("overall") < 2.5).alias("low"), F.sum("prompt_tokens").alias("prompt_tokens"))


@query("""SELECT issue, count(*) AS n FROM (SELECT unnest(CAST(CASE WHEN json_valid(issues) THEN issues END AS VARCHAR[])) AS issue FROM content_quality_scores WHERE starts_with(issues, '[')) GROUP BY 1""")
def quality_issues(s: SparkSession, d: str) -> DataFrame:
    t = table(s, d, "content_quality_scores").select(F.explode(F.from_json("issues", "array<string>")).alias("issue"))
    return t.where("issue is not null").groupBy("issue").agg(F.count("*").alias("n"))


@query("SELECT m.taxonomy_lv2 AS lv2, count(*) AS labels, avg((m.decision = 'accepted')::INT) AS p, printf('%.4f (%d건)', avg((m.decision = 'accepted')::INT), count(*)) AS text FROM content_taxonomy_mappings m JOIN (SELECT DISTINCT content_id FROM content_quality_scores WHERE overall >= 4 AND NOT isnan(overall)) s USING (content_id) GROUP BY 1")
def label_precision(s: SparkSession, d: str) -> DataFrame:
    good = table(s, d, "content_quality_scores").where((F.col("overall") >= 4) & ~F.isnan("overall")).select("content_id").distinct()
    m = table(s, d, "content_taxonomy_mappings").join(good, "content_id", "left_semi")
    return m.groupBy(F.col("taxonomy_lv2").alias("lv2")).agg(F.count("*").alias("labels"), F.avg((F.col("decision") == "accepted").cast("int")).alias("p")).withColumn("text", F.format_string("%.4f (%d건)", "p", "labels"))


COST_SQL = f"sum(prompt_tokens) * {PRICES['prompt']} / 1e6 + sum(completion_tokens) * {PRICES['completion']} / 1e6 + count(*) * {PRICES['web_call']} / 1e3"


@query(f"SELECT model, round({COST_SQL}, 6) AS cost FROM content_quality_scores GROUP BY 1")
def cost_model(s: SparkSession, d: str) -> DataFrame:
    c = F.sum("prompt_tokens") * F.lit(PRICES["prompt"]) / 1e6 + F.sum("completion_tokens") * F.lit(PRICES["completion"]) / 1e6 + F.count("*") * F.lit(PRICES["web_call"]) / 1e3
    return table(s, d, "content_quality_scores").groupBy("model").agg(F.round(c, 6).alias("cost"))


@query(f"SELECT run_id, status, greatest(epoch_us(coalesce(finished_at, {NOW_SQL})) - epoch_us(started_at), 0) / 1e6 AS elapsed_s FROM collection_runs")
def run_elapsed(s: SparkSession, d: str) -> DataFrame:
    end = F.coalesce(F.col("finished_at"), F.lit(NOW).cast("timestamp_ntz"))
    us = lambda c: F.unix_micros(c.cast("timestamp"))
    return table(s, d, "collection_runs").select("run_id", "status", (F.greatest(us(end) - us(F.col("started_at")), F.lit(0)) / 1e6).alias("elapsed_s"))


@query(
    f"""WITH f AS (SELECT q.taxonomy_lv2 AS lv2, count(DISTINCT d.run_id) AS runs, count(*) AS discoveries, count(DISTINCT d.content_id) AS contents, count(DISTINCT CASE WHEN m.decision = 'accepted' THEN d.content_id END) AS accepted, count(DISTINCT c.source_domain) AS domains
  FROM content_discoveries d JOIN search_queries q ON q.id = d.query_id JOIN contents c ON c.id = d.content_id LEFT JOIN content_taxonomy_mappings m ON m.content_id = c.id AND m.taxonomy_lv2 = q.taxonomy_lv2 AND m.type_name = q.type_name GROUP BY 1),
x AS (SELECT q.taxonomy_lv2 AS lv2, count(*) AS discards, count(*) FILTER (reason IN ('extraction_empty', 'extraction_too_short')) AS not_extracted, count(*) FILTER (reason = 'duplicate') AS duplicates FROM discarded_candidates x JOIN search_queries q ON q.id = x.query_id GROUP BY 1),
s AS (SELECT taxonomy_lv2 AS lv2, round({COST_SQL}, 6) AS cost FROM content_quality_scores GROUP BY 1)
SELECT f.*, coalesce(discards, 0) AS discards, accepted / nullif(contents, 0) AS accept_rate, contents / nullif(contents + coalesce(not_extracted, 0), 0) AS extraction_rate,
  coalesce(duplicates, 0) / nullif(discoveries + coalesce(discards, 0), 0) AS duplicate_rate, round(cost / nullif(accepted, 0), 6) AS cost_per_accepted FROM f LEFT JOIN x USING (lv2) LEFT JOIN s USING (lv2)"""
)
def run_report(s: SparkSession, d: str) -> DataFrame:
    """One row of figures per group: what was found, kept, lost and paid."""
    q = _queries(s, d, F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type"))
    m = table(s, d, "content_taxonomy_mappings").select("content_id", F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type"), "decision")
    j = table(s, d, "content_discoveries").select("run_id", "query_id", "content_id").join(q, "query_id").join(_contents(s, d, "source_domain"), "content_id").join(m, ["content_id", "lv2", "type"], "left")
    f = j.groupBy("lv2").agg(
        F.countDistinct("run_id").alias("runs"), F.count("*").alias("discoveries"), F.countDistinct("content_id").alias("contents"),
        F.countDistinct(F.when(F.col("decision") == "accepted", F.col("content_id"))).alias("accepted"), F.countDistinct("source_domain").alias("domains"),
    )
    x = table(s, d, "discarded_candidates").select("query_id", "reason").join(q, "query_id").groupBy("lv2").agg(
        F.count("*").alias("discards"), F.count_if(F.col("reason").isin("extraction_empty", "extraction_too_short")).alias("not_extracted"), F.count_if(F.col("reason") == "duplicate").alias("duplicates")
    )
    c = F.sum("prompt_tokens") * F.lit(PRICES["prompt"]) / 1e6 + F.sum("completion_tokens") * F.lit(PRICES["completion"]) / 1e6 + F.count("*") * F.lit(PRICES["web_call"]) / 1e3
    p = table(s, d, "content_quality_scores").groupBy(F.col("taxonomy_lv2").alias("lv2")).agg(F.round(c, 6).alias("cost"))
    r = f.join(x, "lv2", "left").join(p, "lv2", "left").fillna(0, ["discards", "not_extracted", "duplicates"])
    return r.select(*f.columns, "discards", scoring.rate(F.col("accepted"), F.col("contents")).alias("accept_rate"), scoring.rate(F.col("contents"), F.col("contents") + F.col("not_extracted")).alias("extraction_rate"),
        scoring.rate(F.col("duplicates"), F.col("discoveries") + F.col("discards")).alias("duplicate_rate"), F.round(F.try_divide("cost", "accepted"), 6).alias("cost_per_accepted"))


@query(
    """WITH t AS (SELECT DISTINCT taxonomy_lv2 AS lv2, type_name AS type FROM search_queries), c AS (SELECT lv2, count(*) AS types FROM t GROUP BY 1),
p AS (SELECT lv2, types * ceil(ceil(50 / types) * 2.0) AS candidates, provider, page, pages FROM c, (VALUES ('tavily', 20, 1), ('serpapi', 10, 10)) v(provider, page, pages)),
n AS (SELECT taxonomy_lv2 AS lv2, provider, count(*) AS queries FROM search_queries WHERE status IN ('generated', 'user_edited', 'user_created') GROUP BY ALL),
w AS (SELECT lv2, provider, least(coalesce(queries, 0) * pages, greatest(ceil(candidates / page), 1) * 2.0) AS w FROM p LEFT JOIN n USING (lv2, provider))
SELECT coalesce(lv2, '(all)') AS lv2, provider, CAST(sum(w) AS DOUBLE) AS worst FROM w GROUP BY GROUPING SETS ((lv2, provider), (provider))"""
)
def preflight_budget(s: SparkSession, d: str, target: int = 50, multiplier: float = 2.0) -> DataFrame:
    """Worst-case requests of each group and provider, and by provider.

    A group's target is shared by its types, rounded up; times the multiplier it is the number of candidates, which
    ask for so many pages; twice as many calls are the budget. All queries with all their pages are the other bound.
    """
    t = table(s, d, "search_queries").select(F.col("taxonomy_lv2").alias("lv2"), "type_name").distinct().groupBy("lv2").agg(F.count("*").alias("types"))
    # Provider, results of a page, pages of a query.
    limits = s.createDataFrame([("tavily", 20, 1), ("serpapi", 10, 10)], "provider string, page int, pages int")
    p = t.join(F.broadcast(limits)).withColumn("candidates", F.col("types") * F.ceil(F.ceil(F.lit(target) / F.col("types")) * F.lit(multiplier)))
    n = table(s, d, "search_queries").where(F.col("status").isin(*ACTIVE)).groupBy(F.col("taxonomy_lv2").alias("lv2"), "provider").agg(F.count("*").alias("queries"))
    w = F.least(F.coalesce("queries", F.lit(0)) * F.col("pages"), F.greatest(F.ceil(F.col("candidates") / F.col("page")), F.lit(1)) * F.lit(2.0))
    g = p.join(n, ["lv2", "provider"], "left").withColumn("w", w).groupingSets([["lv2", "provider"], ["provider"]], "lv2", "provider").agg(F.sum("w").alias("worst"))
    return g.select(F.coalesce("lv2", F.lit("(all)")).alias("lv2"), "provider", "worst")


@query(
    """WITH t AS (SELECT DISTINCT taxonomy_lv2 AS lv2, type_name AS type FROM search_queries), n AS (SELECT lv2, type, count(*) OVER (PARTITION BY lv2) AS k FROM t)
SELECT lv2, type, CAST(ceil(50 / k) AS BIGINT) AS target, CAST(round_even(ceil(50 / k) * 0.7, 0) AS BIGINT) AS tavily, CAST(ceil(50 / k) AS BIGINT) - CAST(round_even(ceil(50 / k) * 0.7, 0) AS BIGINT) AS serpapi FROM n"""
)
def lane_targets(s: SparkSession, d: str) -> DataFrame:
    """A target of 50 shared by a group's types and split 70 to 30 between providers."""
    t = table(s, d, "search_queries").select(F.col("taxonomy_lv2").alias("lv2"), F.col("type_name").alias("type")).distinct()
    t = t.withColumn("target", F.ceil(F.lit(50) / F.count("*").over(Window.partitionBy("lv2"))))
    t = t.withColumn("tavily", F.bround(F.col("target") * F.lit(0.7), 0).cast("long"))
    return t.withColumn("serpapi", F.col("target") - F.col("tavily"))


@query(f"SELECT id, updated_at FROM search_queries WHERE updated_at > TIMESTAMP '2025-02-01 00:00:00' - INTERVAL 48 HOURS")
def ttl_valid(s: SparkSession, d: str) -> DataFrame:
    """Entries younger than 48 hours at a given present."""
    return table(s, d, "search_queries").where("updated_at > timestamp_ntz'2025-02-01 00:00:00' - interval 48 hours").select("id", "updated_at")


@query("SELECT taxonomy_lv2, type_name, content_id FROM content_taxonomy_mappings m WHERE decision = 'accepted' AND NOT EXISTS (SELECT 1 FROM content_quality_scores s WHERE s.content_id = m.content_id AND s.taxonomy_lv2 = m.taxonomy_lv2 AND s.type_name = m.type_name)")
def unscored(s: SparkSession, d: str) -> DataFrame:
    keys = ["content_id", "taxonomy_lv2", "type_name"]
    return table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'").select(*keys).join(table(s, d, "content_quality_scores").select(*keys), keys, "left_anti").select("taxonomy_lv2", "type_name", "content_id")


@query("SELECT id, strftime(discovered_at + INTERVAL 9 HOURS, '%Y-%m-%d %H:%M:%S') AS kst FROM content_discoveries")
def kst_display(s: SparkSession, d: str) -> DataFrame:
    return table(s, d, "content_discoveries").select("id", F.date_format(F.from_utc_timestamp(F.col("discovered_at").cast("timestamp"), "Asia/Seoul"), "yyyy-MM-dd HH:mm:ss").alias("kst"))


@query("SELECT taxonomy_lv2, provider, count(*) FILTER (status IN ('generated', 'user_edited', 'user_created')) AS active FROM search_queries GROUP BY ALL")
def active_query_counts(s: SparkSession, d: str) -> DataFrame:
    ok = F.col("status").isin(*ACTIVE)
    return table(s, d, "search_queries").groupBy("taxonomy_lv2", "provider").agg(F.count_if(ok).alias("active"))


@query("SELECT run_id, array_to_string(list_sort(list_distinct(list_transform(CAST(settings_snapshot::JSON->'targets' AS VARCHAR[]), lambda x: split_part(x, '::', 1)))), ', ') AS label FROM collection_runs")
def run_label(s: SparkSession, d: str) -> DataFrame:
    t = F.from_json("settings_snapshot", "targets array<string>")["targets"]
    return table(s, d, "collection_runs").select("run_id", F.array_join(F.array_sort(F.array_distinct(F.transform(t, lambda x: F.split_part(x, F.lit("::"), F.lit(1))))), ", ").alias("label"))


@query("SELECT run_id, started_at FROM collection_runs ORDER BY started_at DESC, id DESC LIMIT 50")
def recent_runs(s: SparkSession, d: str) -> DataFrame:
    """The fifty latest runs; the limit is the feature."""
    return table(s, d, "collection_runs").orderBy(F.desc("started_at"), F.desc("id")).limit(50).select("run_id", "started_at")


@query(
    """SELECT taxonomy_lv2, type_name, content_id FROM (SELECT *, row_number() OVER (PARTITION BY taxonomy_lv2 ORDER BY md5('42/' || content_id || '/' || type_name), content_id, type_name) AS k
FROM content_taxonomy_mappings WHERE decision = 'accepted') WHERE k <= 30"""
)
def sample_per_group(s: SparkSession, d: str) -> DataFrame:
    """Thirty accepted records of each group in a fixed random order; the limit is the feature."""
    m = table(s, d, "content_taxonomy_mappings").where("decision = 'accepted'").select("taxonomy_lv2", "type_name", "content_id")
    w = Window.partitionBy("taxonomy_lv2").orderBy(F.md5(F.concat_ws("/", F.lit("42"), "content_id", "type_name").cast("binary")), "content_id", "type_name")
    return m.withColumn("k", F.row_number().over(w)).where("k <= 30").drop("k")
