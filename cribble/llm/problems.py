"""Queries of problems 2, 4 and 7, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cribble.functions.text import content_hash, normalize_title, site
from cribble.functions.urls import normalize_url
from cribble.llm.capping import beyond_cap, share_cap
from cribble.llm.history import repeats
from cribble.operators.scoring import latest_score
from cribble.operators.similar import similar_pairs
from cribble.sources.tables import spread, table

CAP_PERCENT = 2


def _title():
    return F.coalesce("title_normalized", normalize_title(F.coalesce("title", F.lit(""))))


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incoming records that repeat an accepted one."""
    digest = F.coalesce("content_hash", content_hash(F.col("title"), F.col("content")))
    cols = [digest.alias("digest"), _title().alias("title"), "content"]
    old = table(spark, sf_dir, "contents").where("status = 'accepted'")
    new = table(spark, sf_dir, "incoming_contents")
    old = spread(old.select("id", F.col("canonical_url").alias("url"), *cols))
    new = spread(new.select(F.col("incoming_id").alias("id"), "batch_no", normalize_url(F.col("canonical_url")).alias("url"), *cols))
    return repeats(old, new)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted contents beyond the cap of their site."""
    kept = table(spark, sf_dir, "contents").where("status = 'accepted'").select("id", site(F.col("source_domain")).alias("who"))
    scores = latest_score(table(spark, sf_dir, "content_quality_scores"))
    scored = kept.join(scores, kept.id == scores.content_id, "left").select("id", "who", "score")
    return beyond_cap(scored, share_cap(kept.count(), CAP_PERCENT)).select(F.col("id").alias("content_id"))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of similar contents."""
    return similar_pairs(spread(table(spark, sf_dir, "contents").select("id", _title().alias("title"), "content")))


def queries() -> dict:
    return {"p2_found": p2_found, "p4_found": p4_found, "p7_found": p7_found}


P4_SQL = """
WITH a AS (
  SELECT id, regexp_replace(regexp_replace(regexp_replace(lower(source_domain), ':[0-9]*$', ''), '\\.+$', ''), '^www\\.', '') AS who
  FROM contents WHERE status = 'accepted'),
s AS (
  SELECT content_id, overall AS score, row_number() OVER (PARTITION BY content_id ORDER BY scored_at DESC, run_id DESC, taxonomy_lv2 DESC, type_name DESC, overall DESC) AS k
  FROM content_quality_scores WHERE overall >= 1 AND overall <= 5 AND NOT isnan(overall)),
r AS (
  SELECT a.id, row_number() OVER (PARTITION BY who ORDER BY score DESC NULLS LAST, id) AS n
  FROM a LEFT JOIN s ON s.content_id = a.id AND s.k = 1)
SELECT id AS content_id FROM r WHERE n > (SELECT greatest(1, count(*) * 2 // 100) FROM a)
"""

P7_SQL = """
WITH w AS (
  SELECT id, list_distinct(list_filter(regexp_split_to_array(content, '\\s+'), lambda x: x <> '')) AS t, title_normalized, title FROM contents),
d AS (
  SELECT id, t, len(t) AS n,
    coalesce(title_normalized, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(title, '\\[[^\\]]{0,12}\\]', '', 'g'), '\\s*[-|·]\\s*[^-|·]{1,20}$', ''), '(모바일|재게시|전재|송고)\\s*[:\\-]?\\s*', '', 'g'), '(!)!+|(\\?)\\?+|(\\.)\\.+|(…)…+|(,),+|(~)~+', '\\1\\2\\3\\4\\5\\6', 'g'), '\\s+', ' ', 'g'))) AS x
  FROM w WHERE len(t) >= 30),
u AS (SELECT id, unnest(t) AS k FROM d),
c AS (
  SELECT a.id AS id_a, b.id AS id_b, count(*) AS i FROM u a JOIN u b ON a.k = b.k AND a.id < b.id GROUP BY ALL),
j AS (
  SELECT id_a, id_b, i / (p.n + q.n - i) AS j, regexp_replace(p.x, '\\s', '', 'g') AS xa, regexp_replace(q.x, '\\s', '', 'g') AS xb
  FROM c JOIN d p ON p.id = id_a JOIN d q ON q.id = id_b WHERE i / (p.n + q.n - i) >= 0.35),
g AS (
  SELECT *, CASE WHEN len(xa) = 1 THEN [xa] ELSE list_transform(range(1, greatest(len(xa), 1)), lambda z: xa[z:z + 1]) END AS ga,
    CASE WHEN len(xb) = 1 THEN [xb] ELSE list_transform(range(1, greatest(len(xb), 1)), lambda z: xb[z:z + 1]) END AS gb FROM j),
v AS (
  SELECT *, list_sum(list_transform(ga, lambda y: len(list_filter(gb, lambda z: z = y)))) AS ab,
    list_sum(list_transform(ga, lambda y: len(list_filter(ga, lambda z: z = y)))) AS aa,
    list_sum(list_transform(gb, lambda y: len(list_filter(gb, lambda z: z = y)))) AS bb FROM g)
SELECT id_a, id_b FROM v WHERE j >= 0.5 OR (len(ga) > 0 AND len(gb) > 0 AND ab / (sqrt(aa) * sqrt(bb)) >= 0.9)
"""


def oracle_sql() -> dict:
    return {"p4_found": P4_SQL, "p7_found": P7_SQL}
