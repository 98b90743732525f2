"""Queries of the problems on texts, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from cribble.functions.text import site
from cribble.llm import boilerplate, cuts, lines, mixing, pii, problems, residue, tokens
from cribble.operators.lineage import cut
from cribble.sources.tables import spread, table


def _contents(spark: SparkSession, sf_dir: str, *cols) -> DataFrame:
    return spread(table(spark, sf_dir, "contents").select("id", *cols))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that stand in at least five contents of their site."""
    docs = _contents(spark, sf_dir, site(F.col("source_domain")).alias("site"), "content")
    return lines.repeated_lines(docs).select(F.col("id").alias("content_id"), "line_no")


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Non-blank lines outside the main body."""
    bad = cut(residue.residue_ids(_contents(spark, sf_dir, site(F.col("source_domain")).alias("site"), "title", "content")))
    docs = _contents(spark, sf_dir, site(F.col("source_domain")).alias("host"), F.col("source_name").alias("name"), "content")
    return boilerplate.furniture(docs.join(bad, "id", "left_anti")).select(F.col("id").alias("content_id"), "line_no")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal information in contents."""
    return pii.find(_contents(spark, sf_dir, "content")).withColumnRenamed("id", "content_id")


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents that are residue or error pages."""
    return residue.residue_ids(_contents(spark, sf_dir, site(F.col("source_domain")).alias("site"), "title", "content")).withColumnRenamed("id", "content_id")


def _documents(spark: SparkSession, sf_dir: str, *cols) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", *cols))


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each document."""
    return tokens.encode(_documents(spark, sf_dir, "text").withColumnRenamed("doc_id", "id")).withColumnRenamed("id", "doc_id")


def _sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spread(table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    listed = d.join(F.broadcast(table(spark, sf_dir, "mix_targets").select("source")), "source", "left_semi")
    docs = listed.select(F.col("doc_id").alias("id"), "text", "source", F.md5(F.col("text").cast("binary")).alias("text_key"))
    return tokens.token_counts(docs, extra=("source", "text_key")).withColumnRenamed("id", "doc_id")


def p9_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mixture of documents, slot by slot."""
    return mixing.mixture(_sizes(spark, sf_dir), table(spark, sf_dir, "mix_targets"))


def p9_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Actual shares beside the targets."""
    targets = table(spark, sf_dir, "mix_targets")
    return mixing.report(mixing.mixture(_sizes(spark, sf_dir), targets), targets)


def _cuts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cuts.verdicts(spread(table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "source", "text")))


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents whose text was cut."""
    return _cuts(spark, sf_dir).where("cut").select(F.col("id").alias("doc_id"))


def p10_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each source truncates."""
    return cuts.rates(_cuts(spark, sf_dir))


def p1_rebuilt(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents that hold lines their site repeats, without them, maintained over two partitions."""
    docs = _contents(spark, sf_dir, site(F.col("source_domain")).alias("site"), "content")
    part = F.pmod(F.xxhash64("id"), F.lit(2))
    return lines.maintain(lines.LineCounts(spark), [docs.where(part == k) for k in (0, 1)])


def p3_body(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main body of each content."""
    docs = _contents(spark, sf_dir, site(F.col("source_domain")).alias("host"), F.col("source_name").alias("name"), "content")
    return boilerplate.main_body(docs)


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contents with placeholders for personal information."""
    return pii.redact(_contents(spark, sf_dir, "content"))


def queries() -> dict:
    every = [p1_found, p1_rebuilt, p3_found, p3_body, p5_found, p5_redacted, p6_found, p8_ids, p9_mix, p9_report, p10_found, p10_rates]
    return {f.__name__: f for f in every} | problems.queries()


SITE_SQL = "regexp_replace(regexp_replace(regexp_replace(lower(source_domain), ':[0-9]*$', ''), '\\.+$', ''), '^www\\.', '')"
NORM_SQL = "lower(regexp_replace(regexp_replace(trim(regexp_replace(l, '[\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')), '[0-9]+', '0', 'g'), '^ | $', '', 'g'))"
P1_SQL = f"""
WITH d AS (SELECT id, {SITE_SQL} AS site, string_split(content, chr(10)) AS ls FROM contents),
x AS (SELECT id, site, unnest(ls) AS l, unnest(range(len(ls))) AS line_no FROM d),
n AS (SELECT id, site, CAST(line_no AS INTEGER) AS line_no, {NORM_SQL} AS k FROM x),
r AS (SELECT site, k FROM n WHERE len(k) >= 10 GROUP BY site, k HAVING count(DISTINCT id) >= 5)
SELECT id AS content_id, line_no FROM n JOIN r USING (site, k)
"""
REBUILT_SQL = f"""
WITH f AS ({P1_SQL}), d AS (SELECT id, unnest(string_split(content, chr(10))) AS l, unnest(range(len(string_split(content, chr(10))))) AS n FROM contents WHERE id IN (SELECT content_id FROM f))
SELECT d.id, coalesce(string_agg(l, chr(10) ORDER BY n) FILTER (f.content_id IS NULL), '') AS content FROM d LEFT JOIN f ON f.content_id = d.id AND f.line_no = d.n GROUP BY d.id
"""


def oracle_sql() -> dict:
    return {"p1_found": P1_SQL, "p1_rebuilt": REBUILT_SQL} | problems.oracle_sql()
