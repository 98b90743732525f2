"""Scoring of records by a plug-in: calls to services happen in partitions, results are columns."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from cribble.functions.rules import query_fault, without_citations
from cribble.functions.text import strip

SCORES = "type_relevance int, korean_locality int, specificity int, injection_suitability int, overall double, issues array<string>"


def score(df: DataFrame, keys: list[str], scorer: Callable[[dict], dict]) -> DataFrame:
    """keys and the score columns of each row. scorer takes a row as a dict; an exception leaves the scores null.

    The cheap filters belong before this: scorers may be slow and paid for.
    """
    names = [c.split()[0] for c in SCORES.split(", ")]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name in keys), SCORES])

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            out = []
            for row in part.to_dict("records"):
                try:
                    got = scorer(row)
                except Exception:  # noqa: BLE001
                    got = {}
                out.append({**{k: row[k] for k in keys}, **{n: got.get(n) for n in names}})
            yield pd.DataFrame(out, columns=[*[f for f in part.columns if f in keys], *names])

    return df.mapInPandas(run, schema)


def stub(row: dict) -> dict:
    """A deterministic stand-in for a scoring service: figures from the text's length and script."""
    text = row.get("content") or ""
    korean = sum("가" <= c <= "힣" for c in text) / len(text) if text else 0.0
    parts = {"type_relevance": 1 + len(text) % 5, "korean_locality": 1 + round(korean * 4), "specificity": 1 + len(set(text.split())) % 5, "injection_suitability": 1 + len(text.split()) % 5}
    return {**parts, "overall": round(sum(parts.values()) / 4, 2), "issues": ["too_short"] if len(text) < 100 else []}


def score_new(rows: DataFrame, done: DataFrame, keys: list[str], scorer: Callable[[dict], dict]) -> DataFrame:
    """done with the scores of the rows that it doesn't hold yet; a row whose scores are null counts as not scored."""
    names = [c.split()[0] for c in SCORES.split(", ")]
    have = done.where("type_relevance is not null").select(*keys, *names)
    return have.unionByName(score(rows.join(have.select(*keys), keys, "left_anti"), keys, scorer).select(*keys, *names))


# The three scales of the rubric.
SCALES = ("taxonomy_alignment", "korean_context_grounding", "context_meaningfulness")
JUDGED = "struct<" + ",".join(f"{k}:struct<score:int,evidence:array<struct<field:string,quote:string>>,reason:string>" for k in SCALES) + ",context_elements:map<string,string>,issue_tags:array<string>>"


def rubric_columns(c: Column) -> list[Column]:
    """Columns of a rubric's answer (JSON): the scores, the tags, and the rest as JSON; all null where the answer can't be read."""
    x = F.from_json(c, JUDGED)
    read = x[SCALES[0]].isNotNull()
    detail = F.to_json(F.struct(*[F.struct(x[k]["evidence"].alias("evidence"), x[k]["reason"].alias("reason")).alias(k) for k in SCALES], x["context_elements"].alias("context_elements")))
    return [*[x[k]["score"].alias(f"quality_{k}") for k in SCALES], F.when(read, F.to_json(F.coalesce(x["issue_tags"], F.array().cast("array<string>")))).alias("quality_issue_tags"), F.when(read, detail).alias("quality_eval_detail")]


def generated(rows: DataFrame, generator: Callable[[dict], list[str]]) -> DataFrame:
    """(provider, taxonomy_lv2, type_name, query_text, rejected) from a plug-in that writes queries for rows (provider, taxonomy_lv2, type_name, ...).

    Texts are stripped, blank ones dropped; a faulty text is rejected, and of equal sound ones all but the first.
    """
    keys = ["provider", "taxonomy_lv2", "type_name"]

    def run(it: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in it:
            out = [(*(r[k] for k in keys), i, t) for r in part.to_dict("records") for i, t in enumerate(generator(r))]
            yield pd.DataFrame(out, columns=[*keys, "i", "query_text"])

    t = rows.mapInPandas(run, "provider string, taxonomy_lv2 string, type_name string, i int, query_text string").withColumn("query_text", strip(F.col("query_text"))).where("query_text <> ''")
    first = t.groupBy(*keys, "query_text").agg(F.min("i").alias("first"))
    fault = F.coalesce(query_fault(F.col("query_text"), F.col("provider")), F.when(F.col("i") > F.col("first"), "duplicate_within_batch"))
    return t.join(first, [*keys, "query_text"]).select(*keys, "query_text", fault.alias("rejected"))


def fresh_terms(answers: DataFrame) -> DataFrame:
    """answers (terms ARRAY<STRING>, calls INT, ...) of a vocabulary search: terms without citations, only short safe ones, in order; at least one call."""
    safe = F.filter(without_citations(F.col("terms")), lambda t: F.length(t).between(1, 12) & ~t.rlike(r"(?U)\d|@|https?://|www\."))
    return answers.withColumn("terms", safe).withColumn("calls", F.greatest(F.coalesce("calls", F.lit(1)), F.lit(1)))
