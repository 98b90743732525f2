"""Result files, run logs and settings: reading and writing."""

from __future__ import annotations

import os
import re

from pyspark.sql import DataFrame, SparkSession, functions as F

# Columns of a result file, in order.
RESULT_COLUMNS = ["title", "content", "date", "url", "source_domain"]
BOM = "﻿"


def read_results(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Result files {lv2}/{type}.csv under path, all columns text, with lv2 and type taken from the path.

    Quoted fields may hold line ends and doubled quotes; a byte-order mark before the header is no part of it.
    """
    names = columns or RESULT_COLUMNS
    schema = ", ".join(f"`{c}` string" for c in names)
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("quote", '"').option("escape", '"').option("enforceSchema", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.csv").csv(path)
    file = F.url_decode(F.col("_metadata.file_path"))
    # a mark that a reader left before the first field
    df = df.withColumn(names[0], F.regexp_replace(names[0], f"^{BOM}", ""))
    return df.select(*names, F.regexp_extract(file, r"([^/]+)/[^/]+\.csv$", 1).alias("lv2"), F.regexp_extract(file, r"([^/]+)\.csv$", 1).alias("type"))


def write_results(df: DataFrame, path: str) -> None:
    """df (lv2, type and the result columns) partitioned by lv2 and type, as CSV with a header."""
    out = df.repartition("lv2", "type").sortWithinPartitions("lv2", "type", F.col("date").asc_nulls_last(), "url")
    out.write.mode("overwrite").partitionBy("lv2", "type").option("header", True).option("quote", '"').option("escape", '"').csv(path)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    """Completed entries of a run log (one JSON object a line); an entry without status counts as completed."""
    df = spark.read.schema("lv2_id string, run_id string, target_count int, status string, logged_at string").json(path)
    return df.where(F.coalesce("status", F.lit("completed")) == "completed")


def latest_runs(log: DataFrame) -> DataFrame:
    """The last run of each group, and the greatest target over its runs."""
    return log.groupBy("lv2_id").agg(F.max_by("run_id", F.struct("logged_at", "run_id")).alias("run_id"), F.max("target_count").alias("target_count"))


def _scalar(v: str):
    v = v.strip()
    if v[:1] in "\"'" and v[-1:] == v[:1] and len(v) > 1:
        return v[1:-1]
    if v[:1] == "[" and v[-1:] == "]":
        return [_scalar(x) for x in re.split(r",\s*", v[1:-1]) if x.strip()]
    if v in ("", "null", "~"):
        return None
    if v in ("true", "false"):
        return v == "true"
    for kind in (int, float):
        try:
            return kind(v)
        except ValueError:
            pass
    return v


def parse_settings(text: str) -> dict:
    """A settings file in the plain subset of YAML: nested maps and lists by indentation, scalars, inline lists."""
    lines = [(len(x) - len(x.lstrip()), re.sub(r"\s+#.*$", "", x).strip()) for x in text.lstrip(BOM).splitlines() if x.strip() and not x.strip().startswith("#")]

    def block(i: int, depth: int):
        if i < len(lines) and lines[i][1].startswith("- "):
            out: list = []
            while i < len(lines) and lines[i][0] == depth and lines[i][1].startswith("- "):
                item = lines[i][1][2:]
                if re.match(r"[^\"'\[\s][^:]*:(\s|$)", item):
                    lines[i] = (depth + 2, item)
                    value, i = block(i, depth + 2)
                else:
                    value, i = _scalar(item), i + 1
                out.append(value)
            return out, i
        found: dict = {}
        while i < len(lines) and lines[i][0] == depth and not lines[i][1].startswith("- "):
            key, _, rest = lines[i][1].partition(":")
            i += 1
            if rest.strip():
                value = _scalar(rest)
            elif i < len(lines) and (lines[i][0] > depth or lines[i][0] == depth and lines[i][1].startswith("- ")):
                value, i = block(i, lines[i][0])
            else:
                value = None
            found[_scalar(key)] = value
        return found, i

    return block(0, lines[0][0])[0] if lines else {}


def read_settings(path: str) -> dict:
    """A settings file; a missing one is an error, an empty one an empty map."""
    if not os.path.exists(path):
        raise FileNotFoundError(path)
    with open(path, encoding="utf-8-sig") as f:
        return parse_settings(f.read())


class Issues(list):
    """Problems of the settings, gathered one after the other."""

    def need(self, sound: bool, text: str) -> None:
        if not sound:
            self.append(text)


def _strings(v) -> bool:
    return isinstance(v, list) and all(isinstance(x, str) for x in v)


def _lists_of_domains(types: dict):
    """(where, list or not) for each type, listed flat or under its group."""
    for key, info in types.items():
        if not isinstance(info, dict):
            yield key, None
        elif "serpapi_allowed_domains" in info:
            yield key, info["serpapi_allowed_domains"]
        else:
            yield from ((f"{key}.{name}", x.get("serpapi_allowed_domains") if isinstance(x, dict) else None) for name, x in info.items())


def _app(c: dict, out: Issues) -> None:
    for part, key in (("database", "path"), ("export", "final_dir")):
        out.need(key in (c.get(part) or {}), f"app: {part}.{key} is missing")


def _collection(c: dict, out: Issues) -> None:
    d, q = c.get("defaults") or {}, c.get("query_generation") or {}
    for key in ("target_count", "candidate_multiplier"):
        out.need((d.get(key) or 0) > 0, f"collection: defaults.{key} must be positive")
    out.need(d.get("candidate_multiplier") in (c.get("candidate_multiplier_options") or []), "collection: defaults.candidate_multiplier is no option")
    for key in ("tavily_count_per_type", "serpapi_count_per_type"):
        out.need((q.get(key) or 0) > 0, f"collection: query_generation.{key} must be positive")
    ratio = c.get("provider_ratio") or {}
    for where, share in [("default", ratio.get("default") or {}), *(ratio.get("by_lv2") or {}).items()]:
        total = sum(share.get(k, 0) for k in ("tavily", "serpapi"))
        out.need(total == 100, f"collection: provider_ratio.{where} sums to {total}")
    for g, months in ((c.get("dates") or {}).get("date_range_months_by_lv2") or {}).items():
        out.need(isinstance(months, int) and months > 0, f"collection: months of {g} must be a positive whole number")


def _providers(c: dict, out: Issues) -> None:
    o = c.get("openai") or {}
    for key in ("model", "query_generation_model"):
        out.need(key in o, f"providers: openai.{key} is missing")
    for key in ("query_generation_input_price_per_1m_usd", "query_generation_output_price_per_1m_usd", "web_search_price_per_1k_calls_usd"):
        out.need(isinstance(o.get(key), (int, float)) and o[key] >= 0, f"providers: openai.{key} is missing or negative")
    for name in ("openai", "tavily", "serpapi"):
        out.need("api_key_env" in (c.get(name) or {}), f"providers: {name}.api_key_env is missing")
    out.need(((c.get("serpapi") or {}).get("max_pages_per_query") or 0) > 0, "providers: serpapi.max_pages_per_query must be positive")


def _taxonomy(c: dict, out: Issues) -> None:
    groups = c.get("taxonomy") or []
    out.need(bool(groups), "taxonomy: no groups")
    for g in groups:
        name, types = g.get("lv2_id", "?"), g.get("types") or []
        out.need(bool(types), f"taxonomy: {name} has no type")
        lists = [("lv2_fallback_vocabulary", g, name)]
        for t in types:
            where = f"{name}.{t.get('name', '?')}"
            for key in ("name", "definition", "description", "include_criteria", "exclude_criteria", "enabled"):
                out.need(key in t, f"taxonomy: {where} has no {key}")
            lists += [(k, t, where) for k in ("search_vocabulary", "collection_exclude_criteria", "harm_positive_exclude_criteria", "query_axes")]
        for key, at, where in lists:
            out.need(key not in at or _strings(at[key]), f"taxonomy: {where}.{key} must be a list of texts")
        names = [t.get("name") for t in types]
        for t in sorted({n for n in names if n and names.count(n) > 1}):
            out.append(f"taxonomy: type {t} is there twice in {name}")


def _domains(c: dict, out: Issues) -> None:
    for where, found in _lists_of_domains(c.get("types") or {}):
        out.need(isinstance(found, list), f"type_domains: {where} must have a list of domains")


def _aliases(c: dict, out: Issues) -> None:
    for name, found in (c.get("groups") or {}).items():
        out.need(isinstance(found, list) and bool(found), f"domain_aliases: {name} must be a list with something in it")


def _blacklist(c: dict, out: Issues) -> None:
    out.need(isinstance(c.get("domains"), list), "blacklist: domains must be a list")


def _extraction(c: dict, out: Issues) -> None:
    x = c.get("cleaning") or {}
    out.need(isinstance(x.get("trailing_section_markers"), list), "extraction: trailing_section_markers must be a list")
    out.need(isinstance(x.get("remove_duplicate_paragraphs"), bool), "extraction: remove_duplicate_paragraphs must be true or false")
    n = x.get("duplicate_paragraph_min_length")
    out.need(isinstance(n, int) and n > 0, "extraction: duplicate_paragraph_min_length must be a positive whole number")


def _retries(c: dict, out: Issues) -> None:
    for key in ("reasons", "rate_limit"):
        out.need(bool(c.get(key)), f"retry_policy: {key} is empty")
    for reason, x in (c.get("reasons") or {}).items():
        out.need((x or {}).get("retry_mode") in ("immediate", "after_parser_update", "never"), f"retry_policy: the mode of {reason} is unknown")


VALIDATORS = {
    "app": _app, "collection": _collection, "providers": _providers, "taxonomy": _taxonomy, "type_domains": _domains, "domain_aliases": _aliases, "blacklist": _blacklist, "extraction": _extraction, "retry_policy": _retries,
}


def settings_issues(cfg: dict) -> list[str]:
    """All problems of the settings files (name to content) at once; a missing file counts as empty."""
    out = Issues()
    for name, check in VALIDATORS.items():
        check(cfg.get(name) or {}, out)
    allowed = {d for _, found in _lists_of_domains((cfg.get("type_domains") or {}).get("types") or {}) for d in found or []}
    both = sorted(allowed & set((cfg.get("blacklist") or {}).get("domains") or []))
    out.need(not both, f"domains are allowed and blocked: {', '.join(both)}")
    return list(out)


def write_result_file(df: DataFrame, path: str) -> None:
    """One result file with a byte-order mark, written beside its place and then renamed, so that readers see the old or the new.

    For people's tools, after write_results; rows come to the driver one partition at a time. Nulls are empty.
    """
    import csv

    names = RESULT_COLUMNS + [c for c in df.columns if c not in RESULT_COLUMNS]
    rest = f"{path}.tmp"
    with open(rest, "w", newline="", encoding="utf-8-sig") as f:
        w = csv.writer(f)
        w.writerow(names)
        for row in df.select(*names).toLocalIterator():
            w.writerow(["" if v is None else v for v in row])
    os.replace(rest, path)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    """Times that people took (LV2, count, seconds), with seconds an item; an absent file gives no rows."""
    schema = "lv2 string, items long, seconds double"
    if not os.path.exists(path):
        return spark.createDataFrame([], schema).withColumn("seconds_each", F.lit(None).cast("double"))
    df = spark.read.schema(schema).option("header", True).option("enforceSchema", True).csv(path)
    return df.withColumn("seconds_each", F.round(F.try_divide("seconds", "items"), 1))


def render(template: dict, inputs: dict) -> tuple[str, str]:
    """(system, user) texts of a prompt template with its inputs; a missing required input is an error, unknown slots stay."""
    missing = [k for k in template.get("required_inputs") or [] if k not in inputs]
    if missing:
        raise ValueError(f"missing inputs: {', '.join(missing)}")
    fill = lambda t: re.sub(r"\{\{?\s*(\w+)\s*\}?\}", lambda m: str(inputs.get(m[1], m[0])), t or "")
    return fill(template.get("system")), fill(template.get("user"))


def markdown(rows: list[dict]) -> str:
    """A table of rows; nulls are empty."""
    if not rows:
        return ""
    head = list(rows[0])
    line = lambda cells: "| " + " | ".join("" if c is None else str(c) for c in cells) + " |"
    return "\n".join([line(head), "|" + "-|" * len(head), *(line(r.get(h) for h in head) for r in rows)])
