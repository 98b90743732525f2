"""The ordered cascade of acceptance filters: the first failing one decides."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from cribble.functions.text import script_ratio
from cribble.functions.urls import is_blocked


def parsed_date(c: Column) -> Column:
    """A full ISO date, or null."""
    return F.when(c.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), c.try_cast("date"))


def in_dates(c: Column, lo: date, hi: date) -> Column:
    """True inside the range, ends included, and for unknown or malformed dates."""
    d = parsed_date(c)
    return d.isNull() | d.between(F.lit(lo), F.lit(hi))


def enough_script(title: Column, content: Column, least: float = 0.3, chars: str = "가-힣") -> Column:
    return F.coalesce(script_ratio(title, content, chars) >= least, F.lit(False))


def first_reason(*checks: tuple[str, Column]) -> Column:
    """The code of the first check that is false (or null), in order; null if all pass."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(code)) for code, ok in checks])


def executed(*checks: tuple[str, Column]) -> Column:
    """Map of the code of each check that ran to pass or fail; checks after the first failing one don't run."""
    told = [F.when(F.coalesce(ok, F.lit(False)), F.lit("pass")).otherwise(F.lit("fail")) for _, ok in checks]
    ran, entries = F.lit(True), []
    for (code, _), t in zip(checks, told):
        entries.append(F.when(ran, F.struct(F.lit(code).alias("key"), t.alias("value"))))
        ran = ran & (t == "pass")
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e.isNotNull()))


def _checks(lo: date, hi: date, blocked: list[str], least: float) -> tuple:
    return (
        ("blacklisted_domain", ~is_blocked(F.col("source_domain"), blocked)),
        ("date_out_of_range", in_dates(F.col("published_date"), lo, hi)),
        ("low_korea_relevance", enough_script(F.col("title"), F.col("content"), least)),
    )


def outcomes(lo: date, hi: date, blocked: list[str], least: float = 0.3) -> Column:
    return executed(*_checks(lo, hi, blocked, least))


def cascade(lo: date, hi: date, blocked: list[str], least: float = 0.3) -> Column:
    return first_reason(*_checks(lo, hi, blocked, least))


def fetch_reason(status: Column, error: Column) -> tuple[Column, Column]:
    """(reason, retryable) of a fetch: status code, and error 'timeout' or 'connection'. Both null where it went well."""
    again = (status >= 500) | (status == 429)
    reason = F.when(error == "timeout", "timeout").when(error == "connection", "temporary_http_error").when(status.isin(401, 403), "access_denied").when(status == 404, "not_found").when(again | (status >= 400), "temporary_http_error")
    return reason, F.when(reason.isNotNull(), error.isNotNull() | F.coalesce(again, F.lit(False)))
