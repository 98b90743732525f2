"""Address functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from cribble.functions.text import strip

# Query parameters that only track where a click came from.
TRACKING = (
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "gclid", "fbclid", "igshid", "ref", "referrer",
)


def _quoted(x: Column) -> Column:
    """Form encoding that keeps ``~`` and codes ``*``."""
    x = F.replace(F.url_encode(x), F.lit("%7E"), F.lit("~"))
    return F.replace(x, F.lit("*"), F.lit("%2A"))


def _unquoted(x: Column) -> Column:
    """Form decoding; an escape that is none stays as written."""
    safe = F.regexp_replace(x, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(safe), F.replace(x, F.lit("+"), F.lit(" ")))


def _unescaped(q: Column) -> Column:
    """Script escapes (backslash, u, four hex digits) left in a query become their characters."""
    q = F.regexp_replace(q, r"(?i)%5cu003d([^&#=]+)=?(?=&|#|\z)", "=$1")
    q = F.regexp_replace(q, r"(?i)%5cu(?=[0-9a-f]{4})", r"\\u")
    parts = F.split(q, r"(?=\\u[0-9a-fA-F]{4})")

    def one(p: Column) -> Column:
        code = F.conv(F.substring(p, 3, 4), 16, 10).cast("int")
        char = F.decode(F.unhex(F.lpad(F.hex(code), 4, "0")), "UTF-16BE")
        return F.when(p.rlike(r"\A\\u(?![dD][89a-fA-F])[0-9a-fA-F]{4}"), F.concat(char, F.substring(p, F.lit(7), F.length(p)))).otherwise(p)

    return F.when(q.contains("\\u"), F.array_join(F.transform(parts, one), "")).otherwise(q)


def normalize_url(url: Column) -> Column:
    """Lower-case scheme and host, no fragment, no tracking parameters, the rest of the query sorted, no final slash.

    Script escapes are repaired after the first ``?`` only. Null stays null.
    """
    u = F.regexp_replace(strip(url), r"[\t\r\n]", "")
    at = F.instr(u, "?")
    u = F.when(at > 0, F.concat(F.substring(u, F.lit(1), at), _unescaped(F.substring(u, at + 1, F.length(u))))).otherwise(u)
    u = F.regexp_replace(u, r"(?s)#.*\z", "")
    head = F.regexp_replace(u, r"(?s)\?.*\z", "")
    at = F.instr(u, "?")
    query = F.when(at > 0, F.substring(u, at + 1, F.length(u))).otherwise(F.lit(""))
    root = F.regexp_extract(head, r"\A([A-Za-z][A-Za-z0-9+.\-]*:)?(//[^/]*)?", 0)
    path = F.regexp_replace(F.substring(head, F.length(root) + 1, F.length(head)), r"/+\z", "")
    path = F.when(path == "", F.lit("/")).otherwise(path)

    def pair(p: Column) -> Column:
        eq = F.instr(p, "=")
        key = F.when(eq > 0, F.substring(p, F.lit(1), eq - 1)).otherwise(p)
        value = F.when(eq > 0, F.substring(p, eq + 1, F.length(p))).otherwise(F.lit(""))
        return F.struct(_unquoted(key).alias("k"), _unquoted(value).alias("v"))

    pairs = F.transform(F.filter(F.split(query, "&"), lambda p: p != ""), pair)
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(*TRACKING)))
    query = F.array_join(F.transform(kept, lambda p: F.concat(_quoted(p["k"]), F.lit("="), _quoted(p["v"]))), "&")
    return F.concat(F.lower(root), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def authority(url: Column) -> Column:
    """What stands between ``//`` and the path, with port and user."""
    return F.regexp_extract(url, r"\A(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def host_key(host: Column) -> Column:
    """Host in lower case, without what follows a colon and without trailing dots."""
    return F.regexp_replace(F.regexp_replace(F.lower(host), r"(?s):.*\z", ""), r"\.+\z", "")


def is_homepage(url: Column) -> Column:
    """True for a normalised address with path ``/`` and no query."""
    return url.rlike(r"\A[a-z][a-z0-9+.\-]*://[^/?#]*/\z")


def is_blocked(host: Column, blocked: list[str]) -> Column:
    """True if the host is a listed domain or lies under one."""
    h = host_key(host)
    return F.exists(F.array(*map(F.lit, blocked)).cast("array<string>"), lambda b: (h == b) | F.endswith(h, F.concat(F.lit("."), b)))
