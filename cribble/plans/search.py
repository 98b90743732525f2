"""Planning and driving searches: lanes, budgets, caps. Lanes are few (types times providers), so this runs on the driver."""

from __future__ import annotations

import hashlib
import json
import math
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, field


def bundles(domains: list[str], aliases: dict[str, list[str]], most: int = 3) -> list[list[str]]:
    """Circular windows over the domains, aliases always together; a window may pass most only by its first unit."""
    head = {d: k for k, v in aliases.items() for d in (k, *v)}
    units: dict[str, list[str]] = {}
    for d in dict.fromkeys(domains):
        units.setdefault(head.get(d, d), []).append(d)
    rows = list(units.values())
    if sum(map(len, rows)) <= most:
        return [[d for u in rows for d in u]] if rows else []
    out: list[list[str]] = []
    for i in range(len(rows)):
        window = list(rows[i])
        for u in (rows[(i + k) % len(rows)] for k in range(1, len(rows))):
            if len(window) + len(u) > most:
                break
            window += u
        if window not in out:
            out.append(window)
    return out


def fingerprint(**request) -> str:
    """A digest of a request, whatever the order of its parts."""
    return hashlib.sha256(json.dumps(request, sort_keys=True, ensure_ascii=False, default=str).encode()).hexdigest()


@dataclass
class Lane:
    """The searches of one type at one provider."""

    lv2: str
    type: str
    provider: str
    target: int
    queries: list[tuple[int, str]]
    found: int = 0
    calls: int = 0
    page: int = 0
    now: tuple[int, str] | None = None
    urls: set = field(default_factory=set)

    @property
    def key(self) -> tuple[str, str]:
        return self.lv2, self.type


def plan_lanes(targets: list[tuple[str, str]], queries: dict, total: int, ratio: Callable, multiplier: Callable, allowed: Callable) -> tuple[list[Lane], list[str]]:
    """Lanes with queries, and warnings. queries: (lv2, type, provider) -> [(id, text)] best first.

    A group's total is shared by its types, rounded up, then split by ratio(lv2) per cent of the first provider
    (rounded half to even); a type without allowed domains goes to the first provider whole. Shares are scaled by
    multiplier(lv2, type, provider) and rounded up.
    """
    per, lanes, notes = Counter(g for g, _ in targets), [], []
    for g, t in targets:
        share = math.ceil(total / per[g])
        first = round(share * ratio(g) / 100) if allowed(g, t) else share
        if not allowed(g, t):
            notes.append(f"{g}::{t}: no allowed domain, all {share} go to tavily")
        for p, n in (("tavily", first), ("serpapi", share - first)):
            if n <= 0:
                continue
            if not (q := queries.get((g, t, p))):
                notes.append(f"{g}::{t} ({p}): no query")
                continue
            lanes.append(Lane(g, t, p, math.ceil(n * multiplier(g, t, p)), list(q)))
    return lanes, notes


def budgets(lanes: list[Lane], page_size: dict[str, int], factor: float = 2.0) -> dict:
    """Calls that all types of a group share at a provider: pages for the targets (at least one) times factor; tavily gets a call for each lane at least."""
    want, count = Counter(), Counter()
    for x in lanes:
        want[x.lv2, x.provider] += x.target
        count[x.lv2, x.provider] += 1
    out = {k: max(1, math.ceil(v / page_size[k[1]])) * factor for k, v in want.items()}
    return {k: max(v, count[k]) if k[1] == "tavily" else v for k, v in out.items()}


def drive(lanes: list[Lane], search: Callable, stored: Callable, cache: dict, page_size: dict[str, int], most_pages: int = 1, caps: dict | None = None, type_cap: int | None = None, robin: bool = False) -> tuple[list[dict], list[str]]:
    """Runs lanes until targets, queries or budgets are used up; returns candidates and warnings.

    search(lane, text, start) returns rows with url, rank and score; stored(url) tells known addresses; cache maps
    request digests to result counts, and a request in it isn't made again, though its count still goes to the
    lane's progress. Types not yet tried come first, then the type with the largest deficit, fewer calls, and the
    lane with the larger gap and fewer calls; with robin, lanes take turns instead. An error stops its provider only.
    """
    goal, type_calls, used, group = Counter(), Counter(), Counter(), Counter()
    limit, dead, notes, out = budgets(lanes, page_size), set(), [], []
    for x in lanes:
        goal[x.key] += x.target

    def got(key):
        return sum(x.found for x in lanes if x.key == key)

    def stopped(x: Lane) -> str | None:
        if x.provider in dead or used[x.provider] >= (caps or {}).get(x.provider, math.inf):
            return f"{x.provider}: no further calls"
        if group[x.lv2, x.provider] >= limit[x.lv2, x.provider]:
            return f"{x.lv2} ({x.provider}): budget of {limit[x.lv2, x.provider]:g} calls used"
        if type_cap is not None and type_calls[x.key] >= type_cap:
            return f"{x.lv2}::{x.type}: {type_cap} calls used"
        return None

    while True:
        open_ = []
        for x in lanes:
            if (x.queries or x.now) and got(x.key) < goal[x.key]:
                if why := stopped(x):
                    if why not in notes:
                        notes.append(why)
                else:
                    open_.append(x)
        if not open_:
            return out, notes
        x = min(open_, key=lambda y: y.calls) if robin else min([y for y in open_ if not type_calls[y.key]] or open_, key=lambda y: (-(goal[y.key] - got(y.key)), type_calls[y.key], -(y.target - y.found), y.calls))
        x.calls += 1
        type_calls[x.key] += 1
        x.now = x.now or x.queries.pop(0)
        mark = fingerprint(provider=x.provider, text=x.now[1], lv2=x.lv2, type=x.type, start=x.page)
        if mark in cache:
            n = cache[mark]
            x.found += n
        else:
            try:
                rows = search(x, x.now[1], x.page)
            except Exception as e:  # noqa: BLE001
                dead.add(x.provider)
                notes.append(f"{x.provider}: {type(e).__name__}: {e}")
                continue
            used[x.provider] += 1
            group[x.lv2, x.provider] += 1
            cache[mark] = n = len(rows)
            for r in rows:
                out.append({"lv2": x.lv2, "type": x.type, "provider": x.provider, "query_id": x.now[0], **r})
                if r["url"] not in x.urls:
                    x.urls.add(r["url"])
                    x.found += not stored(r["url"])
        if x.provider == "serpapi" and n >= page_size["serpapi"] and x.found < x.target and x.page // page_size["serpapi"] + 1 < most_pages:
            x.page += page_size["serpapi"]
        else:
            x.now, x.page = None, 0
