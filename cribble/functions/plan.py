"""Small decisions on the driver: settings by precedence, date ranges, states of a run, throttles."""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from datetime import date


def effective(manual, by_group: dict, group: str, everywhere):
    """A setting by precedence: given by hand, set for the group, set for all."""
    return manual if manual is not None else by_group.get(group, everywhere)


def date_range_fault(lo: date, hi: date, today: date, future: bool = False) -> str | None:
    """Why a range of dates can't be used; null for a sound one."""
    if hi < lo:
        return "end before start"
    return "end in the future" if hi > today and not future else None


def new_run_id() -> str:
    """A name for a run; never part of a checked result."""
    return f"run-{uuid.uuid4().hex}"


def can_run(missing_keys: Iterable[str], query_counts: Iterable[tuple[int, int]]) -> bool:
    """Whether a run can start: no key is missing and some type has a query of either provider."""
    return not list(missing_keys) and any(a or b for a, b in query_counts)


def edited(queries: list[dict], query_id: int, text: str, new_id: int) -> list[dict]:
    """The queries after an edit: the original is rejected and stays, the new text is a query of its own under it."""
    old = next(q for q in queries if q["id"] == query_id)
    child = {**old, "id": new_id, "query_text": text, "status": "user_edited", "created_by": "user", "parent_query_id": query_id}
    return [{**q, "status": "rejected"} if q["id"] == query_id else q for q in queries] + [child]


def rejected(queries: list[dict], query_id: int) -> list[dict]:
    return [{**q, "status": "rejected"} if q["id"] == query_id else q for q in queries]


def reactivated(queries: list[dict], executions: list[dict], query_id: int) -> tuple[list[dict], list[dict]]:
    """A used query is generated again; what was executed for it is forgotten, so that it will really be searched."""
    return [{**q, "status": "generated"} if q["id"] == query_id else q for q in queries], [e for e in executions if e["query_id"] != query_id]


def added(queries: list[dict], new_id: int, lv2: str, kind: str, provider: str, text: str) -> list[dict]:
    """The queries with one that a person adds, unless it is there already."""
    key = (provider, lv2, kind, text)
    if any((q["provider"], q["taxonomy_lv2"], q["type_name"], q["query_text"]) == key for q in queries):
        return queries
    return [*queries, {"id": new_id, "taxonomy_lv2": lv2, "type_name": kind, "provider": provider, "query_text": text, "status": "user_created", "created_by": "user", "parent_query_id": None}]


class Throttle:
    """At least so many seconds between two calls of a key, and at most so many calls at a time, in one process.

    Fetches run in partitions, so a cluster's limit is that of a partition times their number: repartition by domain
    and all calls for a domain pass one throttle.
    """

    def __init__(self, seconds: float, most: int = 5, most_each: int = 2, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.seconds, self.clock, self.sleep = seconds, clock, sleep
        self.next: dict[str, float] = {}
        self.lock = threading.Lock()
        self.all = threading.BoundedSemaphore(most)
        self.most_each, self.each = most_each, {}

    def wait(self, key: str) -> float:
        """Waits for the key's turn; returns the seconds waited."""
        with self.lock:
            now = self.clock()
            turn = max(now, self.next.get(key, now))
            self.next[key] = turn + self.seconds
        if turn > now:
            self.sleep(turn - now)
        return turn - now

    def call(self, key: str, work: Callable):
        """Runs the work when neither all calls nor those of the key are too many."""
        with self.lock:
            own = self.each.setdefault(key, threading.BoundedSemaphore(self.most_each))
        with own, self.all:
            return work()


def guarded(events: Iterable[dict], attempt: Callable[[dict], dict], most: int = 5) -> Iterator[dict]:
    """Outcomes of attempts in order, up to a quota's end or the most-th unexpected error in a row.

    An attempt that raises is an outcome of its own (unexpected_error); one that says quota ends the run after it.
    """
    streak = 0
    for event in events:
        try:
            out = attempt(event)
        except Exception as e:  # noqa: BLE001
            out = {"status": "discarded", "reason": "unexpected_error", "detail": f"{type(e).__name__}: {e}"}
        yield out
        streak = streak + 1 if out.get("reason") == "unexpected_error" else 0
        if streak >= most or out.get("reason") == "quota":
            return


def experiment(groups: Iterable[str], steps: list[tuple[str, Callable[[str], object]]]) -> list[dict]:
    """One entry per group: completed, or the step that failed and how; a group's failure doesn't stop the others."""
    log = []
    for g in groups:
        entry: dict = {"lv2_id": g, "status": "completed"}
        for name, step in steps:
            try:
                entry[name] = step(g)
            except Exception as e:  # noqa: BLE001
                entry |= {"status": "failed", "step": name, "error": f"{type(e).__name__}: {e}"}
                break
        log.append(entry)
    return log


def migrated(columns: list[str], rename: dict[str, str], add: dict[str, object], drop: Iterable[str]) -> list[tuple]:
    """Steps that bring a table's columns up to date: ("rename", old, new), ("add", name, default), ("drop", name). Empty where nothing is due."""
    have, out = list(columns), []
    for old, new in rename.items():
        if old in have and new not in have:
            out.append(("rename", old, new))
            have[have.index(old)] = new
    for name, default in add.items():
        if name not in have:
            out.append(("add", name, default))
            have.append(name)
    return out + [("drop", name) for name in drop if name in have]
