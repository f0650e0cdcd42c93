"""From rows to results: hooks, result types, plan listeners and cancellation."""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Callable
from typing import Any

#: Called with (query, plan) before anything runs.
plan_listeners: list[Callable] = []
#: Called with every raw row, before and after a query's own hooks.
before_materialise: list[Callable] = []
after_materialise: list[Callable] = []


class Cancelled(RuntimeError):
    """The token was cancelled before or while the query ran."""


class CancelToken:
    """Cancels the Spark jobs of the calls that it was passed to."""

    def __init__(self):
        self.tag, self.cancelled, self._sessions = f"siftwork-{uuid.uuid4().hex}", False, []

    def cancel(self) -> None:
        self.cancelled = True
        for s in self._sessions:
            s.interruptTag(self.tag)


def cancellable(spark, token: CancelToken | None, f: Callable) -> Any:
    if token is None:
        return f()
    if token.cancelled:
        raise Cancelled("the token is cancelled")
    token._sessions.append(spark)
    spark.addTag(token.tag)
    try:
        out = f()
    except Exception as e:
        if token.cancelled:
            raise Cancelled("the query was cancelled") from e
        raise
    finally:
        spark.removeTag(token.tag)
    if token.cancelled:
        raise Cancelled("the query was cancelled")
    return out


class PlanOnly(Exception):
    """Carries a terminal's plan out of a query that isn't to run."""

    def __init__(self, plan: str):
        super().__init__(plan)
        self.plan = plan


def announce(query, top: int | None = None, aggregate: tuple | None = None) -> None:
    """Tell the query's captures and the listeners the request's plan, before it runs.

    ``top`` is the number of rows that a terminal asks for, ``aggregate`` a scalar
    aggregate and its selector.
    """
    if query.captures or plan_listeners or query.plan_only:
        from ..functions.xmlplan import to_xml

        plan = to_xml(query, top, aggregate)
        if query.plan_only:
            raise PlanOnly(plan)
        for f in query.captures:
            f(plan)
        for f in plan_listeners:
            f(query, plan)


def _shape(row: Any, kind: Any) -> Any:
    if kind is None:
        return row[0] if len(row) == 1 and kind is not None else row
    if dataclasses.is_dataclass(kind):
        names = [f.name for f in dataclasses.fields(kind)]
        return kind(**{n: row[n] for n in names})
    return kind(*row)


def materialise(query, row: Any) -> Any:
    """Hooks in order: global before, the query's before, the result type, then after.

    A hook that returns None leaves its input unchanged.
    """
    for f in (*before_materialise, *query.before):
        row = row if (new := f(row)) is None else new
    out = _shape(row, query.result_type)
    for f in (*after_materialise, *query.after):
        out = out if (new := f(row, out)) is None else new
    return out
