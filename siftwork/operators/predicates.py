"""Leaf conditions as columns, and the null rule of each.

N- drops rows whose value is null, N+ keeps them:

* N-: eq, lt, le, gt, ge, like, in, length-eq, -gt, -ge, contain-values, set-eq,
  between, not-between, every date range and its negation, eq-userid, eq-businessid,
  the hierarchy operators but not-under.
* N+: ne, not-like, not-in, length-ne, -lt, -le, not-contain-values, set-ne,
  ne-userid, ne-businessid, not-under.

Comparisons of two columns follow the same rules.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import dates
from ..functions.expr import UnsupportedPredicate, Value


def _either(null_kept: Column, a: Column) -> Column:
    return null_kept | a.isNull()


def _like(a: Column, before: str, v: str, after: str, escape: bool) -> Column:
    """Wildcards in ``v`` act as such unless ``escape``; plain text uses the faster forms.

    A backslash is a character like any other.
    """
    if escape or not set(v) & {"%", "_"}:
        return a.contains(v) if before and after else a.startswith(v) if after else a.endswith(v)
    return a.like(before + v.replace("\\", "\\\\") + after)


def _bounds(a: Column, b: dates.Bounds, low) -> Column:
    if b.period is not None:
        return low.part("fiscal-period", a) == b.period
    out = None
    for bound, column in ((b.low, None if b.low is None else (a > F.lit(b.low) if b.low_open else a >= F.lit(b.low))), (b.high, None if b.high is None else (a <= F.lit(b.high) if b.high_closed else a < F.lit(b.high)))):
        if bound is not None:
            out = column if out is None else out & column
    return out


def condition(op: str, a: Column, args: list, low) -> Column:
    """``args`` are columns or constants; ``low`` gives the context (see lowering)."""
    ctx = low.context
    if op in ("eq", "lt", "le", "gt", "ge"):
        v = args[0]
        return {"eq": a == v, "lt": a < v, "le": a <= v, "gt": a > v, "ge": a >= v}[op]
    if op == "ne":
        v = args[0]
        return ~a.eqNullSafe(v) if not isinstance(v, Column) else _either(a != v, a) | v.isNull()
    if op == "null":
        return a.isNull()
    if op == "not-null":
        return a.isNotNull()
    if op == "empty":
        return a.isNull() | (a == "")
    if op == "not-empty":
        return a.isNotNull() & (a != "")
    if op == "like":
        return _like(a, *args)
    if op == "not-like":
        return _either(~_like(a, *args), a)
    if op == "in":
        return a.isin(list(args))
    if op == "not-in":
        return _either(~a.isin(list(args)), a)
    if op.startswith("length-"):
        n, size = args[0], F.length(a)
        kind = op[7:]
        plain = {"eq": size == n, "ne": size != n, "lt": size < n, "le": size <= n, "gt": size > n, "ge": size >= n}[kind]
        return _either(plain, a) if kind in ("ne", "lt", "le") else plain
    if op in ("contain-values", "not-contain-values"):
        values = F.array(*map(F.lit, args))
        overlap = F.arrays_overlap(a, values)
        return overlap if op == "contain-values" else _either(~overlap, a)
    if op in ("set-eq", "set-ne"):
        same = F.array_sort(F.array_distinct(a)) == F.array(*map(F.lit, sorted(set(args))))
        return same if op == "set-eq" else _either(~same, a)
    if op == "between":
        return a.between(F.lit(args[0]), F.lit(args[1]))
    if op == "not-between":
        return (a < F.lit(args[0])) | (a > F.lit(args[1]))
    if op in ("range", "not-range"):
        name, *rest = args
        inside = _bounds(a, dates.RANGES[name](ctx.clock, *rest), low)
        return inside if op == "range" else ~inside
    if op in ("eq-userid", "ne-userid", "eq-businessid", "ne-businessid"):
        who = ctx.user_id if op.endswith("userid") else ctx.business_unit_id
        if who is None:
            raise UnsupportedPredicate(f"{op} needs a context that names who asks")
        return a == F.lit(who) if op.startswith("eq") else ~a.eqNullSafe(F.lit(who))
    raise UnsupportedPredicate(f"unknown condition {op}")


def is_value(v) -> bool:
    return isinstance(v, Value)
