"""From a query's steps to a DataFrame.

Entities are read with their columns renamed ``alias__column``, so Catalyst resolves
every reference, prunes what is unused and pushes bare-column predicates into the
scan. Steps apply in the order in which they were written.
"""

from __future__ import annotations

import itertools
from typing import Any

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.expr import Aggregate, Attr, ChildCount, Choice, Computed, Cond, EntityRef, Junction, KeyColumn, Part, Pred, Quantified, RowRef, UnsupportedPredicate, Value
from . import hierarchy, predicates

_numbers = itertools.count()


class UnsupportedQuery(ValueError):
    """A combination of steps that has no defined meaning."""


class Scope:
    """One query's names: which entity each alias stands for, or projected columns."""

    def __init__(self, catalog, root: str):
        self.catalog, self.root = catalog, root
        self.entities: dict[str, Any] = {}
        self.columns: dict[str, list[str]] = {}
        self.prefix: dict[str, str] = {}
        self.projected: list[str] | None = None
        #: Entities joined after a projection; their rows are named beside its columns.
        self.later: list[str] = []
        self.aggregates: list[Column] | None = None

    def ref(self) -> RowRef:
        if self.projected is None:
            return RowRef(self, self.root, tuple(self.columns))
        return RowRef(self, self.root, (self.root, *self.later) if self.later else ())


class Lowering:
    def __init__(self, catalog, scope: Scope, outer: Lowering | None = None):
        self.catalog, self.context, self.scope, self.outer = catalog, catalog.context, scope, outer
        self.spark = catalog.spark
        self.children: dict[str, str] = {}

    # ------------------------------------------------------------------ columns
    def column(self, v: Any) -> Column:
        if isinstance(v, Column):
            return v
        if isinstance(v, EntityRef):
            return self.struct(v)
        if isinstance(v, Attr):
            if v.scope is self.scope:
                return self.own(v)
            if self.outer is not None:
                return self.outer.column(v).outer()
            raise UnsupportedQuery(f"{v.alias}.{v.name} belongs to another query")
        if isinstance(v, KeyColumn):
            return v.column
        if isinstance(v, Part):
            return self.part(v.part, self.column(v.of))
        if isinstance(v, Computed):
            args = [self.column(a) for a in v.args]
            if callable(v.how):
                return v.how(*args)
            if v.how == "coalesce":
                return F.coalesce(*args)
            if v.how == "concat":
                return F.concat(*(F.coalesce(a.cast("string"), F.lit("")) for a in args))
            a, b = args
            return {"+": lambda: a + b, "-": lambda: a - b, "*": lambda: a * b, "/": lambda: a / b}[v.how]()
        if isinstance(v, Choice):
            return F.when(self.predicate(v.test), self.column(v.then)).otherwise(self.column(v.other))
        if isinstance(v, Aggregate):
            if self.scope.aggregates is None:
                raise UnsupportedQuery("an aggregate stands outside of a grouped projection")
            name = f"__agg{len(self.scope.aggregates)}"
            self.scope.aggregates.append(self.aggregate(v).alias(name))
            return F.col(name)
        if isinstance(v, ChildCount):
            if v.alias not in self.children:
                raise UnsupportedQuery("count_children stands outside of a projection")
            return F.coalesce(F.col(self.children[v.alias]), F.lit(0).cast("long"))
        if isinstance(v, Pred):
            return self.predicate(v)
        if isinstance(v, dict):
            return F.struct(*(self.column(x).alias(k) for k, x in v.items()))
        return F.lit(v)

    def own(self, a: Attr) -> Column:
        s = self.scope
        if s.projected is not None and a.alias not in s.later:
            if a.name not in s.projected:
                raise UnsupportedQuery(f"no column {a.name!r} after the projection")
            return F.col(f"`{a.name}`")
        if a.alias not in s.columns:
            raise UnsupportedQuery(f"no entity {a.alias!r} in this query")
        if a.name not in s.columns[a.alias]:
            raise UnsupportedQuery(f"{s.entities[a.alias].name} has no attribute {a.name!r}")
        return F.col(f"`{s.prefix[a.alias]}__{a.name}`")

    def struct(self, e: EntityRef) -> Column:
        names, prefix = self.scope.columns[e.alias], self.scope.prefix[e.alias]
        whole = F.struct(*(F.col(f"`{prefix}__{n}`").alias(n) for n in names))
        return F.when(F.col(f"{prefix}____there").isNotNull(), whole)

    def part(self, part: str, a: Column) -> Column:
        c = self.context.clock
        if part in ("fiscal-period", "fiscal-year"):
            since = F.pmod(F.month(a) - c.fiscal_month, F.lit(12))
            if part == "fiscal-period":
                return (F.floor(since / c.period_months) + 1).cast("int")
            return F.year(a) - F.when(F.month(a) < c.fiscal_month, 1).otherwise(0)
        return {"year": F.year, "month": F.month, "day": F.dayofmonth, "week": F.weekofyear, "quarter": F.quarter}[part](a)

    def aggregate(self, v: Aggregate) -> Column:
        if v.func == "count":
            return F.count(F.lit(1))
        a = self.column(v.of)
        if v.func == "count-column":
            return F.count_distinct(a) if v.distinct else F.count(a)
        return {"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}[v.func](a)

    # --------------------------------------------------------------- predicates
    def predicate(self, p: Pred) -> Column:
        if isinstance(p, Junction):
            out = [self.predicate(x) for x in p.parts]
            return out[0] & out[1] if p.kind == "and" else out[0] | out[1]
        if isinstance(p, Quantified):
            return self.quantified(p)
        if not isinstance(p, Cond):
            raise UnsupportedPredicate(f"not a condition: {p!r}")
        if isinstance(p.target, EntityRef):
            there = F.col(f"{self.scope.prefix[p.target.alias]}____there")
            return there.isNull() if p.op == "null" else there.isNotNull()
        a = self.column(p.target)
        if p.op in ("above", "eq-or-above", "under", "eq-or-under", "not-under"):
            return self.in_hierarchy(p, a)
        if p.op.startswith("eq-useroruserhierarchy"):
            c = self.context
            if c.users is None or p.op.endswith("teams") and c.teams is None:
                raise UnsupportedPredicate(f"{p.op} needs the context's users and teams")
            ids = hierarchy.reports(c.users(self.spark), c.user_id, c.teams(self.spark) if p.op.endswith("teams") else None)
            return a.isin(ids)
        return predicates.condition(p.op, a, [self.column(x) if isinstance(x, Value) else x for x in p.args], self)

    def in_hierarchy(self, p: Cond, a: Column) -> Column:
        if not isinstance(p.target, Attr) or p.target.alias not in self.scope.entities:
            raise UnsupportedPredicate("hierarchy conditions apply to an entity's own id")
        e = self.scope.entities[p.target.alias]
        if not e.parent or p.target.name != e.primary_id:
            raise UnsupportedPredicate(f"{e.name} has no hierarchy on {p.target.name}")
        table, (v,) = self.catalog.table(e.name), p.args
        walk = hierarchy.above if "above" in p.op else hierarchy.below
        ids = walk(table, e.primary_id, e.parent, v, p.op.startswith("eq-or"))
        # An equality, so that a hash join does it; of a null id neither holds true.
        found = ids.where(F.col("id") == a.outer()).exists()
        return ~found if p.op == "not-under" else found

    def quantified(self, q: Quantified) -> Column:
        """any, exists and in are EXISTS; all also demands a child and none that fails."""
        parts = _conjuncts(q.pred)
        link = [p for p in parts if _mentions(p, self.scope)]
        rest = [p for p in parts if not _mentions(p, self.scope)]
        if not link:
            raise UnsupportedPredicate(f"{q.kind} needs a condition that compares a column of each query")

        def there(conditions) -> Column:
            df, inner = q.source._lower(q.scope.catalog, q.scope, outer=self)
            for c in conditions:
                df = df.where(inner.predicate(c))
            return df.select(F.lit(1)).exists()

        if q.kind == "all":
            failing = _all(rest).negated() if rest else None
            fails = there([*link, failing]) if failing is not None else F.lit(False)
            return fails if q.negative else there(link) & ~fails
        found = there(parts)
        return ~found if q.negative else found


def _conjuncts(p: Pred) -> list[Pred]:
    return [x for part in p.parts for x in _conjuncts(part)] if isinstance(p, Junction) and p.kind == "and" else [p]


def _all(parts: list[Pred]) -> Pred:
    out = parts[0]
    for p in parts[1:]:
        out = out & p
    return out


def _mentions(x: Any, scope: Scope) -> bool:
    if isinstance(x, Attr):
        return x.scope is scope
    if isinstance(x, Cond):
        return any(_mentions(y, scope) for y in (x.target, *x.args))
    if isinstance(x, (Junction, Computed)):
        return any(_mentions(y, scope) for y in (x.parts if isinstance(x, Junction) else x.args))
    if isinstance(x, Part):
        return _mentions(x.of, scope)
    return False


def read(catalog, scope: Scope, name: str, alias: str, columns: tuple, retained: bool) -> DataFrame:
    """An entity's rows with columns renamed and a marker that a row is there."""
    e, df = catalog.entity(name), catalog.table(name, retained)
    keep = [c for c in df.columns if not columns or c in columns or c == e.primary_id]
    for c in columns:
        if c not in df.columns:
            raise UnsupportedQuery(f"{name} has no attribute {c!r}")
    prefix = f"{alias}{next(_numbers)}"
    scope.entities[alias], scope.columns[alias], scope.prefix[alias] = e, keep, prefix
    return df.select(*(F.col(f"`{c}`").alias(f"{prefix}__{c}") for c in keep), F.lit(True).alias(f"{prefix}____there"))


def first_rows(df: DataFrame, key: Column, orders: list[Column]) -> DataFrame:
    """One row per key: the first by ``orders``, ties broken by all columns."""
    ties = [F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]
    w = Window.partitionBy(key).orderBy(*orders, *ties)
    return df.withColumn("__first", F.row_number().over(w)).where("__first = 1").drop("__first")
