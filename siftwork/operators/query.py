"""The immutable query builder."""

from __future__ import annotations

import asyncio
from collections.abc import Callable
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.expr import Aggregate, Attr, ChildCount, Choice, Computed, EntityRef, KeyColumn, Pred, Quantified, Value
from . import decode
from .lowering import Lowering, Scope, UnsupportedQuery, first_rows, read

DEFAULT_PAGE_SIZE = 5000
RECORD_COUNT_LIMIT = 50_000
HINTS = {"HashJoin": "shuffle_hash", "MergeJoin": "merge", "LoopJoin": "broadcast"}
#: Estimated bytes up to which the broadcast hint is passed on; beyond it Spark chooses.
BROADCAST_BYTES = 64 << 20
#: Hints without a counterpart here; accepted and noted in the plan.
NEUTRAL_HINTS = ("ForceOrder", "DisableRowGoal", "EnableOptimizerHotfixes", "NoPerformanceSpool", "EnableHistAmendmentForAscKeys")


class EmptySequence(LookupError):
    """An element was asked for where there is none."""


class MoreThanOne(LookupError):
    """One element was asked for where there are several."""


@dataclass(frozen=True)
class RecordCount:
    total: int
    limit_exceeded: bool


def _estimate(df: DataFrame) -> int:
    """Catalyst's upper estimate of a plan's bytes."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


class Group:
    """What a grouped projection sees: the key and the aggregates of the group."""

    def __init__(self, key: Any, row: Any):
        self.key, self._row = key, row

    def _of(self, f) -> Any:
        return f(self._row) if callable(f) else f

    def count(self) -> Aggregate:
        return Aggregate("count")

    long_count = count

    def sum(self, f):
        return Aggregate("sum", self._of(f))

    def average(self, f):
        return Aggregate("avg", self._of(f))

    def min(self, f):
        return Aggregate("min", self._of(f))

    def max(self, f):
        return Aggregate("max", self._of(f))

    def count_column(self, f):
        return Aggregate("count-column", self._of(f))

    def count_distinct(self, f):
        return Aggregate("count-column", self._of(f), True)


def _find_children(x: Any, out: set) -> set:
    if isinstance(x, ChildCount):
        out.add(x.alias)
    elif isinstance(x, dict):
        for y in x.values():
            _find_children(y, out)
    elif isinstance(x, (Computed,)):
        for y in x.args:
            _find_children(y, out)
    elif isinstance(x, Choice):
        for y in (x.then, x.other):
            _find_children(y, out)
    return out


@dataclass(frozen=True)
class Query:
    """A query over a catalog's entities; every method returns a new one."""

    catalog: Any
    name: str
    alias: str
    columns: tuple = ()
    steps: tuple = ()
    retained: bool = False
    hints: tuple = ()
    raw_order: bool = False
    page_size: int | None = None
    page_number: int | None = None
    aggregate_limit: int | None = None
    on_count: Callable | None = None
    before: tuple = ()
    after: tuple = ()
    captures: tuple = ()
    result_type: Any = None
    options: tuple = ()
    plan_only: bool = False

    @staticmethod
    def of(catalog, name: str, columns: tuple, alias: str | None) -> Query:
        catalog.entity(name)
        return Query(catalog, name, alias or name, tuple(columns))

    def _step(self, *step) -> Query:
        return replace(self, steps=(*self.steps, step))

    # ------------------------------------------------------------ building
    def where(self, f: Callable[[Any], Pred]) -> Query:
        return self._step("where", f)

    def select(self, f: Callable[[Any], Any], as_type: Any = None) -> Query:
        """Project: a dict of names and values (dicts nest), a whole row, or one value."""
        return replace(self._step("select", f), result_type=as_type or self.result_type)

    def join(self, inner: Query, outer_key: Callable, inner_key: Callable, alias: str | None = None) -> Query:
        return self._step("join", "inner", inner, outer_key, inner_key, alias or inner.alias)

    def left_join(self, inner: Query, outer_key: Callable, inner_key: Callable, alias: str | None = None) -> Query:
        return self._step("join", "left", inner, outer_key, inner_key, alias or inner.alias)

    def first_row(self, inner: Query, outer_key: Callable, inner_key: Callable, alias: str | None = None) -> Query:
        """Inner join with one row per key: the first in the inner query's order."""
        return self._step("join", "first", inner, outer_key, inner_key, alias or inner.alias)

    def left_first_row(self, inner: Query, outer_key: Callable, inner_key: Callable, alias: str | None = None) -> Query:
        return self._step("join", "left-first", inner, outer_key, inner_key, alias or inner.alias)

    def group_by(self, key: Callable[[Any], Any]) -> Query:
        """Group by a value, a dict of values, or a constant; ``select`` must follow."""
        return self._step("group", key)

    def order_by(self, f: Callable, descending: bool = False) -> Query:
        return self._step("order", f, descending)

    def order_by_descending(self, f: Callable) -> Query:
        return self.order_by(f, True)

    then_by, then_by_descending = order_by, order_by_descending

    def distinct(self) -> Query:
        return self._step("distinct")

    def take(self, n: int) -> Query:
        if n < 0:
            raise ValueError("take needs a number of rows")
        return self._step("take", n)

    # ------------------------------------------- conditions over other queries
    def _quantified(self, kind: str, f: Callable | None) -> Quantified:
        scope = Scope(self.catalog, self.alias)
        self._names(scope)
        return Quantified(kind, self, scope, f(scope.ref()))

    def any(self, f):
        return self._quantified("any", f)

    def all(self, f):
        return self._quantified("all", f)

    def exists(self, f):
        return self._quantified("exists", f)

    def contains_key(self, f):
        """The IN form of ``exists``; the same rows."""
        return self._quantified("in", f)

    def _names(self, scope: Scope) -> None:
        """Fill a scope's names without reading rows, for a correlated condition."""
        read(self.catalog, scope, self.name, self.alias, self.columns, self.retained)
        for step in self.steps:
            if step[0] == "join":
                inner, alias = step[2], step[5]
                read(inner.catalog, scope, inner.name, alias, inner.columns, inner.retained)

    # ------------------------------------------------------------ options
    def with_datasource(self, name: str) -> Query:
        if name not in ("live", "retained"):
            raise ValueError("a datasource is live or retained")
        return replace(self, retained=name == "retained")

    def with_page_size(self, n: int) -> Query:
        if n < 1:
            raise ValueError("a page has one row at least")
        return replace(self, page_size=n)

    def with_page(self, k: int) -> Query:
        if k < 1:
            raise ValueError("pages count from 1")
        return replace(self, page_number=k)

    def with_aggregate_limit(self, n: int) -> Query:
        if not 1 <= n <= 50_000:
            raise ValueError("an aggregate limit lies between 1 and 50000")
        return replace(self, aggregate_limit=n)

    def with_raw_order(self) -> Query:
        """Choice columns sort by number, not by label."""
        return replace(self, raw_order=True)

    def with_query_hints(self, *names: str) -> Query:
        for n in names:
            if n not in HINTS and n not in NEUTRAL_HINTS:
                raise ValueError(f"unknown hint {n!r}")
        return replace(self, hints=(*self.hints, *names))

    def with_late_materialise(self) -> Query:
        return replace(self, options=(*self.options, "latematerialize"))

    def with_no_lock(self) -> Query:
        return replace(self, options=(*self.options, "no-lock"))

    def return_record_count(self, f: Callable[[RecordCount], Any]) -> Query:
        return replace(self, on_count=f)

    def on_before_materialise(self, f: Callable) -> Query:
        return replace(self, before=(*self.before, f))

    def on_after_materialise(self, f: Callable) -> Query:
        return replace(self, after=(*self.after, f))

    def capture_plan(self, f: Callable[[str], Any]) -> Query:
        return replace(self, captures=(*self.captures, f))

    # ------------------------------------------------------------ lowering
    def _lower(self, catalog, scope: Scope | None = None, outer=None, ordered: list | None = None):
        scope = scope or Scope(catalog, self.alias)
        scope.entities, scope.columns, scope.prefix = {}, {}, {}
        df = read(catalog, scope, self.name, self.alias, self.columns, self.retained)
        low = Lowering(catalog, scope, outer)
        orders: list = []
        group = None
        hidden = 0

        def key_column(v: Any):
            c = low.column(v)
            if isinstance(v, Attr) and not self.raw_order and v.alias in scope.entities and scope.projected is None:
                labels = scope.entities[v.alias].choices.get(v.name)
                if labels:
                    c = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))[c]
            return c

        def sort(df):
            return df.orderBy(*(c.desc() if d else c.asc() for c, d in orders)) if orders else df

        def hide(df):
            nonlocal hidden, orders
            out = []
            for c, d in orders:
                df, hidden = df.withColumn(f"__o{hidden}", c), hidden + 1
                out.append((F.col(f"__o{hidden - 1}"), d))
            orders = out
            return df

        kept = lambda: [c.strip("`") for c in (f"__o{i}" for i in range(hidden))]
        for step in self.steps:
            if group is not None and step[0] not in ("select", "order"):
                raise UnsupportedQuery(f"{step[0]} can't stand between group_by and its select")
            if step[0] == "where":
                df = df.where(low.predicate(step[1](scope.ref())))
            elif step[0] == "join":
                df = self._join(df, low, scope, orders, *step[1:])
            elif step[0] == "order":
                if group is not None:
                    group[1].append((step[1], step[2]))
                else:
                    orders.append((key_column(step[1](scope.ref())), step[2]))
            elif step[0] == "group":
                orders.clear()
                group = (step[1](scope.ref()), [])
            elif step[0] == "select" and group is not None:
                df, orders = self._grouped(df, low, scope, group, step[1])
                hidden, group = len(orders), None
            elif step[0] == "select":
                shape = step[1](scope.ref())
                for alias in sorted(_find_children(shape, set())):
                    e = scope.entities[alias]
                    if not e.parent:
                        raise UnsupportedQuery(f"{e.name} has no hierarchy")
                    from . import hierarchy

                    n = f"__children_{alias}"
                    counts = hierarchy.child_counts(catalog.table(e.name), e.parent).toDF(f"{n}_id", n)
                    df = df.join(counts, low.own(Attr(scope, alias, e.primary_id)) == F.col(f"{n}_id"), "left")
                    low.children[alias] = n
                if not isinstance(shape, dict):
                    name = shape.name if isinstance(shape, Attr) else shape.alias if isinstance(shape, EntityRef) else "value"
                    shape = {name: shape}
                df = hide(df) if orders else df
                df = df.select(*(low.column(v).alias(k) for k, v in shape.items()), *(F.col(c) for c in kept()))
                scope.projected, scope.later = list(shape), []
            elif step[0] == "distinct":
                if hidden:
                    names = scope.projected
                    orders, hidden = [], 0
                    df = df.select(*(F.col(f"`{c}`") for c in names), *(F.col(f"`{c}`") for c in df.columns if any(c.startswith(f"{scope.prefix[a]}__") for a in scope.later)))
                df = df.distinct()
            elif step[0] == "take":
                df = sort(df).limit(step[1])
        if group is not None:
            raise UnsupportedQuery("group_by needs a select")
        if ordered is not None:
            ordered.extend(orders)
        elif orders:
            df = sort(df)
        scope.hidden = kept()
        return df, low

    def _join(self, df, low, scope, orders, kind, inner, outer_key, inner_key, alias):
        other = Scope(inner.catalog, inner.alias)
        picks: list = []
        right, right_low = inner._lower(inner.catalog, other, ordered=picks)
        if other.projected is not None or len(other.columns) > 1:
            raise UnsupportedQuery("a join takes an entity, which may be filtered and ordered")
        if alias in scope.columns:
            raise UnsupportedQuery(f"two entities are named {alias!r}")
        rk = right_low.column(inner_key(other.ref()))
        if kind.endswith("first"):
            right = first_rows(right, rk, [c.desc() if d else c.asc() for c, d in picks])
        for h in self.hints:
            if h in HINTS and (HINTS[h] != "broadcast" or _estimate(right) <= BROADCAST_BYTES):
                right = right.hint(HINTS[h])
        lk = low.column(outer_key(scope.ref()))
        e, prefix = other.entities[inner.alias], other.prefix[inner.alias]
        scope.entities[alias], scope.columns[alias], scope.prefix[alias] = e, other.columns[inner.alias], prefix
        if scope.projected is not None:
            scope.later.append(alias)
        # The inner query's order, its first key first, follows the outer one's.
        orders.extend(picks)
        return df.join(right, lk == rk, "left" if kind.startswith("left") else "inner")

    def _grouped(self, df, low, scope, group, f):
        key, order_fs = group
        if self.aggregate_limit is not None and df.limit(self.aggregate_limit + 1).count() > self.aggregate_limit:
            raise OverflowError(f"more than {self.aggregate_limit} rows would be aggregated")
        scope.aggregates = []
        g_row = scope.ref()
        if isinstance(key, dict):
            keys = {k: low.column(v).alias(f"__key_{k}") for k, v in key.items()}
            seen = _Keys({k: F.col(f"__key_{k}") for k in key})
        elif isinstance(key, (Value, EntityRef)):
            keys, seen = {"": low.column(key).alias("__key")}, KeyColumn(F.col("__key"))
        else:
            keys, seen = {}, key
        g = Group(seen, g_row)
        shape = f(g)
        if not isinstance(shape, dict):
            shape = {"value": shape}
        final = [low.column(v).alias(k) for k, v in shape.items()]
        ordering = [(low.column(o(g)), d) for o, d in order_fs]
        aggs = scope.aggregates or [F.count(F.lit(1)).alias("__agg_none")]
        grouped = df.groupBy(*keys.values()).agg(*aggs) if keys else df.agg(*aggs)
        out = grouped.select(*final, *(c.alias(f"__o{i}") for i, (c, _) in enumerate(ordering)))
        scope.aggregates, scope.projected, scope.later = None, list(shape), []
        return out, [(F.col(f"__o{i}"), d) for i, (_, d) in enumerate(ordering)]

    def to_df(self) -> DataFrame:
        """The query as a lazy DataFrame; a page, if one is set."""
        ordered: list = []
        df, low = self._lower(self.catalog, ordered=ordered)
        names = low.scope.projected
        if self.page_number is not None:
            size = self.page_size or DEFAULT_PAGE_SIZE
            ties = [F.col(f"`{c}`") for c, t in df.dtypes if not t.startswith("map")]
            df = df.orderBy(*(c.desc() if d else c.asc() for c, d in ordered), *ties).offset((self.page_number - 1) * size).limit(size)
        elif ordered:
            df = df.orderBy(*(c.desc() if d else c.asc() for c, d in ordered))
        s = low.scope
        if names is not None:
            return df.select(*(F.col(f"`{c}`") for c in names), *(low.struct(EntityRef(s, a)).alias(a) for a in s.later))
        if len(s.columns) == 1:
            prefix = s.prefix[self.alias]
            return df.select(*(F.col(f"`{prefix}__{c}`").alias(c) for c in s.columns[self.alias]))
        return df.select(*(low.struct(EntityRef(s, a)).alias(a) for a in s.columns))

    # ------------------------------------------------------------ inspection
    def to_xml(self, terminal: Callable[[Query], Any] | None = None) -> str:
        """The plan as text: the query's, or that of ``terminal`` (say ``lambda q: q.count()``), which doesn't run."""
        if terminal is None:
            from ..functions.xmlplan import to_xml

            return to_xml(self)
        try:
            terminal(replace(self, plan_only=True))
        except decode.PlanOnly as e:
            return e.plan
        raise ValueError("the function called no terminal of the query")

    def explain(self, mode: str = "formatted") -> None:
        self.to_df().explain(mode)

    def _announce(self, top: int | None = None, aggregate: tuple | None = None) -> None:
        decode.announce(self, top, aggregate)

    # ------------------------------------------------------------ terminals
    def to_list(self) -> list:
        """All rows, in memory of the driver; ``for_each_page`` bounds it."""
        self._announce()
        df = self.to_df()
        self._count_records()
        return [decode.materialise(self, r) for r in df.toLocalIterator(prefetchPartitions=True)]

    def _count_records(self) -> None:
        if self.on_count is not None:
            total = replace(self, page_number=None, page_size=None).to_df().count()
            self.on_count(RecordCount(min(total, RECORD_COUNT_LIMIT), total > RECORD_COUNT_LIMIT))

    def for_each_page(self, f: Callable[[list], Any]) -> None:
        """Call ``f`` with each page in turn; stop where it returns False."""
        size, page, first = self.page_size or DEFAULT_PAGE_SIZE, [], True
        if self.plan_only:
            self._announce()
        for r in self.to_df().toLocalIterator(prefetchPartitions=True):
            if not page:
                self._announce()
            page.append(decode.materialise(self, r))
            if len(page) == size:
                if first:
                    self._count_records()
                first, full, page = False, page, []
                if f(full) is False:
                    return
        if first:
            self._count_records()
        if page:
            f(page)

    def _some(self, n: int, f) -> list:
        q = self.where(f) if f else self
        q._announce(top=n)
        return [decode.materialise(self, r) for r in q.to_df().limit(n).collect()]

    def first(self, f=None):
        rows = self._some(1, f)
        if not rows:
            raise EmptySequence("the query has no rows")
        return rows[0]

    def first_or_default(self, f=None):
        return next(iter(self._some(1, f)), None)

    def single(self, f=None):
        row = self.single_or_default(f, _missing := object())
        if row is _missing:
            raise EmptySequence("the query has no rows")
        return row

    def single_or_default(self, f=None, default=None):
        rows = self._some(2, f)
        if len(rows) > 1:
            raise MoreThanOne("the query has more than one row")
        return rows[0] if rows else default

    def count(self, f=None) -> int:
        q = self.where(f) if f else self
        q._announce(aggregate=("count", None))
        df = q.to_df()
        if self.aggregate_limit is not None and df.limit(self.aggregate_limit + 1).count() > self.aggregate_limit:
            raise OverflowError(f"more than {self.aggregate_limit} rows would be aggregated")
        return df.count()

    long_count = count

    def aggregate_df(self, func: str, f=None) -> DataFrame:
        """A scalar aggregate as a DataFrame of one row and one column, ``value``."""
        q = self.select(lambda r: {"value": f(r)}) if f else self
        df = q.to_df()
        if len(df.columns) != 1:
            raise UnsupportedQuery("an aggregate without a selector needs one projected column")
        if self.aggregate_limit is not None and df.limit(self.aggregate_limit + 1).count() > self.aggregate_limit:
            raise OverflowError(f"more than {self.aggregate_limit} rows would be aggregated")
        c = F.col(f"`{df.columns[0]}`")
        return df.agg({"sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "count": F.count}[func](c).alias("value"))

    def _scalar(self, func: str, f):
        self._announce(aggregate=(func, f))
        v = self.aggregate_df(func, f).first()[0]
        if v is None:
            raise EmptySequence(f"{func} of no values")
        return v

    def min(self, f=None):
        return self._scalar("min", f)

    def max(self, f=None):
        return self._scalar("max", f)

    def sum(self, f=None):
        return self._scalar("sum", f)

    def average(self, f=None):
        return self._scalar("avg", f)

    def count_column(self, f=None) -> int:
        self._announce(aggregate=("countcolumn", f))
        return self.aggregate_df("count", f).first()[0]


class _Keys(dict):
    __getattr__ = dict.__getitem__


def _async(name: str):
    async def method(self, *args, token: decode.CancelToken | None = None):
        return await asyncio.to_thread(decode.cancellable, self.catalog.spark, token, lambda: getattr(self, name)(*args))

    method.__name__ = f"{name}_async"
    method.__doc__ = f"``{name}`` off the event loop; ``token`` cancels its jobs."
    return method


for _n in ("to_list", "first", "first_or_default", "single", "single_or_default", "count", "long_count", "min", "max", "sum", "average", "count_column", "for_each_page"):
    setattr(Query, f"{_n}_async", _async(_n))
