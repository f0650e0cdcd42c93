"""Values and predicates of a query, as immutable nodes.

Predicates keep their own negation: ``~p`` swaps operators down to the leaves,
because the null rules of the leaves are not those of SQL's NOT (see
``operators.predicates``).
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field
from enum import Enum
from typing import Any


class UnsupportedPredicate(ValueError):
    """A condition that the query layer refuses rather than guess at."""


def plain(v: Any) -> Any:
    """A constant as its storage value: enums become their number, dates midnight."""
    if isinstance(v, Enum):
        return plain(v.value)
    if isinstance(v, dt.date) and not isinstance(v, dt.datetime):
        return dt.datetime(v.year, v.month, v.day)
    return v


# --------------------------------------------------------------------- predicates
class Pred:
    def __and__(self, other: Pred) -> Pred:
        return Junction("and", (self, _pred(other)))

    def __or__(self, other: Pred) -> Pred:
        return Junction("or", (self, _pred(other)))

    def __invert__(self) -> Pred:
        return self.negated()

    def negated(self) -> Pred:
        raise NotImplementedError

    def __bool__(self):
        raise UnsupportedPredicate("use & | ~ instead of and, or, not")


def _pred(p: Any) -> Pred:
    if not isinstance(p, Pred):
        raise UnsupportedPredicate(f"not a condition: {p!r}")
    return p


@dataclass(frozen=True, eq=False)
class Junction(Pred):
    kind: str
    parts: tuple

    def negated(self) -> Pred:
        return Junction("or" if self.kind == "and" else "and", tuple(p.negated() for p in self.parts))


#: Each operator and the one that its negation uses.
OPPOSITE = {
    "eq": "ne", "lt": "ge", "le": "gt", "null": "not-null", "like": "not-like", "in": "not-in",
    "length-eq": "length-ne", "length-lt": "length-ge", "length-le": "length-gt",
    "contain-values": "not-contain-values", "set-eq": "set-ne", "between": "not-between",
    "eq-userid": "ne-userid", "eq-businessid": "ne-businessid", "under": "not-under",
    "range": "not-range", "empty": "not-empty",
}
OPPOSITE |= {b: a for a, b in OPPOSITE.items()}


@dataclass(frozen=True, eq=False)
class Cond(Pred):
    op: str
    target: Any
    args: tuple = ()

    def negated(self) -> Pred:
        if self.op not in OPPOSITE:
            raise UnsupportedPredicate(f"{self.op} has no negation")
        return Cond(OPPOSITE[self.op], self.target, self.args)


@dataclass(frozen=True, eq=False)
class Quantified(Pred):
    """any, all, exists or in over another query, correlated with this one's row."""

    kind: str
    source: Any
    scope: Any
    pred: Pred
    negative: bool = False

    def negated(self) -> Pred:
        return Quantified(self.kind, self.source, self.scope, self.pred, not self.negative)


# ------------------------------------------------------------------------- values
class Value:
    """Anything with a column: an attribute, a computation, an aggregate."""

    # comparisons
    def _compare(self, op: str, flipped: str, other: Any) -> Pred:
        other = plain(other)
        if other is None:
            if op in ("eq", "ne"):
                return Cond("null" if op == "eq" else "not-null", self)
            raise UnsupportedPredicate("null has no order")
        return Cond(op, self, (other,))

    def __eq__(self, other):  # type: ignore[override]
        return self._compare("eq", "eq", other)

    def __ne__(self, other):  # type: ignore[override]
        return self._compare("ne", "ne", other)

    def __lt__(self, other):
        return self._compare("lt", "gt", other)

    def __le__(self, other):
        return self._compare("le", "ge", other)

    def __gt__(self, other):
        return self._compare("gt", "lt", other)

    def __ge__(self, other):
        return self._compare("ge", "le", other)

    __hash__ = object.__hash__

    # strings
    def contains(self, v: str, escape: bool = False) -> Pred:
        return Cond("like", self, ("%", v, "%", escape))

    def startswith(self, v: str, escape: bool = False) -> Pred:
        return Cond("like", self, ("", v, "%", escape))

    def endswith(self, v: str, escape: bool = False) -> Pred:
        return Cond("like", self, ("%", v, "", escape))

    def is_null_or_empty(self) -> Pred:
        return Cond("empty", self)

    def length(self) -> Length:
        return Length(self)

    # collections
    def is_in(self, values, comparer=None) -> Pred:
        if comparer is not None:
            raise UnsupportedPredicate("membership compares by equality; a comparer of its own is refused")
        values = tuple(plain(v) for v in values)
        if not values:
            raise ValueError("an empty collection matches nothing; the query is refused")
        return Cond("in", self, values)

    def contains_value(self, v) -> Pred:
        return Cond("contain-values", self, (plain(v),))

    def contains_values(self, *values) -> Pred:
        if not values:
            raise ValueError("contains_values needs a value")
        return Cond("contain-values", self, tuple(plain(v) for v in values))

    def set_equals(self, *values) -> Pred:
        return Cond("set-eq", self, tuple(plain(v) for v in values))

    # users and hierarchies
    def equal_user_id(self) -> Pred:
        return Cond("eq-userid", self)

    def not_equal_user_id(self) -> Pred:
        return Cond("ne-userid", self)

    def equal_business_id(self) -> Pred:
        return Cond("eq-businessid", self)

    def not_equal_business_id(self) -> Pred:
        return Cond("ne-businessid", self)

    def equal_user_or_hierarchy(self) -> Pred:
        return Cond("eq-useroruserhierarchy", self)

    def equal_user_or_hierarchy_and_teams(self) -> Pred:
        return Cond("eq-useroruserhierarchyandteams", self)

    def above(self, v) -> Pred:
        return Cond("above", self, (v,))

    def above_or_equal(self, v) -> Pred:
        return Cond("eq-or-above", self, (v,))

    def under(self, v) -> Pred:
        return Cond("under", self, (v,))

    def under_or_equal(self, v) -> Pred:
        return Cond("eq-or-under", self, (v,))

    def not_under(self, v) -> Pred:
        return Cond("not-under", self, (v,))

    # dates
    def between(self, low, high) -> Pred:
        return Cond("between", self, (plain(low), plain(high)))

    def not_between(self, low, high) -> Pred:
        return Cond("not-between", self, (plain(low), plain(high)))

    def during(self, name: str, *args) -> Pred:
        """A relative or fiscal date range by name, such as ``last-x-days``."""
        return Cond("range", self, (name, *args))

    def year(self):
        return Part("year", self)

    def month(self):
        return Part("month", self)

    def day(self):
        return Part("day", self)

    def week(self):
        return Part("week", self)

    def quarter(self):
        return Part("quarter", self)

    def fiscal_period(self):
        return Part("fiscal-period", self)

    def fiscal_year(self):
        return Part("fiscal-year", self)

    # computations
    def __add__(self, o):
        return Computed("+", (self, o))

    def __radd__(self, o):
        return Computed("+", (o, self))

    def __sub__(self, o):
        return Computed("-", (self, o))

    def __rsub__(self, o):
        return Computed("-", (o, self))

    def __mul__(self, o):
        return Computed("*", (self, o))

    def __rmul__(self, o):
        return Computed("*", (o, self))

    def __truediv__(self, o):
        return Computed("/", (self, o))

    def __rtruediv__(self, o):
        return Computed("/", (o, self))

    def or_else(self, o):
        """This value, or ``o`` where it is null."""
        return Computed("coalesce", (self, o))

    def apply(self, f, *more):
        """A column function of this value, such as ``pyspark.sql.functions.upper``."""
        return Computed(f, (self, *more))


def _range_method(name: str):
    def method(self, *args):
        return self.during(name, *(plain(a) for a in args))

    method.__name__ = name.replace("-", "_")
    method.__doc__ = f"The date lies in the range {name} (see functions.dates)."
    return method


from .dates import RANGES  # noqa: E402

for _name in RANGES:
    setattr(Value, _name.replace("-", "_"), _range_method(_name))


@dataclass(frozen=True, eq=False)
class Length:
    """A string's length; only comparisons with a number are allowed."""

    of: Value

    def _cond(self, op, n):
        if isinstance(n, bool) or not isinstance(n, int):
            raise UnsupportedPredicate("a length is compared with a whole number")
        return Cond(f"length-{op}", self.of, (n,))

    def __eq__(self, n):  # type: ignore[override]
        return self._cond("eq", n)

    def __ne__(self, n):  # type: ignore[override]
        return self._cond("ne", n)

    def __lt__(self, n):
        return self._cond("lt", n)

    def __le__(self, n):
        return self._cond("le", n)

    def __gt__(self, n):
        return self._cond("gt", n)

    def __ge__(self, n):
        return self._cond("ge", n)

    __hash__ = object.__hash__


@dataclass(frozen=True, eq=False)
class Attr(Value):
    scope: Any
    alias: str
    name: str


@dataclass(frozen=True, eq=False)
class Part(Value):
    part: str
    of: Value


@dataclass(frozen=True, eq=False)
class Computed(Value):
    how: Any
    args: tuple


@dataclass(frozen=True, eq=False)
class Choice(Value):
    """One of two values by a condition."""

    test: Pred
    then: Any
    other: Any


def choose(test: Pred, then: Any, other: Any) -> Choice:
    return Choice(_pred(test), then, other)


def text(*parts) -> Computed:
    """Concatenation; nulls count as empty."""
    return Computed("concat", parts)


@dataclass(frozen=True, eq=False)
class Aggregate(Value):
    func: str
    of: Any = None
    distinct: bool = False


@dataclass(frozen=True, eq=False)
class KeyColumn(Value):
    """A group's key, which further values can be computed from."""

    column: Any


@dataclass(frozen=True, eq=False)
class ChildCount(Value):
    """How many rows name this row as their parent; 0 where none does."""

    scope: Any
    alias: str


# ----------------------------------------------------------------------------- rows
_OWN = {"scope", "alias", "names", "attr", "count_children"}


@dataclass(frozen=True, eq=False)
class EntityRef:
    """A whole joined row; its attributes are read as ``ref.name`` or ``ref["name"]``."""

    scope: Any
    alias: str

    def attr(self, name: str) -> Attr:
        if not isinstance(name, str) or not name:
            raise UnsupportedPredicate("an attribute name is a non-empty string")
        return Attr(self.scope, self.alias, name)

    def __getattr__(self, name: str) -> Attr:
        if name.startswith("__"):
            raise AttributeError(name)
        return self.attr(name)

    def __getitem__(self, name: str) -> Attr:
        return self.attr(name)

    def count_children(self) -> ChildCount:
        return ChildCount(self.scope, self.alias)

    # A left-joined row is null where the join found nothing.
    def __eq__(self, other):  # type: ignore[override]
        if other is not None:
            raise UnsupportedPredicate("a whole row is only compared with None")
        return Cond("null", self)

    def __ne__(self, other):  # type: ignore[override]
        if other is not None:
            raise UnsupportedPredicate("a whole row is only compared with None")
        return Cond("not-null", self)

    __hash__ = object.__hash__


@dataclass(frozen=True, eq=False)
class RowRef:
    """The row a lambda sees: after a join, entities by alias; else the root's attributes."""

    scope: Any
    root: str
    aliases: tuple = field(default=())

    def attr(self, name: str, alias: str | None = None) -> Attr:
        return EntityRef(self.scope, alias or self.root).attr(name)

    def entity(self, alias: str | None = None) -> EntityRef:
        return EntityRef(self.scope, alias or self.root)

    def count_children(self) -> ChildCount:
        return ChildCount(self.scope, self.root)

    def __getattr__(self, name: str):
        if name.startswith("__"):
            raise AttributeError(name)
        return EntityRef(self.scope, name) if name in self.aliases and len(self.aliases) > 1 else self.attr(name)

    def __getitem__(self, name: str):
        return EntityRef(self.scope, name) if name in self.aliases and len(self.aliases) > 1 else self.attr(name)
