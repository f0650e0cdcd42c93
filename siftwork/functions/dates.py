"""Date ranges relative to a query's clock, and the fiscal calendar.

Every range is a pair of bounds on the bare column, so that it can be pushed down
to the files. Boundaries, where D is today's midnight, W the first day of the week,
M and Y of the month and year, P and F of the fiscal period and year:

* today, this-*, yesterday, tomorrow, last-* and next-* units: the whole unit,
  from its start to before its end.
* last-x-hours n: [NOW-n h, NOW]; last-x-days, -weeks, -months, -years n and
  last-seven-days: [D minus n units, NOW].
* next-x-hours n: (NOW, NOW+n h]; next-x-days, -weeks, -months, -years n and
  next-seven-days: (NOW, the end of the day n units on).
* last-x-fiscal-periods, -years n: the n whole ones before the current one;
  next-x-*: the n whole ones after it.
* older-than-x-months n: before NOW minus n months.
* on: that day; on-or-after: from that day's midnight (or the given time);
  on-or-before: to the end of that day.
* in-fiscal-year, in-fiscal-period(-and-year), in-or-before-, in-or-after-: by the
  fiscal calendar.
"""

from __future__ import annotations

import calendar
import datetime as dt
from dataclasses import dataclass
from typing import Any


@dataclass(frozen=True)
class Clock:
    """The moment a query counts from, and its calendar."""

    now: dt.datetime
    week_start: int = 6  # Monday is 0; Sunday 6
    fiscal_month: int = 1
    period_months: int = 3


@dataclass(frozen=True)
class Bounds:
    """low <= x (or <), x < high (or <=); None is open."""

    low: Any = None
    high: Any = None
    low_open: bool = False
    high_closed: bool = False
    period: int | None = None  # a fiscal period of any year


def add_months(d: dt.datetime, n: int) -> dt.datetime:
    y, m = divmod(d.year * 12 + d.month - 1 + n, 12)
    return d.replace(year=y, month=m + 1, day=min(d.day, calendar.monthrange(y, m + 1)[1]))


def _day(d: dt.datetime) -> dt.datetime:
    return d.replace(hour=0, minute=0, second=0, microsecond=0)


def _starts(c: Clock) -> dict[str, dt.datetime]:
    d = _day(c.now)
    month = d.replace(day=1)
    since = (month.month - c.fiscal_month) % 12
    return {
        "day": d,
        "week": d - dt.timedelta(days=(d.weekday() - c.week_start) % 7),
        "month": month,
        "year": month.replace(month=1),
        "fiscal-period": add_months(month, -(since % c.period_months)),
        "fiscal-year": add_months(month, -since),
    }


def shift(d: dt.datetime, unit: str, n: int, c: Clock) -> dt.datetime:
    if unit in ("hour", "day", "week"):
        return d + dt.timedelta(**{f"{unit}s": n})
    return add_months(d, n * {"month": 1, "year": 12, "fiscal-period": c.period_months, "fiscal-year": 12}[unit])


def fiscal_start(period: int, year: int, c: Clock) -> dt.datetime:
    return add_months(dt.datetime(year, c.fiscal_month, 1), (period - 1) * c.period_months)


def _unit(unit: str, n: int):
    return lambda c: Bounds(shift(_starts(c)[unit], unit, n, c), shift(_starts(c)[unit], unit, n + 1, c))


def _last(unit: str, n: int, c: Clock) -> Bounds:
    origin = c.now if unit == "hour" else _day(c.now)
    return Bounds(shift(origin, unit, -n, c), c.now, high_closed=True)


def _next(unit: str, n: int, c: Clock) -> Bounds:
    if unit == "hour":
        return Bounds(c.now, shift(c.now, unit, n, c), True, True)
    return Bounds(c.now, shift(_day(c.now), unit, n, c) + dt.timedelta(days=1), True)


def _fiscal(unit: str, n: int, back: bool, c: Clock) -> Bounds:
    at = _starts(c)[unit]
    return Bounds(shift(at, unit, -n, c), at) if back else Bounds(shift(at, unit, 1, c), shift(at, unit, n + 1, c))


RANGES: dict[str, Any] = {
    "today": _unit("day", 0),
    "yesterday": _unit("day", -1),
    "tomorrow": _unit("day", 1),
    "last-seven-days": lambda c: _last("day", 7, c),
    "next-seven-days": lambda c: _next("day", 7, c),
}
for _u in ("week", "month", "year", "fiscal-period", "fiscal-year"):
    for _w, _n in (("last", -1), ("this", 0), ("next", 1)):
        RANGES[f"{_w}-{_u}"] = _unit(_u, _n)
for _u in ("hour", "day", "week", "month", "year"):
    RANGES[f"last-x-{_u}s"] = lambda c, n, u=_u: _last(u, n, c)
    RANGES[f"next-x-{_u}s"] = lambda c, n, u=_u: _next(u, n, c)
for _u in ("fiscal-period", "fiscal-year"):
    RANGES[f"last-x-{_u}s"] = lambda c, n, u=_u: _fiscal(u, n, True, c)
    RANGES[f"next-x-{_u}s"] = lambda c, n, u=_u: _fiscal(u, n, False, c)
RANGES |= {
    "older-than-x-months": lambda c, n: Bounds(None, add_months(c.now, -n)),
    "on": lambda c, d: Bounds(_day(d), _day(d) + dt.timedelta(days=1)),
    "on-or-after": lambda c, d: Bounds(d),
    "on-or-before": lambda c, d: Bounds(None, _day(d) + dt.timedelta(days=1)),
    "in-fiscal-year": lambda c, y: Bounds(fiscal_start(1, y, c), fiscal_start(1, y + 1, c)),
    "in-fiscal-period": lambda c, p: Bounds(period=p),
    "in-fiscal-period-and-year": lambda c, p, y: Bounds(fiscal_start(p, y, c), fiscal_start(p + 1, y, c)),
    "in-or-after-fiscal-period-and-year": lambda c, p, y: Bounds(fiscal_start(p, y, c)),
    "in-or-before-fiscal-period-and-year": lambda c, p, y: Bounds(None, fiscal_start(p + 1, y, c)),
}
