"""Entities, their metadata and the context of a query."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from ..functions.dates import Clock


@dataclass(frozen=True)
class Entity:
    """A row source: a Parquet path or table, or a function of the session.

    ``choices`` maps a choice column's numbers to labels; ``retained`` is the
    archive of the same rows.
    """

    name: str
    source: str | Callable[[SparkSession], DataFrame]
    primary_id: str | None = None
    parent: str | None = None
    choices: dict[str, dict[int, str]] = field(default_factory=dict)
    retained: str | Callable[[SparkSession], DataFrame] | None = None


@dataclass(frozen=True)
class Context:
    """Who asks, and when."""

    clock: Clock = Clock(dt.datetime(2000, 1, 1))
    user_id: Any = None
    business_unit_id: Any = None
    users: Callable[[SparkSession], DataFrame] | None = None  # (id, manager)
    teams: Callable[[SparkSession], DataFrame] | None = None  # (team, member)


class Catalog:
    """The entities of a session; ``query`` is the way in."""

    def __init__(self, spark: SparkSession, entities=(), context: Context | None = None):
        self.spark, self.context = spark, context or Context()
        self.entities = {e.name: e for e in entities}

    def add(self, entity: Entity) -> Catalog:
        self.entities[entity.name] = entity
        return self

    def at(self, **changes) -> Catalog:
        """The same entities in a changed context."""
        return Catalog(self.spark, self.entities.values(), replace(self.context, **changes))

    def entity(self, name: str) -> Entity:
        if name not in self.entities:
            raise KeyError(f"no entity named {name!r}")
        return self.entities[name]

    def table(self, name: str, retained: bool = False) -> DataFrame:
        e = self.entity(name)
        source = e.retained if retained else e.source
        if source is None:
            raise ValueError(f"{name} has no retained rows")
        if callable(source):
            return source(self.spark)
        return self.spark.read.parquet(source) if "/" in source else self.spark.table(source)

    def query(self, name: str, *columns: str, alias: str | None = None):
        from ..operators.query import Query

        return Query.of(self, name, columns, alias)
