"""Queries over the driver's tables, each with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    """A query and its oracle; ``operator`` is the inventory id it covers."""

    operator: str
    run: Callable[[SparkSession, str], DataFrame]
    sql: str


class Registry(dict[str, Query]):
    def add(self, name: str, operator: str, sql: str):
        def register(run: Callable[[SparkSession, str], DataFrame]):
            if name in self:
                raise ValueError(f"query {name} is registered twice")
            self[name] = Query(operator, run, sql.strip())
            return run

        return register
