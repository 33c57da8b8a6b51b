"""Queries registered by name, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str


@dataclass
class Registry:
    queries: dict[str, Query] = field(default_factory=dict)

    def check(self, sql: str, name: str | None = None) -> Callable[[Run], Run]:
        """Register the function below, by its own name unless given one."""

        def register(run: Run) -> Run:
            key = name or run.__name__
            if key in self.queries:
                raise ValueError(f"registered twice: {key}")
            self.queries[key] = Query(run, sql)
            return run

        return register
