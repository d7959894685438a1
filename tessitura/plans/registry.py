"""Named queries: a Spark plan over ``Tables`` and, where SQL can say it, a DuckDB text."""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import DataFrame

from .sql_views import with_views
from .views import Tables


@dataclasses.dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[Tables], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a plan under its function name with its SQL equivalent."""

    def add(build: Callable[[Tables], DataFrame]):
        label = name or build.__name__
        if label in QUERIES:
            raise ValueError(f"duplicate query {label}")
        QUERIES[label] = Query(label, build, with_views(sql) if sql else None)
        return build

    return add
