"""How queries are registered, and how both engines read the same inputs."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadmill.functions.values import quoted

TABLE = re.compile(r"\{(\w+)\}")


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    """Register a function of (spark, folder) under a name, with its DuckDB SQL."""

    def register(run: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(run, sql)
        return run

    return register


def runners() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: q.run for name, q in QUERIES.items()}


def oracles() -> dict[str, str]:
    return {name: q.sql for name, q in QUERIES.items() if q.sql is not None}


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def source(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Run SQL that both dialects share; tables stand in braces."""
    tables = {name: read(spark, folder, name) for name in set(TABLE.findall(sql))}
    return spark.sql(sql, **tables)


def duck(sql: str) -> str:
    """The same SQL for DuckDB, where tables are views of that name."""
    return TABLE.sub(r"\1", sql)


def with_source(sql: str, rest: str, name: str = "src") -> str:
    return f"WITH {name} AS ({duck(sql)}) {rest}"


def text_of(column: str) -> Column:
    """A zone-less timestamp as text, so that no engine's time zone matters."""
    return F.date_format(quoted(column), "yyyy-MM-dd HH:mm:ss.SSSSSS")


def duck_text_of(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')"
