"""Pivot tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from leadmill.functions import values as V
from leadmill.functions.values import quoted
from leadmill.operators.aggregate import add_totals, aggregate, as_list, group_data, not_null
from leadmill.operators.columns import drop_duplicates
from leadmill.session import materialise

# a report with more columns than this is refused, never cut
MOST_PIVOT_VALUES = 10_000


def pivot_values(df: DataFrame, column: str) -> list[str]:
    """The distinct values of a pivot column, sorted; too many are refused."""
    found = df.select(quoted(column).cast("string").alias("v")).where("v is not null").distinct()
    values = [row.v for row in found.limit(MOST_PIVOT_VALUES + 1).collect()]
    if len(values) > MOST_PIVOT_VALUES:
        raise ValueError(f"column {column!r} has more than {MOST_PIVOT_VALUES} values to pivot")
    return sorted(values)


def pivot_data(
    df: DataFrame,
    index_columns: str | Sequence[str],
    pivot_columns: str | Sequence[str],
    measures: str | Sequence[str],
    function: str = "sum",
    values: Sequence[str] | None = None,
) -> DataFrame:
    """One column per pivot value; absent cells 0, rounded half to even, long.

    Several pivot columns are joined with ``_``; several measures give
    ``measure_value`` names.
    """
    index, pivots, cells = as_list(index_columns), as_list(pivot_columns), as_list(measures)
    rows = not_null(df, index + pivots)
    key = F.concat_ws("_", *[quoted(p).cast("string") for p in pivots])
    rows = rows.select(*map(quoted, index), key.alias("__pivot"), *map(quoted, cells))
    if values is None:
        values = pivot_values(rows, "__pivot")
    wanted = [
        aggregate(function, V.nan_to_null(quoted(c), V.data_type(df, c)), V.data_type(df, c)).alias(f"__{i}")
        for i, c in enumerate(cells)
    ]
    table = rows.groupBy(*map(quoted, index)).pivot("__pivot", list(values)).agg(*wanted)
    names = [f"{c}_{v}" if len(cells) > 1 else v for v in values for c in cells]
    table = table.toDF(*index, *names)
    whole = {n: V.round_half_even(F.coalesce(quoted(n).cast("double"), F.lit(0.0))).cast("bigint") for n in names
             if V.is_fractional(V.data_type(table, n))}
    whole |= {n: F.coalesce(quoted(n).cast("bigint"), F.lit(0).cast("bigint")) for n in names if n not in whole}
    in_order = [f"{c}_{v}" if len(cells) > 1 else v for c in cells for v in values]
    return table.withColumns(whole).select(*map(quoted, index), *map(quoted, in_order))


def pivot_group_data(
    df: DataFrame,
    group_columns: str | Sequence[str],
    pivot_columns: str | Sequence[str],
    column_name: str | Mapping[str, str],
    method: str = "count",
    aggregate_column: str | Mapping[str, str] | None = None,
    drop_columns: str | Sequence[str] | None = None,
    row_total: bool = False,
    col_total: bool = False,
    values: Sequence[str] | None = None,
) -> DataFrame:
    """Deduplicate if asked, group, then pivot the groups."""
    groups, pivots = as_list(group_columns), as_list(pivot_columns)
    if drop_columns:
        df = drop_duplicates(df, as_list(drop_columns) + groups + pivots)
    grouped = group_data(df, groups + pivots, column_name, method, aggregate_column, sort=False)
    if values is None:
        # the groups are read once for the column names and once for the table
        grouped = materialise(grouped, "pivot-groups")
    measures = list(column_name.values()) if isinstance(column_name, Mapping) else column_name
    table = pivot_data(grouped, groups, pivots, measures, values=values)
    if row_total or col_total:
        return add_totals(table, groups, row_total, col_total)
    return table.orderBy(*map(quoted, groups))
