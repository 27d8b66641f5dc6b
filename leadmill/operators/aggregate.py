"""Grouping, totals, averages and profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from leadmill import fixed_values as fixed
from leadmill.functions import values as V
from leadmill.functions.values import quoted
from leadmill.operators.columns import fill_missing
from leadmill.operators.median import exact_median, exact_medians

METHODS = ("count", "sum", "unique", "mean", "median", "maxid", "agg")


def as_list(names: str | Sequence[str] | None) -> list[str]:
    if names is None:
        return []
    return [names] if isinstance(names, str) else list(names)


def not_null(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose group keys are all present."""
    keep = reduce(lambda a, b: a & b, [quoted(k).isNotNull() for k in keys])
    for key in keys:
        if V.is_fractional(V.data_type(df, key)):
            keep = keep & ~F.isnan(quoted(key))
    return df.where(keep)


def aggregate(function: str, value: Column, kind: T.DataType) -> Column:
    """One aggregate over a column whose missing values are null already."""
    if function == "sum":
        return F.coalesce(F.sum(value), F.lit(0).cast("double" if V.is_fractional(kind) else "bigint"))
    if function in ("unique", "nunique"):
        return F.count_distinct(value)
    if function == "count":
        return F.count(value)
    if function in ("mean", "min", "max", "std", "var"):
        return {"mean": F.avg, "min": F.min, "max": F.max, "std": F.stddev, "var": F.variance}[function](value)
    raise ValueError(f"unknown aggregation {function!r}")


def create_names(columns: Sequence[str], functions: Sequence[str]) -> tuple[dict[str, str], dict[str, str]]:
    """Column -> function, and column -> ``Avg_x``, ``Sum_x``, ``#_x`` or ``function_x``."""
    if len(columns) != len(functions):
        raise ValueError("as many functions as columns are needed")
    pairs = list(zip(columns, functions))
    return dict(pairs), {c: f"{fixed.AGGREGATE_NAMES.get(f, f)}_{c}" for c, f in pairs}


def round_numbers(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    """Every fractional column to whole numbers, half to even."""
    parts = [f.name for f in df.schema if V.is_fractional(f.dataType) and f.name not in but]
    return df.withColumns({n: V.round_half_even(quoted(n)) for n in parts})


def grouped_agg(
    df: DataFrame, keys: Sequence[str], functions: Mapping[str, str], names: Mapping[str, str]
) -> DataFrame:
    """Several aggregates per group; blanks and zeros count as missing."""
    kinds = {c: V.data_type(df, c) for c in functions}
    inputs = {c: V.blank_to_null(quoted(c), kinds[c]) for c in functions}
    plain = {c: f for c, f in functions.items() if f != "median"}
    medians = [c for c, f in functions.items() if f == "median"]
    rows = not_null(df, keys)
    out = [names.get(c, c) for c in functions]
    parts = []
    if plain:
        parts.append(
            rows.groupBy(*map(quoted, keys)).agg(
                *[aggregate(f, inputs[c], kinds[c]).alias(names.get(c, c)) for c, f in plain.items()]
            )
        )
    if medians:
        parts.append(exact_medians(rows, keys, {names.get(c, c): inputs[c] for c in medians}))
    joined = reduce(lambda a, b: a.join(b, list(keys)), parts)
    return joined.select(*[quoted(n) for n in [*keys, *out]])


def top_row(df: DataFrame, keys: Sequence[str], value: str, order_by: Sequence[Column]) -> DataFrame:
    """The whole row with the largest value per group; groups without a value are left out."""
    kind = V.data_type(df, value)
    rows = not_null(df, keys).withColumn(value, V.blank_to_null(quoted(value), kind))
    place = F.row_number().over(
        Window.partitionBy(*map(quoted, keys)).orderBy(quoted(value).desc_nulls_last(), *order_by)
    )
    first = rows.withColumn("__place", place).where("__place = 1").drop("__place")
    return first.where(quoted(value).isNotNull())


def group_data(
    df: DataFrame,
    group_columns: str | Sequence[str],
    column_name: str | Mapping[str, str],
    method: str = "count",
    aggregate_column: str | Mapping[str, str] | None = None,
    row_total: bool = False,
    col_total: bool = False,
    sort: bool = True,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """Group and aggregate; missing keys are dropped, fractions rounded half to even."""
    keys = as_list(group_columns)
    if method not in METHODS:
        raise ValueError(f"unknown aggregation method {method!r}; use one of {', '.join(METHODS)}")
    if method == "count":
        grouped = not_null(df, keys).groupBy(*map(quoted, keys)).agg(F.count(F.lit(1)).alias(column_name))
    elif method == "maxid":
        grouped = top_row(df, keys, aggregate_column, order_by)
    elif method == "agg":
        names = column_name if isinstance(column_name, Mapping) else {}
        grouped = grouped_agg(df, keys, aggregate_column, names)
    else:
        grouped = grouped_agg(df, keys, {aggregate_column: method}, {aggregate_column: column_name})
    grouped = round_numbers(grouped)
    if row_total or col_total:
        return add_totals(grouped, keys, row_total, col_total)
    return grouped.orderBy(*map(quoted, keys)) if sort else grouped


def group_data_filled(
    df: DataFrame,
    group_columns: str | Sequence[str],
    column_name: str | Mapping[str, str],
    method: str = "count",
    aggregate_column: str | Mapping[str, str] | None = None,
    row_total: bool = False,
    col_total: bool = False,
    order_by: Sequence[Column] = (),
) -> DataFrame:
    """The earlier variant: gaps become 0 or blank, medians keep two places."""
    keys = as_list(group_columns)
    if method == "median":
        value = V.blank_to_null(quoted(aggregate_column), V.data_type(df, aggregate_column))
        grouped = exact_median(not_null(df, keys), keys, value, column_name)
        grouped = grouped.withColumn(column_name, V.round_half_even(F.coalesce(quoted(column_name), F.lit(0.0)), 2))
    elif method == "maxid":
        grouped = top_row(df, keys, aggregate_column, order_by)
    else:
        grouped = group_data(df, keys, column_name, method, aggregate_column, sort=False)
        if method == "mean":
            grouped = grouped.withColumn(column_name, F.coalesce(quoted(column_name), F.lit(0.0)).cast("bigint"))
    if row_total or col_total:
        return fill_missing(add_totals(grouped, keys, row_total, col_total, label=fixed.GRAND_TOTAL))
    return fill_missing(grouped).orderBy(*map(quoted, keys))


def add_totals(
    df: DataFrame,
    group_columns: str | Sequence[str] | None = None,
    row_total: bool = False,
    col_total: bool = False,
    label: str = fixed.TOTAL,
) -> DataFrame:
    """A ``RowTotal`` column and/or a last row of column sums.

    The label stands in the group columns and in every other column that is not
    numeric; without group columns it stands in the first column.
    """
    keys = as_list(group_columns)
    if row_total:
        parts = [quoted(n) for n in V.numeric_columns(df, keys)]
        df = df.withColumn(fixed.ROW_TOTAL, V.null_safe_sum(parts) if parts else F.lit(0).cast("bigint"))
    if not col_total:
        return df
    labelled = keys or df.columns[:1]
    summed = V.numeric_columns(df, labelled)
    body = df.select(
        *[quoted(n) if n in summed else quoted(n).cast("string").alias(n) for n in df.columns],
        F.lit(0).alias("__last"),
    )
    total = df.agg(
        *[
            F.coalesce(F.sum(quoted(n)), F.lit(0)).alias(n) if n in summed else F.first(F.lit(label)).alias(n)
            for n in df.columns
        ]
    ).withColumn("__last", F.lit(1))
    return body.unionByName(total).orderBy("__last", *map(quoted, labelled)).drop("__last")


def calculate_averages(
    df: DataFrame, columns: Sequence[str], group_columns: str | Sequence[str] | None = None
) -> DataFrame:
    """Each column averaged over its own positive rows, all in one aggregation."""
    averages = [
        V.round_half_even(F.avg(F.when(V.nan_to_null(quoted(c), V.data_type(df, c)) > 0, quoted(c)))).alias(f"Avg_{c}")
        for c in columns
    ]
    if group_columns is None:
        whole = df.agg(*averages)
        return whole.select(
            F.lit("Average").alias("Average_type"), *[quoted(n).cast("bigint").alias(n) for n in whole.columns]
        )
    keys = as_list(group_columns)
    grouped = not_null(df, keys).groupBy(*map(quoted, keys)).agg(*averages)
    return grouped.where(quoted(f"Avg_{columns[0]}").isNotNull()).orderBy(*map(quoted, keys))


def value_count(df: DataFrame, column: str) -> DataFrame:
    counts = not_null(df, [column]).groupBy(quoted(column)).agg(F.count(F.lit(1)).alias("Count"))
    return counts.orderBy(F.col("Count").desc(), quoted(column).asc())


def _as_rows(measured: DataFrame, labels: Sequence[tuple[str, str]]) -> DataFrame:
    entries = [
        F.struct(
            F.lit(metric).alias("metric"),
            F.lit(column).alias("column"),
            F.col(f"m{i}").cast("double").alias("value"),
        )
        for i, (metric, column) in enumerate(labels)
    ]
    return measured.select(F.inline(F.array(*entries)))


def _shape(df: DataFrame) -> list[tuple[tuple[str, str], Column]]:
    return [
        (("columns", ""), F.first(F.lit(len(df.columns)))),
        (("rows", ""), F.count(F.lit(1))),
    ]


def _measure(df: DataFrame, measures: list[tuple[tuple[str, str], Column]]) -> DataFrame:
    measured = df.agg(*[m.alias(f"m{i}") for i, (_, m) in enumerate(measures)])
    return _as_rows(measured, [label for label, _ in measures])


def summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows, columns and distinct values per column as (metric, column, value)."""
    distinct = [
        (("unique", c), F.count_distinct(V.nan_to_null(quoted(c), V.data_type(df, c)))) for c in columns
    ]
    return _measure(df, _shape(df) + distinct)


def describe(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Plain mean, sum, count or unique per column; zeros count here."""
    measures = _shape(df)
    for column, function in columns.items():
        value = V.nan_to_null(quoted(column), V.data_type(df, column))
        if function in ("mean", "sum", "count", "unique"):
            measures.append(((function, column), aggregate(function, value, V.data_type(df, column))))
        else:
            measures.append(((f"unsupported {function}", column), F.first(F.lit(None).cast("double"))))
    return _measure(df, measures)
