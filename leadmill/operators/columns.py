"""Row filters, column names, types and row order."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from leadmill import fixed_values as fixed
from leadmill.functions import values as V
from leadmill.functions.values import holds_map, quoted


def filter_data(df: DataFrame, condition: Column | str) -> DataFrame:
    return df.where(condition)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    return df.toDF(*[prefix + name for name in df.columns])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(mapping))


def add_calculated_column(
    df: DataFrame, name: str, calculate: Callable[[DataFrame], Column]
) -> DataFrame:
    return df.withColumn(name, calculate(df))


def convert_column_types(
    df: DataFrame,
    str_cols: Sequence[str] = (),
    int_cols: Sequence[str] = (),
    float_cols: Sequence[str] = (),
    category_cols: Sequence[str] = (),
    datetime_cols: Sequence[str] = (),
    formats: Sequence[str] = (),
) -> DataFrame:
    """Lenient conversion: bad values become 0 (integers) or null; absent columns are skipped.

    Dates are read as ISO text, then in the order of ``formats``.
    """
    wanted: dict[str, Column] = {}
    for name in [*str_cols, *category_cols]:
        wanted[name] = quoted(name).cast("string")
    for name in int_cols:
        if name in df.columns:
            wanted[name] = V.to_long(quoted(name), V.data_type(df, name))
    for name in float_cols:
        if name in df.columns:
            wanted[name] = V.to_double(quoted(name), V.data_type(df, name))
    for name in datetime_cols:
        wanted[name] = V.to_moment(quoted(name), formats)
    return df.withColumns({name: to for name, to in wanted.items() if name in df.columns})


STRICT_TYPES = {
    "int": "bigint",
    "int64": "bigint",
    "float": "double",
    "float64": "double",
    "str": "string",
    "bool": "boolean",
    "category": "string",
    "datetime64[ns]": "timestamp_ntz",
}


def convert_dtype(df: DataFrame, types: Mapping[str, Sequence[str]]) -> DataFrame:
    """Strict conversion: a value that does not fit fails the job."""
    wanted: dict[str, Column] = {}
    for name, columns in types.items():
        target = STRICT_TYPES.get(name, name)
        for column in columns:
            source = quoted(column)
            if target == "bigint":
                number = V.to_double(source, V.data_type(df, column))
                refusal = F.raise_error(F.lit(f"column {column}: no integer for a missing or unreadable value"))
                wanted[column] = F.when(number.isNull(), refusal.cast("bigint")).otherwise(
                    V.to_long(source, V.data_type(df, column))
                )
            else:
                wanted[column] = source.cast(target)
    return df.withColumns(wanted)


def dates_to_timestamps(df: DataFrame) -> DataFrame:
    dates = [f.name for f in df.schema if isinstance(f.dataType, T.DateType)]
    return df.withColumns({name: quoted(name).cast("timestamp_ntz") for name in dates})


def clean_column_names(names: Sequence[str]) -> list[str]:
    cleaned = [re.sub(fixed.COLUMN_NAME_NOISE, "_", name) for name in names]
    return ["_" + name if name[:1].isdigit() else name for name in cleaned]


def unique_column_names(df: DataFrame) -> DataFrame:
    """Clean the names; the second of equal names gets ``_2``, the third ``_3``."""
    times: dict[str, int] = {}
    names = []
    for name in clean_column_names(df.columns):
        key = name.strip().lower()
        times[key] = times.get(key, 0) + 1
        names.append(name if times[key] == 1 else f"{name}_{times[key]}")
    return df.toDF(*names)


def reorder_columns_by_prefix(df: DataFrame, prefixes: Sequence[str]) -> DataFrame:
    """Columns by prefix, alphabetical within one; the rest last in their old order."""
    first = [name for prefix in prefixes for name in sorted(c for c in df.columns if c.startswith(prefix))]
    rest = [name for name in df.columns if not name.startswith(tuple(prefixes))]
    return df.select(*[quoted(name) for name in dict.fromkeys(first + rest)])


def fill_missing(df: DataFrame) -> DataFrame:
    return df.na.fill(0).na.fill("")


def lowercase_strings(df: DataFrame, but: Sequence[str] = ()) -> DataFrame:
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType) and f.name not in but]
    return df.withColumns({name: F.lower(quoted(name)) for name in texts})


def sort_data(df: DataFrame, columns: str | Sequence[str], ascending: bool = True) -> DataFrame:
    """Missing values come last in both directions."""
    names = [columns] if isinstance(columns, str) else columns
    return df.orderBy(
        *[quoted(n).asc_nulls_last() if ascending else quoted(n).desc_nulls_last() for n in names]
    )


def drop_duplicates(
    df: DataFrame, subset: Sequence[str] | None = None, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Keep one row per key: the first in ``order_by``, by default the smallest in the remaining columns."""
    if subset is None:
        return df.dropDuplicates()
    if order_by is None:
        order_by = [quoted(f.name).asc_nulls_last() for f in df.schema if f.name not in subset and not holds_map(f.dataType)]
    if not order_by:
        return df.dropDuplicates(list(subset))
    place = F.row_number().over(Window.partitionBy(*map(quoted, subset)).orderBy(*order_by))
    return df.withColumn("__place", place).where("__place = 1").drop("__place")
