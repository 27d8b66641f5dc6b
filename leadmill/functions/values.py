"""Numeric, date and missing-value expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from leadmill import fixed_values as fixed

NUMBER = r"(?i)^[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|inf|infinity)$"
WHITESPACE = "".join(chr(code) for code in range(0x10000) if chr(code).isspace())
MICROS_PER_DAY = 86_400_000_000.0


def data_type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def to_moment(value: Column, formats: Sequence[str] = ()) -> Column:
    """ISO text or a date as a zone-less timestamp, else by the first of ``formats`` that fits, else null."""
    read = [F.try_to_timestamp(value.cast("string"), F.lit(f)).cast("timestamp_ntz") for f in formats]
    return F.coalesce(value.try_cast("timestamp_ntz"), *read)


def holds_map(kind: T.DataType) -> bool:
    """Whether a map is part of a type; maps cannot be hashed."""
    if isinstance(kind, T.StructType):
        return any(holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType) or (isinstance(kind, T.ArrayType) and holds_map(kind.elementType))


WIDE = {T.ByteType: "bigint", T.ShortType: "bigint", T.IntegerType: "bigint", T.LongType: "bigint", T.FloatType: "double", T.DoubleType: "double"}


def family(kind: T.DataType):
    """Integers of any width are one family, fractions another; other types stand for themselves."""
    return WIDE.get(type(kind), kind)


def widened(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Integers and fractions in their widest type."""
    return df.withColumns({n: quoted(n).cast(WIDE[type(data_type(df, n))]) for n in names if type(data_type(df, n)) in WIDE})


def is_fractional(kind: T.DataType) -> bool:
    return isinstance(kind, (T.FloatType, T.DoubleType))


def is_number(kind: T.DataType) -> bool:
    return isinstance(kind, T.NumericType)


def numeric_columns(df: DataFrame, but: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema if is_number(f.dataType) and f.name not in but]


def quoted(name: str) -> Column:
    """A column by its literal name, dots and brackets included."""
    return F.col("`" + name.replace("`", "``") + "`")


def round_half_even(value: Column, places: int = 0) -> Column:
    if places == 0:
        return F.rint(value)
    scale = float(10**places)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def nan_to_null(value: Column, kind: T.DataType) -> Column:
    return F.when(~F.isnan(value), value) if is_fractional(kind) else value


def blank_to_null(value: Column, kind: T.DataType) -> Column:
    """Blank text and zero count as missing in aggregations."""
    if isinstance(kind, T.StringType):
        return F.nullif(value, F.lit(""))
    if is_number(kind):
        return F.nullif(nan_to_null(value, kind), F.lit(0).cast(kind))
    return value


def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(WHITESPACE))


def to_double(value: Column, kind: T.DataType) -> Column:
    """Lenient number: what cannot be read is null."""
    if isinstance(kind, T.StringType):
        text = strip(value)
        return F.when(text.rlike(NUMBER), text.try_cast("double"))
    if is_fractional(kind):
        return nan_to_null(value, kind).cast("double")
    return value.try_cast("double")


def to_long(value: Column, kind: T.DataType) -> Column:
    """Lenient integer: what cannot be read is 0, fractions are cut toward zero."""
    if isinstance(kind, T.StringType):
        text = strip(value)
        whole = F.when(text.rlike(r"^[+-]?\d+$"), text.try_cast("bigint"))
        return F.coalesce(whole, to_double(value, kind).try_cast("bigint"), F.lit(0).cast("bigint"))
    if is_number(kind) and not is_fractional(kind):
        return F.coalesce(value.cast("bigint"), F.lit(0).cast("bigint"))
    return F.coalesce(to_double(value, kind).try_cast("bigint"), F.lit(0).cast("bigint"))


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it does not or is unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def null_safe_sum(values: Sequence[Column]) -> Column:
    total = F.coalesce(values[0], F.lit(0))
    for value in values[1:]:
        total = total + F.coalesce(value, F.lit(0))
    return total


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end, rounded down; null if either is null."""
    micros = F.timestamp_diff("MICROSECOND", start, end)
    return F.floor(micros / F.lit(MICROS_PER_DAY)).cast("bigint")


def short_number(value: Column, fractional: bool = False) -> Column:
    """1200 -> 1K, then M and B; floor division."""
    tail = ".0" if fractional else ""

    def scaled(size: int, unit: str) -> Column:
        return F.concat(F.floor(value / F.lit(size)).cast("string"), F.lit(tail + unit))

    return (
        F.when(value >= 1_000_000_000, scaled(1_000_000_000, "B"))
        .when(value >= 1_000_000, scaled(1_000_000, "M"))
        .when(value >= 1_000, scaled(1_000, "K"))
        .otherwise(value.cast("string"))
    )


def short_number_text(value: int) -> str:
    for size, unit in ((1_000_000_000, "B"), (1_000_000, "M"), (1_000, "K")):
        if value >= size:
            return f"{value // size}{unit}"
    return str(value)


def bin_labels(edges: Sequence[float], short: bool = False) -> list[str]:
    """One label per bin; the last bin is open to the right."""
    show = short_number_text if short else str
    labels = [
        f"{show(int(low) + 1)} to {show(int(high))}" for low, high in zip(edges, edges[1:])
    ]
    return labels + [f"{show(int(edges[-1]))}+"]


def bin_label(value: Column, edges: Sequence[float] | None = None, short: bool = False) -> Column:
    """Right-closed bins on the absolute value; the lowest edge belongs to the first bin."""
    edges = fixed.DEFAULT_BIN_EDGES if edges is None else sorted(edges)
    size = F.abs(value)
    labels = bin_labels(edges, short)
    picked = F.when(size < F.lit(edges[0]), F.lit(None).cast("string"))
    for high, label in zip(edges[1:], labels):
        picked = picked.when(size <= F.lit(high), F.lit(label))
    return picked.otherwise(F.lit(labels[-1]))


def revenue_source(
    account: Column, dnb: Column, zi: Column, zi_exact: Column, dnb_gap: Column, zi_gap: Column
) -> Column:
    """Label of the provider whose revenue to trust; the first label that holds wins."""
    cut = fixed.REVENUE_CUTOFF

    def within(gap: Column) -> Column:
        return gap.between(-cut, cut)

    return (
        F.when(account == dnb, "DNB_Exact_Match")
        .when(account == zi_exact, "ZI_Exact_Match")
        .when(
            (dnb > 0) & within(dnb_gap) & ((zi == 0) | (F.abs(dnb_gap) <= F.abs(zi_gap))),
            f"DNB_Under_{cut}",
        )
        .when(
            (zi > 0) & within(zi_gap) & ((dnb == 0) | (F.abs(dnb_gap) >= F.abs(zi_gap))),
            f"ZI_Under_{cut}",
        )
        .when((account == 0) & (dnb > 0), "Update_Zero_from_DNB")
        .when((account == 0) & (zi > 0), "Update_Zero_from_ZI")
        .otherwise("Needs_Review")
    )
