"""Bins, split amounts, deal velocity and revenue source on whole tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

from leadmill import fixed_values as fixed
from leadmill.functions import values as V
from leadmill.functions.values import quoted


def format_numbers(df: DataFrame, column: str, into: str) -> DataFrame:
    return df.withColumn(into, V.short_number(quoted(column), V.is_fractional(V.data_type(df, column))))


def calculate_bins(
    df: DataFrame, columns: Sequence[str], edges: Sequence[float] | None = None, short: bool = False
) -> DataFrame:
    """``{column}_bins`` labels; the column itself becomes numeric with gaps as 0."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise ValueError(f"columns not found: {', '.join(absent)}")
    numbers = {}
    for c in columns:
        kind = V.data_type(df, c)
        if V.is_number(kind) and not V.is_fractional(kind):
            numbers[c] = F.coalesce(quoted(c), F.lit(0).cast(kind))
        else:
            numbers[c] = F.coalesce(V.to_double(quoted(c), kind), F.lit(0.0))
    df = df.withColumns(numbers)
    return df.withColumns({f"{c}_bins": V.bin_label(quoted(c), edges, short) for c in columns})


def calculate_split_amounts(
    df: DataFrame,
    weights: Sequence[str],
    amount: str,
    equal_weight: bool = False,
    equal_amount: bool = False,
    bins: bool = True,
) -> DataFrame:
    """Share an amount by weights into ``{weight}_ACV`` columns and their total.

    ``equal_weight`` turns each weight into 1 or 0, ``equal_amount`` gives the whole
    amount per weight, ``bins=False`` is the earlier variant: no filling, rounding
    of the total, text or bins.
    """
    if equal_weight:
        df = df.withColumns({w: V.flag(quoted(w) > 0) for w in weights})
    number = {c: V.nan_to_null(quoted(c), V.data_type(df, c)).cast("double") for c in [*weights, amount]}
    total_weight = V.null_safe_sum([number[w] for w in weights])
    shares = {}
    for w in weights:
        whole = number[amount] * number[w]
        shares[f"{w}_ACV"] = V.round_half_even(whole if equal_amount else F.try_divide(whole, total_weight), 2)
    df = df.withColumns(shares)
    total = V.null_safe_sum([quoted(s) for s in shares])
    if not bins:
        return df.withColumn("TotalSplitAmount", total)
    df = df.na.fill(0).withColumn("TotalSplitAmount", V.round_half_even(total, 2))
    millions = V.round_half_even(F.col("TotalSplitAmount") / 1_000_000, 2)
    df = df.withColumn("TotalSplitAmount(M)", F.format_string("$%.2fM", millions))
    return calculate_bins(df, [*shares, "TotalSplitAmount"], fixed.REVENUE_BIN_EDGES, short=True)


def calculate_deal_velocity(df: DataFrame, stages: Sequence[str], convert: bool = False, formats: Sequence[str] = ()) -> DataFrame:
    """Whole days between neighbouring stages, first to last and second to last.

    ``convert`` reads text as ISO dates, then in the order of ``formats``.
    """
    if len(stages) < 2:
        raise ValueError("deal velocity needs at least two stages")
    if convert:
        df = df.withColumns(
            {
                s: V.to_moment(quoted(s), formats)
                for s in stages
                if not isinstance(V.data_type(df, s), (T.TimestampType, T.TimestampNTZType))
            }
        )
    spans = [*zip(stages, stages[1:]), (stages[0], stages[-1]), (stages[1], stages[-1])]
    return df.withColumns(
        {f"Velocity_{a}_to_{b}": V.days_between(quoted(a), quoted(b)) for a, b in dict.fromkeys(spans)}
    )


def add_revenue_source(
    df: DataFrame, into: str = "Revenue_Source", zi_exact: str = "ZI_Revenue_Deviation"
) -> DataFrame:
    """Label each row with the provider whose revenue to trust.

    ``zi_exact`` is the column compared for an exact match with the second provider.
    """
    names = ["SF_AnnualRevenue", "DNB_SalesVolumeUSDollars", "ZI_AnnualRevenue", zi_exact,
             "DNB_Deviation(%)", "ZI_Deviation(%)"]
    return df.withColumn(into, V.revenue_source(*[V.nan_to_null(quoted(n), V.data_type(df, n)) for n in names]))
