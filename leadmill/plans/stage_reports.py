"""Stage reports: touches per group, and averages of them, for all stages at once."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from leadmill import fixed_values as fixed
from leadmill.functions import values as V
from leadmill.functions.values import quoted
from leadmill.operators.aggregate import add_totals, as_list
from leadmill.operators.columns import fill_missing
from leadmill.operators.pivot import MOST_PIVOT_VALUES
from leadmill.operators.touches import stage_counts
from leadmill.session import materialise


@dataclass
class StageReport:
    counts: dict[str, DataFrame]
    averages: DataFrame | dict[str, DataFrame]


def _averages(counts: DataFrame, output: str, cell: list[str]) -> DataFrame:
    """(stage, cell, output, value): mean of the counts that occur, and the mean of the means."""
    mean = V.round_half_even(F.avg("n"))
    per_output = counts.groupBy("stage", *cell, quoted(output).cast("string").alias(output)).agg(mean.alias("value"))
    entries = F.array(
        F.struct(F.lit(False).alias("is_total"), quoted(output).alias(output)),
        F.struct(F.lit(True).alias("is_total"), F.lit(fixed.TOTAL_AVERAGE).alias(output)),
    )
    both = per_output.select("stage", *cell, "value", F.inline(entries))
    mean_of_means = V.round_half_even(F.avg("value"))
    return both.groupBy("is_total", "stage", *cell, output).agg(mean_of_means.alias("value"))


def _wide(long: DataFrame, keys: list[str], cells: dict[str, dict[str, str]], value: str) -> DataFrame:
    """One column per cell: name -> {column: wanted value}."""
    if not cells:
        return long.select(*map(quoted, keys)).distinct()
    picked = []
    for name, wanted in cells.items():
        here = F.lit(True)
        for column, text in wanted.items():
            here = here & (quoted(column).cast("string") == text)
        picked.append(F.max(F.when(here, F.col(value))).alias(name))
    return long.groupBy(*map(quoted, keys)).agg(*picked)


def _ordered(values: Sequence[str], order: Sequence[str] | None) -> list[str]:
    if not order:
        return list(values)
    return [v for v in order if v in values] + [v for v in values if v not in order]


def _counted(df: DataFrame, keys: list[str], stages: Sequence[str]) -> DataFrame:
    """The counts, stored: every table of a report reads them instead of the touches."""
    return materialise(stage_counts(df, keys, stages), "stage-counts")


def _values_by_stage(
    counts: DataFrame, pivot_column: str, stages: Sequence[str], order: Sequence[str] | None
) -> dict[str, list[str]]:
    """The pivot values that occur in each stage; too many are refused."""
    most = MOST_PIVOT_VALUES * len(stages)
    pairs = counts.select("stage", quoted(pivot_column).cast("string").alias("value")).distinct()
    found = pairs.limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"column {pivot_column!r} has too many values to pivot")
    return {s: _ordered(sorted(row.value for row in found if row.stage == s), order) for s in stages}


def by_stage(
    df: DataFrame,
    stages: Sequence[str],
    group_columns: str | Sequence[str],
    output_column: str,
    pivot_column: str | None = None,
    column_order: Sequence[str] | None = None,
) -> StageReport:
    """Rows per group and stage, and their averages per output value beside each other.

    ``stages`` names 0/1 flag columns. Every stage comes from one aggregation; the
    averages end in a row with the mean of the averages.
    """
    groups = as_list(group_columns)
    if pivot_column is None:
        counts = _counted(df, groups, stages)
        tables = {
            s: counts.where(F.col("stage") == s).select(*map(quoted, groups), F.col("n").alias(s))
            for s in stages
        }
        cells = {f"Avg_{s}": {"stage": s} for s in stages}
        long = _averages(counts, output_column, [])
    else:
        counts = _counted(df, [*groups, pivot_column], stages)
        values = _values_by_stage(counts, pivot_column, stages, column_order)
        tables = {s: _stage_table(counts, s, groups, pivot_column, values[s]) for s in stages}
        cells = {f"{s}_Avg_{v}": {"stage": s, pivot_column: v} for s in stages for v in values[s]}
        long = _averages(counts, output_column, [pivot_column])
    averages = _wide(long, ["is_total", output_column], cells, "value")
    return StageReport(tables, averages.orderBy("is_total", output_column).drop("is_total"))


def _stage_table(
    counts: DataFrame, stage: str, groups: list[str], pivot_column: str, values: Sequence[str]
) -> DataFrame:
    here = counts.where(F.col("stage") == stage)
    table = _wide(here, groups, {v: {pivot_column: v} for v in values}, "n")
    return table.na.fill(0, list(values)) if values else table


def channels_by_stage(
    df: DataFrame,
    stages: Sequence[str],
    group_columns: str | Sequence[str],
    pivot_column: str,
    output_column: str,
    column_order: Sequence[str] | None = None,
) -> StageReport:
    """Per stage: pivoted counts with a row total, and averages without it; gaps filled."""
    groups = as_list(group_columns)
    counts = _counted(df, [*groups, pivot_column], stages)
    values = _values_by_stage(counts, pivot_column, stages, column_order)
    long = _averages(counts, output_column, [pivot_column])
    tables, averages = {}, {}
    for s in stages:
        table = _stage_table(counts, s, groups, pivot_column, values[s])
        tables[s] = fill_missing(add_totals(table, groups, row_total=True))
        cells = {f"Avg_{v}": {pivot_column: v} for v in values[s]}
        wide = _wide(long.where(F.col("stage") == s), ["is_total", output_column], cells, "value")
        averages[s] = fill_missing(wide.orderBy("is_total", output_column).drop("is_total"))
    return StageReport(tables, averages)
