"""Exact medians for groups of any size, any number of measures in the same scans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadmill.functions.values import quoted
from leadmill.session import materialise

# a group is large from 1/LARGE_SHARE of all rows, so at most LARGE_SHARE groups are large
LARGE_SHARE = 10_000
LARGE_ROWS = 50_000
# brackets come from mergeable KLL sketches: about 1.7 / SKETCH_K rank error, exact up to SKETCH_K values
SKETCH_K = 2000
HALF_WIDTH = 0.005
RANK_GRID = 1000
# a bracket is narrowed by further rounds until at most this many values of a group lie inside
MIDDLE_ROWS = 2_000_000
NARROWING_ROUNDS = 8


def exact_median(
    df: DataFrame, keys: Sequence[str], value: Column, name: str, large_rows: int = LARGE_ROWS
) -> DataFrame:
    """One row per key with the interpolated median of the non-null values (see ``exact_medians``)."""
    return exact_medians(df, keys, {name: value}, large_rows)


def _zone(low: Column, high: Column) -> Column:
    v = F.col("__v")
    return F.when(v < low, 0).when(v > high, 2).otherwise(1)


def _with_brackets(rows: DataFrame, keys: Sequence[str], brackets: DataFrame, how: str) -> DataFrame:
    """Rows with the bracket of their group and measure; null keys meet null keys."""
    a, b = rows.alias("__a"), F.broadcast(brackets.alias("__b"))
    on = [F.col(f"__a.`{k}`").eqNullSafe(F.col(f"__b.`{k}`")) for k in keys] + [F.col("__a.__m") == F.col("__b.__m")]
    return rows.alias("__a").join(b, on, how).select("__a.*", "__b.__low", "__b.__high")


def _narrowed(rows: DataFrame, keys: Sequence[str], brackets: DataFrame, half_width: float) -> DataFrame:
    """One scan: for each bracket, a new one around both middle ranks, from sketches of the three zones.

    The zone holding a middle rank is sketched on its own. A ``half_width`` of 1
    gives the exact minimum and maximum of the zones holding the middle ranks,
    which a bracket that missed takes: it then holds the middle for certain.
    """
    met = _with_brackets(rows, keys, brackets, "inner")
    zone, v = _zone(F.col("__low"), F.col("__high")), F.col("__v")
    parts = []
    for z in range(3):
        parts += [
            F.count_if((zone == z) & v.isNotNull()).alias(f"__c{z}"),
            F.kll_sketch_agg_double(F.when(zone == z, v), SKETCH_K).alias(f"__s{z}"),
        ]
    zones = met.groupBy(*map(quoted, keys), "__m").agg(*parts)
    c0, c1, c2 = F.col("__c0"), F.col("__c1"), F.col("__c2")

    # the sketch takes fixed ranks only: quantiles on a grid, the grid step rounded outwards
    grid = F.array(*[F.lit(i / RANK_GRID) for i in range(RANK_GRID + 1)])

    def at(rank: Column, shift: float) -> Column:
        def quantile(sketch: str, r: Column, c: Column) -> Column:
            share = F.least(F.lit(1.0), F.greatest(F.lit(0.0), (r - 0.5) / c + shift)) * RANK_GRID
            step = F.floor(share) if shift <= 0 else F.ceil(share)
            return F.element_at(F.kll_sketch_get_quantile_double(sketch, grid), step.cast("int") + 1)

        return (
            F.when(rank <= c0, quantile("__s0", rank, c0))
            .when(rank <= c0 + c1, quantile("__s1", rank - c0, c1))
            .otherwise(quantile("__s2", rank - c0 - c1, c2))
        )

    n = c0 + c1 + c2
    middle = F.floor((n + 1) / 2)
    zone_rows = F.when(middle <= c0, c0).when(middle <= c0 + c1, c1).otherwise(c2)
    return zones.select(
        *map(quoted, keys), "__m",
        at(F.floor((n + 1) / 2), -half_width).alias("__low"), at(F.floor(n / 2) + 1, half_width).alias("__high"),
        F.least(n, (2 * half_width + 4.0 / SKETCH_K) * zone_rows).alias("__inside"),
    )


def _picked(rows: DataFrame, keys: Sequence[str], brackets: DataFrame, how: str) -> DataFrame:
    """One scan: the median of each group from the values inside its bracket, others only counted.

    (keys, __m, __median, __missed): ``__missed`` where a middle rank lies outside
    the bracket; such a group is placed again by another round.
    """
    met = _with_brackets(rows, keys, brackets, how)
    zone, v = _zone(F.col("__low"), F.col("__high")), F.col("__v")
    counted = (
        met.select(*map(quoted, keys), "__m", zone.alias("__zone"), F.when(zone == 1, v).alias("__v"), v.isNotNull().alias("__is"))
        .groupBy(*map(quoted, keys), "__m", "__zone", "__v")
        .agg(F.count_if("__is").alias("__n"))
    )
    group = Window.partitionBy(*map(quoted, keys), "__m")
    upto = F.sum("__n").over(group.orderBy("__zone", F.col("__v").asc_nulls_first()))
    placed = counted.select(
        *map(quoted, keys), "__m", "__zone", "__v", "__n", upto.alias("__upto"), F.sum("__n").over(group).alias("__all")
    )

    def at(rank: Column) -> tuple[Column, Column]:
        here = (F.col("__upto") - F.col("__n") < rank) & (rank <= F.col("__upto"))
        return F.max(F.when(here & (F.col("__zone") == 1), F.col("__v"))), F.max(here & (F.col("__zone") != 1))

    total = F.col("__all")
    (low, low_out), (high, high_out) = at(F.floor((total + 1) / 2)), at(F.floor(total / 2) + 1)
    return placed.groupBy(*map(quoted, keys), "__m").agg(
        ((low + high) / F.lit(2.0)).alias("__median"), F.coalesce(low_out | high_out, F.lit(False)).alias("__missed")
    )


def exact_medians(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column],
    large_rows: int = LARGE_ROWS,
    middle_rows: int = MIDDLE_ROWS,
) -> DataFrame:
    """One row per key with the interpolated median of the non-null values of each measure.

    All measures are stacked into (keys, measure, value) rows and handled in the
    same scans. Scan one counts each group and measure and builds a KLL sketch
    of it (mergeable, so partial on the map side). Groups of at least
    ``large_rows`` and a 1/LARGE_SHARE share of the rows get a bracket around the
    middle from their sketch; rows outside it are only counted, so no task holds
    a whole large group. Scan two picks the middle values by running counts.
    Where a bracket would hold over ``middle_rows`` values, rounds narrow it
    first, one scan each; where the middle lies outside a bracket, the group is
    placed again from the sketch of the zone holding it. The result is exact in
    every case; rounds only cost time. Groups without values give null; null
    keys form their own group.
    """
    keys = list(keys)
    names = list(values)
    cells = F.array(*[F.struct(F.lit(i).alias("__m"), c.cast("double").alias("__v")) for i, c in enumerate(values.values())])
    rows = df.select(*map(quoted, keys), F.inline(cells))
    stats = materialise(
        rows.groupBy(*map(quoted, keys), "__m").agg(
            F.count("__v").alias("__n"), F.kll_sketch_agg_double("__v", SKETCH_K).alias("__s1")
        ),
        "median-sketches",
    )
    share = stats.agg(F.sum("__n")).first()[0] or 0
    large = stats.where((F.col("__n") >= large_rows) & (F.col("__n") >= F.lit(share / LARGE_SHARE)))
    brackets = large.select(
        *map(quoted, keys), "__m",
        F.kll_sketch_get_quantile_double("__s1", F.lit(0.5 - HALF_WIDTH)).alias("__low"),
        F.kll_sketch_get_quantile_double("__s1", F.lit(0.5 + HALF_WIDTH)).alias("__high"),
        (F.col("__n") * (2 * HALF_WIDTH + 4.0 / SKETCH_K)).alias("__inside"),
    )
    brackets = _narrow_wide(rows, keys, brackets, middle_rows)
    picked = materialise(_picked(rows, keys, brackets.drop("__inside"), "left"), "medians")
    done = [picked.where(~F.col("__missed"))]
    missed = picked.where("__missed").select(*map(quoted, keys), "__m")
    while missed.count():
        wide = _with_brackets(missed, keys, brackets, "inner").select(*map(quoted, keys), "__m", "__low", "__high")
        brackets = _narrow_wide(rows, keys, _narrowed(rows, keys, wide, 1.0), middle_rows)
        again = materialise(_picked(rows, keys, brackets.drop("__inside"), "inner"), "medians")
        done.append(again.where(~F.col("__missed")))
        missed = again.where("__missed").select(*map(quoted, keys), "__m")
    found = reduce(DataFrame.unionByName, done)
    return found.groupBy(*map(quoted, keys)).agg(
        *[F.max(F.when(F.col("__m") == i, F.col("__median"))).alias(name) for i, name in enumerate(names)]
    )


def _narrow_wide(rows: DataFrame, keys: Sequence[str], brackets: DataFrame, middle_rows: int) -> DataFrame:
    """Brackets with at most about ``middle_rows`` values inside, narrowed by as many rounds as that takes.

    A bracket of one value is never narrowed: its rows meet as one counted value.
    Rounds stop after NARROWING_ROUNDS, where ties keep a bracket from shrinking;
    the pick is exact with any bracket, a wide one only holds more values.
    """
    brackets = materialise(brackets, "median-brackets")
    wide = (F.col("__inside") > middle_rows) & (F.col("__low") < F.col("__high"))
    for _ in range(NARROWING_ROUNDS):
        if not brackets.where(wide).count():
            break
        narrower = _narrowed(rows, keys, brackets.where(wide).drop("__inside"), HALF_WIDTH)
        brackets = materialise(brackets.where(~wide).unionByName(narrower), "median-brackets")
    return brackets
