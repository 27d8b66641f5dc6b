"""Candidate pairs between two tables: blocking and sorted neighbourhood."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from leadmill.functions.values import quoted
from leadmill.operators.joins import attach, fits_broadcast, pair_up
from leadmill.session import materialise

WINDOW = 3
ROW_BITS = 33


def rank_values(values: DataFrame) -> DataFrame:
    """(value, rank) of the distinct non-null values of a one-column frame, from 0.

    The values are range-partitioned and sorted, never brought into one task.
    ``monotonically_increasing_id`` holds the partition number in its upper and
    the place within it in its lower bits; partition sizes, one row each, give
    the offsets. The sorted values are written once, since another sampling run
    could draw other range bounds.
    """
    name = values.columns[0]
    distinct = values.select(quoted(name).alias("value")).where("value is not null").distinct()
    placed = materialise(
        distinct.repartitionByRange("value")
        .sortWithinPartitions("value")
        .select("value", F.monotonically_increasing_id().alias("place")),
        "ranks",
    ).select(
        "value",
        F.shiftright("place", ROW_BITS).alias("part"),
        F.col("place").bitwiseAND((1 << ROW_BITS) - 1).alias("row"),
    )
    sizes = placed.groupBy("part").agg((F.max("row") + 1).alias("rows"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("offset"))
    return placed.join(F.broadcast(offsets), "part").select("value", (F.col("offset") + F.col("row")).alias("rank"))


def block_keys(left: DataFrame, right: DataFrame, left_on: str, right_on: str) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``__block`` key; rows without one pair with nothing."""
    return (
        left.withColumn("__block", quoted(left_on)).where("__block is not null"),
        right.withColumn("__block", quoted(right_on)).where("__block is not null"),
    )


def neighbour_keys(
    left: DataFrame, right: DataFrame, left_on: str, right_on: str, window: int = WINDOW
) -> tuple[DataFrame, DataFrame]:
    """Both sides with a ``__block`` key that is equal when the values are neighbours.

    Neighbours are at most half a window apart in the sorted union of the distinct
    values of both sides. The left side carries each of its neighbours' ranks.
    """
    both = left.select(quoted(left_on)).union(right.select(quoted(right_on)))
    ranks = rank_values(both).toDF("__value", "__rank")
    half, small = window // 2, fits_broadcast(ranks)

    def ranked(side: DataFrame, column: str) -> DataFrame:
        keyed = side.withColumn("__value", quoted(column)).where("__value is not null")
        return attach(keyed, ranks, ["__value"], "inner", small).drop("__value")

    spread = F.explode(F.sequence(F.col("__rank") - half, F.col("__rank") + half))
    return (
        ranked(left, left_on).withColumn("__block", spread).drop("__rank"),
        ranked(right, right_on).withColumnRenamed("__rank", "__block"),
    )


def block_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    left_on: str,
    right_on: str,
    key_rows: int | None = None,
) -> DataFrame:
    """Id pairs whose block values are equal; ``key_rows`` as in ``deal_sides``."""
    ids = left.select(quoted(left_id), quoted(left_on).alias("__on")), right.select(
        quoted(right_id), quoted(right_on).alias("__on")
    )
    lefts, rights = block_keys(*ids, "__on", "__on")
    pairs = pair_up(lefts.drop("__on"), rights.drop("__on"), ["__block"], key_rows=key_rows)
    return pairs.select(quoted(left_id), quoted(right_id))


def neighbour_pairs(
    left: DataFrame,
    right: DataFrame,
    left_id: str,
    right_id: str,
    left_on: str,
    right_on: str,
    window: int = WINDOW,
    key_rows: int | None = None,
) -> DataFrame:
    """Id pairs whose values are neighbours in sorted order; ``key_rows`` as in ``deal_sides``."""
    lefts, rights = neighbour_keys(
        left.select(quoted(left_id), quoted(left_on).alias("__on")),
        right.select(quoted(right_id), quoted(right_on).alias("__on")),
        "__on",
        "__on",
        window,
    )
    pairs = pair_up(lefts.drop("__on"), rights.drop("__on"), ["__block"], key_rows=key_rows)
    return pairs.select(quoted(left_id), quoted(right_id))
