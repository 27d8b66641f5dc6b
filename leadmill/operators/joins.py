"""Joins that hold when one key carries a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.functions.values import holds_map
from leadmill.session import materialise

BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# a dimension key is hot when it holds at least 1/HOT_SHARE of the facts, so at most HOT_SHARE keys are hot
HOT_SHARE = 2_000
# up to this many rows and pairs one key is no burden for a task
KEY_ROWS = 100_000
KEY_PAIRS = 10_000_000.0


@dataclass(frozen=True)
class KeyLoad:
    """What an equi join of two sides would meet."""

    pairs: float
    rows: float
    most_rows: int
    most_pairs: float

    @property
    def skewed(self) -> bool:
        return self.most_rows > KEY_ROWS or self.most_pairs > KEY_PAIRS


def key_load(left: DataFrame, right: DataFrame, on: Sequence[str]) -> KeyLoad:
    """Pairs and rows, in all and of the largest key, from one aggregation of the keys alone."""
    def marked(side: DataFrame, l: int, r: int) -> DataFrame:
        return side.dropna(subset=list(on)).select(*on, F.lit(l).alias("l"), F.lit(r).alias("r"))

    sizes = marked(left, 1, 0).union(marked(right, 0, 1)).groupBy(*on).agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    joined = F.col("l").cast("double") * F.col("r")
    pairs, rows, most_rows, most_pairs = sizes.agg(
        F.sum(joined),
        F.sum((F.col("l") + F.col("r")).cast("double")),
        F.max(F.greatest("l", "r")),
        F.max(joined),
    ).first()
    return KeyLoad(pairs or 0.0, rows or 0.0, most_rows or 0, most_pairs or 0.0)


def fits_broadcast(df: DataFrame) -> bool:
    """Measure rows and bytes, reading at most one row more than the bound."""
    size = F.octet_length(F.to_json(F.struct("*"))).cast("bigint")
    rows, width = (
        df.limit(BROADCAST_ROWS + 1).select(size.alias("s")).agg(F.count(F.lit(1)), F.sum("s")).first()
    )
    return rows <= BROADCAST_ROWS and (width or 0) <= BROADCAST_BYTES


def key_counts(df: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    return df.dropna(subset=list(on)).groupBy(*on).agg(F.count(F.lit(1)).alias(name))


def hot_limit(counts: DataFrame, name: str) -> Column:
    """Row count from which a key is hot, as a scalar subquery."""
    share = F.ceil(F.sum(name) / F.lit(HOT_SHARE)).cast("bigint")
    return counts.agg(F.greatest(F.coalesce(share, F.lit(1)), F.lit(2)).alias("limit")).scalar()


def attach(
    facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", small: bool | None = None
) -> DataFrame:
    """Many-to-one join: ``dim`` has one row per key, ``how`` is left or inner.

    A small ``dim`` is broadcast after its size is measured, unless the caller
    has measured it. A large one is shuffled; the ``dim`` rows of hot keys (at most HOT_SHARE) are broadcast, and
    rows without a key never enter the shuffle.
    """
    on = list(on)
    if fits_broadcast(dim) if small is None else small:
        return facts.join(F.broadcast(dim), on, how)
    counts = key_counts(facts, on, "__n")
    hot = F.broadcast(counts.where(F.col("__n") >= hot_limit(counts, "__n")).select(*on))
    keyed = facts.dropna(subset=on)
    joined = (
        keyed.join(hot, on, "left_semi")
        .join(F.broadcast(dim.join(hot, on, "left_semi")), on, how)
        .unionByName(keyed.join(hot, on, "left_anti").join(dim, on, how))
    )
    if how == "inner":
        return joined
    missing = " or ".join(f"`{name}` is null" for name in on)
    return joined.unionByName(facts.where(missing), allowMissingColumns=True)


def deal_sides(
    left: DataFrame, right: DataFrame, on: Sequence[str], skewed: bool | None = None, key_rows: int | None = None
) -> tuple[DataFrame, DataFrame, list[str]]:
    """Both sides made ready for a many-to-many inner join, and the columns to join on.

    Where no key has more than KEY_ROWS rows or KEY_PAIRS pairs, which is measured
    unless the caller knows, the sides stay as they are. Otherwise each key beyond these
    is cut into as many salted cells as keep a cell below them. The rows of a hot key
    are dealt out by a hash of their plain columns, so a retried task deals them the
    same way. Rows of the other side are copied along the grid only for hot keys.
    ``key_rows`` states another bound, its square being that of the pairs; then nothing
    is measured first.
    """
    on = list(on)
    most_rows, most_pairs = (KEY_ROWS, KEY_PAIRS) if key_rows is None else (key_rows, float(key_rows) ** 2)
    if skewed is None:
        skewed = key_rows is not None or key_load(left, right, on).skewed
    if not skewed:
        return left, right, on
    lefts, rights = key_counts(left, on, "__nl"), key_counts(right, on, "__nr")
    nl, nr, np = F.col("__nl"), F.col("__nr"), F.col("__nl").cast("double") * F.col("__nr")
    both = lefts.join(rights, on)
    hot = both.where((nl > most_rows) | (nr > most_rows) | (np > most_pairs))
    edge = F.ceil(F.sqrt(np / most_pairs))
    hot = hot.select(
        *on,
        F.least(F.greatest(F.ceil(nl / most_rows), edge), nl).cast("int").alias("__wl"),
        F.least(F.greatest(F.ceil(nr / most_rows), edge), nr).cast("int").alias("__wr"),
    )
    # the hot keys meet each side before it is salted: broadcast, or a hot key's rows would meet in one task
    hot = materialise(hot, "hot-keys")
    if fits_broadcast(hot):
        hot = F.broadcast(hot)

    def dealt(side: DataFrame, own: str, other: str, own_cell: str, other_cell: str) -> DataFrame:
        row = F.xxhash64(*[F.col(f"`{f.name}`") for f in side.schema if not holds_map(f.dataType)])
        ways = F.coalesce(F.col(other), F.lit(1))
        return (
            side.dropna(subset=on)
            .join(hot, on, "left")
            .withColumn(own_cell, F.pmod(row, F.coalesce(F.col(own), F.lit(1)).cast("bigint")).cast("int"))
            .withColumn(other_cell, F.explode(F.sequence(F.lit(0), ways - 1)))
            .drop("__wl", "__wr")
        )

    return (
        dealt(left, "__wl", "__wr", "__cl", "__cr"),
        dealt(right, "__wr", "__wl", "__cr", "__cl"),
        [*on, "__cl", "__cr"],
    )


def pair_up(
    left: DataFrame, right: DataFrame, on: Sequence[str], skewed: bool | None = None, key_rows: int | None = None
) -> DataFrame:
    """Many-to-many inner join that holds with hot keys on either side."""
    lefts, rights, keys = deal_sides(left, right, on, skewed, key_rows)
    return lefts.join(rights, keys).drop("__cl", "__cr")


def spread(df: DataFrame, keys: Sequence[str], tasks: float = 0.0, work: float | None = None) -> DataFrame:
    """Hash-partition on the keys of a coming join or grouping whose rows are costly to work on.

    A stated number of partitions is not merged at run time by size in bytes, which
    says little about the work. ``tasks`` asks for more than the session's number;
    ``work``, the number of tasks that what is known to come can fill, for fewer, which a
    join would undo but a grouping keeps: the driver holds the metrics of every task of
    a running stage, empty ones too.
    """
    usual = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    most = usual if work is None else min(usual, max(ceil(work), 1))
    return df.repartition(max(most, ceil(tasks)), *keys)
