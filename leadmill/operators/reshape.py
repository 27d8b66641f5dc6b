"""Wide rows to several rows, and frames put together."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.functions import values as V
from leadmill.functions.values import quoted


def source_of(column: str) -> str:
    return column.split("_", 1)[0]


def split_rows(
    df: DataFrame, index_column: str, mapping: Mapping[str, Sequence[str]], datasets: int = 2
) -> DataFrame:
    """One row per source: each key's column, then its counterparts, under the key's name.

    A column that the table lacks gives 0.
    """
    first = next(iter(mapping))
    sources = [first, *mapping[first][: datasets - 1]]

    def cell(key: str, place: int) -> Column:
        chain = [key, *mapping[key][: datasets - 1]]
        kinds = [V.data_type(df, c) for c in chain if c in df.columns]
        kind = kinds[0] if kinds else "bigint"
        return (quoted(chain[place]) if chain[place] in df.columns else F.lit(0)).cast(kind).alias(key)

    rows = [
        F.struct(
            quoted(index_column).alias("GroupID"),
            F.lit(source_of(source)).alias("Source"),
            *[cell(key, place) for key in mapping],
        )
        for place, source in enumerate(sources)
    ]
    return df.select(F.inline(F.array(*rows)))


def split_dataframe(df: DataFrame, index_column: str, mapping: Mapping[str, str]) -> DataFrame:
    """One wide row to two rows, one per source."""
    return split_rows(df, index_column, {key: [value] for key, value in mapping.items()})


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def side_by_side(frames: Sequence[DataFrame], key: str) -> DataFrame:
    """Full outer alignment on a key that is unique in every frame.

    One union and one aggregation whatever the number of frames; a repeated key
    fails the job.
    """
    tagged = []
    for place, frame in enumerate(frames):
        row = F.struct(*[quoted(c) for c in frame.columns if c != key])
        tagged.append(frame.select(quoted(key), row.alias(f"__f{place}")))
    cells = [f"__f{place}" for place in range(len(frames))]
    wide = union_all(tagged).groupBy(quoted(key)).agg(
        *[F.max(c).alias(c) for c in cells], *[F.count(c).alias(f"{c}n") for c in cells]
    )
    once = reduce(lambda a, b: a & b, [F.col(f"{c}n") <= 1 for c in cells])
    columns = [
        F.col(place).getField(c).alias(c)
        for place, frame in zip(cells, frames)
        for c in frame.columns
        if c != key
    ]
    kept = F.when(once, quoted(key)).otherwise(F.raise_error(F.lit(f"{key} is not unique")))
    return wide.select(kept.cast(V.data_type(frames[0], key)).alias(key), *columns)
