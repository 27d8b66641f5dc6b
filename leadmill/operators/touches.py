"""Campaign touches by sales stage and the channels that lead them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadmill import fixed_values as fixed
from leadmill.functions import values as V
from leadmill.functions.values import quoted
from leadmill.operators.columns import drop_duplicates
from leadmill.operators.joins import pair_up


BUCKET_DAYS = 30


def members_with_opportunities(
    members: DataFrame, opportunities: DataFrame, within_opportunity: bool = False, key_rows: int | None = None
) -> DataFrame:
    """Campaign members beside the opportunities of their account.

    ``within_opportunity`` keeps responses between opening and closing. Then both
    sides meet on account and time bucket, so an account with very many members
    and opportunities pairs only rows of the same months. ``key_rows`` as in ``deal_sides``.
    """
    account = F.col("CM_AccountId").alias("__account"), F.col("OPP_AccountId").alias("__account")
    if not within_opportunity:
        pairs = pair_up(
            members.select("*", account[0]), opportunities.select("*", account[1]), ["__account"], key_rows=key_rows
        )
        return pairs.drop("__account")
    answered, opened, closed = F.col(fixed.RESPONDED), F.col(fixed.OPENED), F.col(fixed.CLOSED)
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")

    def bucket(moment: Column) -> Column:
        return F.floor(V.days_between(epoch, moment) / BUCKET_DAYS)

    # no bucket beyond the responses is needed, however long an opportunity stays open
    low, high = members.agg(F.min(bucket(answered)), F.max(bucket(answered))).first()
    first, last = F.greatest(bucket(opened), F.lit(low or 0)), F.least(bucket(closed), F.lit(high or 0))
    live = opportunities.where((opened <= closed) & (first <= last))
    met = pair_up(
        members.select("*", account[0], bucket(answered).alias("__bucket")),
        live.select("*", account[1], F.explode(F.sequence(first, last)).alias("__bucket")),
        ["__account", "__bucket"],
        key_rows=key_rows,
    )
    return met.where(answered.between(opened, closed)).drop("__account", "__bucket")


def campaign_touch_by_stage(
    df: DataFrame,
    unique_activity: bool = False,
    within_opportunity: bool = False,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """0/1 flags per stage for responses between two stage dates, and their number.

    The first stage includes its opening date, the others do not.
    """
    answered = F.col(fixed.RESPONDED)
    flags = {}
    for place, (name, (opens, closes)) in enumerate(fixed.TOUCH_STAGES.items()):
        after = answered >= F.col(opens) if place == 0 else answered > F.col(opens)
        flags[name] = V.flag(after & (answered <= F.col(closes)))
    df = df.withColumns(flags)
    df = df.withColumn(fixed.TOUCH_COUNT, V.null_safe_sum([F.col(f) for f in flags]))
    if unique_activity:
        df = drop_duplicates(df, [fixed.MEMBER_ID, fixed.TOUCH_COUNT], order_by)
    if within_opportunity:
        df = df.where(answered.between(F.col(fixed.OPENED), F.col(fixed.CLOSED)))
    return df


def stage_counts(df: DataFrame, keys: Sequence[str], flags: Sequence[str]) -> DataFrame:
    """(stage, keys, n) with the rows whose flag is set.

    All flags are counted in one aggregation before the table is turned, so no
    input row is copied per stage.
    """
    keep = df.where(" and ".join(f"`{k}` is not null" for k in keys))
    wide = keep.groupBy(*map(quoted, keys)).agg(
        *[F.count_if(quoted(f) > 0).alias(f"__{i}") for i, f in enumerate(flags)]
    )
    entries = F.array(
        *[F.struct(F.lit(f).alias("stage"), F.col(f"__{i}").alias("n")) for i, f in enumerate(flags)]
    )
    return wide.select(*map(quoted, keys), F.inline(entries)).where("n > 0")


def ranked_channels(df: DataFrame, stages: Sequence[str], group: Sequence[str], top: int) -> DataFrame:
    counts = stage_counts(df, [*group, fixed.CHANNEL], [f"{s}Touch" for s in stages])
    order = Window.partitionBy("stage", *map(quoted, group)).orderBy(F.col("n").desc(), F.col(fixed.CHANNEL).asc())
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def beside(ranked: DataFrame, stages: Sequence[str], keys: Sequence[str], counts: bool) -> DataFrame:
    """Stages side by side, aligned on rank; shorter lists end in null."""
    cells = []
    for s in stages:
        here = F.col("stage") == f"{s}Touch"
        cells.append(F.max(F.when(here, F.col(fixed.CHANNEL))).alias(f"{s}_Channels"))
        if counts:
            cells.append(F.max(F.when(here, F.col("n"))).alias(f"{s}_Count"))
    return ranked.groupBy(*map(quoted, keys), "rank").agg(*cells)


def top_channels_by_stage(df: DataFrame, stages: Sequence[str], top: int = 5) -> DataFrame:
    ranked = ranked_channels(df, stages, [], top)
    return beside(ranked, stages, [], counts=False).orderBy("rank")


def top_channels_by_stage_and_value(df: DataFrame, column: str, stages: Sequence[str], top: int = 5) -> DataFrame:
    """The same for each value of a column, in one job."""
    ranked = ranked_channels(df, stages, [column], top)
    return beside(ranked, stages, [column], counts=False).orderBy(quoted(column), "rank")


def top_channels_by_stage_and_group(df: DataFrame, column: str, stages: Sequence[str], top: int = 5) -> DataFrame:
    """The same with counts; gaps are blank channels and counts of 0."""
    ranked = ranked_channels(df, stages, [column], top)
    table = beside(ranked, stages, [column], counts=True)
    filled = table.na.fill("", [f"{s}_Channels" for s in stages]).na.fill(0, [f"{s}_Count" for s in stages])
    return filled.orderBy(quoted(column).desc(), "rank")
