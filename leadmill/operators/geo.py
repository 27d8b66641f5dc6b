"""Country, state and city names brought to the spelling of a dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from leadmill import fixed_values as fixed
from leadmill.functions import text
from leadmill.functions.values import quoted, strip
from leadmill.operators.joins import attach


def fix_country(df: DataFrame, column: str = "Name") -> DataFrame:
    return df.withColumn("CountryName", text.renamed(quoted(column), fixed.COUNTRY_NAMES))


def fix_states(df: DataFrame, column: str = "Name") -> DataFrame:
    return df.withColumn("StateName", text.renamed(quoted(column), fixed.STATE_NAMES))


def drop_state_words(df: DataFrame, column: str = "State_Name") -> DataFrame:
    """The earlier rule: kinds of districts are cut out of the name, blanks stay."""
    return df.withColumn(column, F.regexp_replace(quoted(column), "|".join(fixed.STATE_WORDS), ""))


def add_english_name(df: DataFrame, column: str = "Name", into: str = "Name_Eng") -> DataFrame:
    return df.withColumn(into, text.to_ascii(quoted(column)))


def lookup_table(
    dim: DataFrame, target: str, columns: Sequence[str], order_by: str | None, trim: bool
) -> DataFrame:
    """One row per spelling: the name it stands for and the exact names spelled so.

    Where spellings clash the later column wins, then the later row.
    """
    def key(column: str) -> Column:
        lowered = F.lower(quoted(column))
        return strip(lowered) if trim else lowered

    place = quoted(order_by) if order_by else quoted(target)
    spellings = F.inline(
        F.array(
            *[
                F.struct(
                    key(c).alias("__key"),
                    quoted(target).alias("__name"),
                    F.struct(F.lit(rank).alias("rank"), place.alias("place"), quoted(target).alias("n")).alias("__rank"),
                    F.when(F.lit(c == target), quoted(target)).alias("__exact"),
                )
                for rank, c in enumerate(columns)
            ]
        )
    )
    return (
        dim.select(spellings)
        .where("__key is not null")
        .groupBy("__key")
        .agg(F.max_by("__name", "__rank").alias("__name"), F.collect_set("__exact").alias("__exact"))
    )


def standardise(
    df: DataFrame,
    column: str,
    lookup: DataFrame,
    trim: bool,
    clean: str,
    valid: str | None,
    clean_valid: str,
    keep_unknown: bool,
) -> DataFrame:
    """Look a column up once and add the standard name and its 0/1 flags.

    A hit is always a valid name, and a valid name is always a hit, so one join
    answers all three columns.
    """
    raw = quoted(column)
    key = F.lower(strip(raw)) if trim else F.lower(raw)
    found = attach(df.withColumn("__key", key), lookup, ["__key"])
    name = F.coalesce(F.col("__name"), strip(raw)) if keep_unknown else F.col("__name")
    added = {clean: name}
    if valid:
        added[valid] = F.coalesce(F.array_contains("__exact", raw).cast("bigint"), F.lit(0).cast("bigint"))
    added[clean_valid] = F.col("__name").isNotNull().cast("bigint")
    return found.withColumns(added).drop("__key", "__name", "__exact")


class GeoStandardiser:
    """Countries and states against their dimension tables."""

    def __init__(self, countries: DataFrame, states: DataFrame, order_by: str = "Id"):
        self.countries = add_english_name(countries)
        self.states = add_english_name(states)
        self._country = lookup_table(self.countries, "CountryName", fixed.COUNTRY_LOOKUP, order_by, trim=True)
        self._state = lookup_table(self.states, "StateName", fixed.STATE_LOOKUP, order_by, trim=True)

    def standardise_country(self, df: DataFrame, column: str) -> DataFrame:
        return self._standardise(df, column, self._country)

    def standardise_state(self, df: DataFrame, column: str) -> DataFrame:
        return self._standardise(df, column, self._state)

    @staticmethod
    def _standardise(df: DataFrame, column: str, lookup: DataFrame) -> DataFrame:
        return standardise(
            df, column, lookup, True, f"{column}Clean", f"{column}Valid", f"{column}CleanValid", keep_unknown=True
        )


def standardize_countries(df: DataFrame, dim: DataFrame, column: str, order_by: str | None = None) -> DataFrame:
    """The earlier rule: no trimming, unknown names become null."""
    lookup = lookup_table(dim, "CountryName", fixed.OLD_COUNTRY_LOOKUP, order_by, trim=False)
    return standardise(
        df, column, lookup, False, "StandardizedCountry", "ValidCountry", "ValidStandardizedCountry", False
    )


def standardize_states(df: DataFrame, dim: DataFrame, column: str, order_by: str | None = None) -> DataFrame:
    lookup = lookup_table(dim, "State_Name", fixed.OLD_STATE_LOOKUP, order_by, trim=False)
    return standardise(df, column, lookup, False, "StandardizedState", "ValidState", "ValidStandardizedState", False)


def standardize_cities(df: DataFrame, dim: DataFrame, column: str, order_by: str | None = None) -> DataFrame:
    lookup = lookup_table(dim, "City_Name", fixed.OLD_CITY_LOOKUP, order_by, trim=False)
    return standardise(df, column, lookup, False, "StandardizedCity", None, "ValidStandardizedCity", False)
