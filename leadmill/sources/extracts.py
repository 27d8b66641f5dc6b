"""The account, opportunity, campaign, member and geography extracts.

Each is one lazy plan over a table or view: the filter and the column list reach
the scan, and the result is sorted only on request.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadmill import fixed_values as fixed
from leadmill.operators.cleanse import BusinessNameCleaner, clean_website_domain, word_list
from leadmill.operators.columns import convert_column_types, prefix_columns
from leadmill.operators.geo import GeoStandardiser, fix_country, fix_states

__all__ = [
    "accounts", "opportunities", "campaigns", "campaign_members", "countries", "states", "words",
    "geo_standardiser",
]


def _picked(alias: str, columns: Mapping[str, str]) -> list[Column]:
    return [F.col(f"{alias}.{source}").alias(name) for source, name in columns.items()]


def _filtered(df: DataFrame, filter_by: str | None) -> DataFrame:
    return df if filter_by is None else df.where(F.expr(filter_by))


def _finished(df: DataFrame, prefix: str, key: str, sort: bool) -> DataFrame:
    out = prefix_columns(df, prefix)
    return out.orderBy(prefix + key) if sort else out


def accounts(
    spark: SparkSession,
    filter_by: str | None = None,
    table: str = "Account",
    stopwords: str = "Stopwords",
    country_words: str = "Countries",
    sort: bool = False,
) -> DataFrame:
    """Accounts with cleaned web address and name; ``filter_by`` sees source names."""
    source = _filtered(spark.table(table).alias("aoa"), filter_by)
    df = source.select(*_picked("aoa", fixed.ACCOUNT_COLUMNS))
    df = clean_website_domain(df, "Website", "WebsiteClean", "DomainClean")
    cleaner = BusinessNameCleaner(spark.table(stopwords), spark.table(country_words))
    df = df.withColumn("AccountNameClean", cleaner.clean(F.col("AccountName")))
    df = convert_column_types(df, int_cols=["SIC"], float_cols=["AnnualRevenue", "NumberofEmployees"])
    return _finished(df, "SF_", "AccountId", sort)


def opportunities(
    spark: SparkSession, filter_by: str | None = None, table: str = "Opportunity", sort: bool = False
) -> DataFrame:
    """Opportunities with zone-less timestamps and the created date 13 months back."""
    source = _filtered(spark.table(table).alias("opp"), filter_by)
    df = source.select(*_picked("opp", fixed.OPPORTUNITY_COLUMNS))
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in fixed.OPPORTUNITY_DATES})
    earlier = F.col("CreatedDate") - F.make_ym_interval(months=F.lit(fixed.ADJUSTED_CREATED_MONTHS))
    df = df.withColumn(fixed.ADJUSTED_CREATED_COLUMN, earlier.cast("timestamp_ntz"))
    df = convert_column_types(
        df, int_cols=["ACVNewExpandConverted"], category_cols=fixed.OPPORTUNITY_CATEGORIES
    )
    return _finished(df, "OPP_", "OpportunityId", sort)


def campaigns(
    spark: SparkSession, filter_by: str | None = None, table: str = "Campaign", sort: bool = False
) -> DataFrame:
    source = _filtered(spark.table(table).alias("cm"), filter_by)
    df = source.select(*_picked("cm", fixed.CAMPAIGN_COLUMNS))
    df = convert_column_types(df, category_cols=fixed.CAMPAIGN_CATEGORIES)
    return _finished(df, "CMP_", "CampaignId", sort)


def campaign_members(
    spark: SparkSession,
    filter_by: str | None = None,
    table: str = "CampaignMember",
    contacts: str = "ContactLead",
    sort: bool = False,
) -> DataFrame:
    """Campaign members with their contact; members without one are kept."""
    member, contact = spark.table(table).alias("cm"), spark.table(contacts).alias("cnct")
    same = F.col(f"cnct.{fixed.CONTACT_KEY}") == F.col(f"cm.{fixed.MEMBER_CONTACT_KEY}")
    source = _filtered(member.join(contact, same, "left"), filter_by)
    df = source.select(*_picked("cm", fixed.MEMBER_COLUMNS), *_picked("cnct", fixed.CONTACT_COLUMNS))
    df = df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in fixed.MEMBER_DATES})
    df = convert_column_types(df, int_cols=fixed.MEMBER_INTEGERS, category_cols=fixed.MEMBER_CATEGORIES)
    return _finished(df, "CM_", "MemberId", sort)


def countries(spark: SparkSession, table: str = "Geo_Country") -> DataFrame:
    source = spark.table(table).alias("geo")
    return fix_country(source.select(*_picked("geo", fixed.COUNTRY_COLUMNS)))


def states(spark: SparkSession, table: str = "Geo_States") -> DataFrame:
    source = spark.table(table).alias("geo")
    return fix_states(source.select(*_picked("geo", fixed.STATE_COLUMNS)))


def words(spark: SparkSession, table: str) -> list[str]:
    return word_list(spark.table(table))


def geo_standardiser(
    spark: SparkSession, country_table: str = "Geo_Country", state_table: str = "Geo_States"
) -> GeoStandardiser:
    return GeoStandardiser(countries(spark, country_table), states(spark, state_table))
