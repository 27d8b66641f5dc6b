"""Cleansing of web addresses, company names and jobs on whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadmill import fixed_values as fixed
from leadmill.functions import text
from leadmill.functions.values import quoted

MOST_WORDS = 50_000


def clean_website_domain(df: DataFrame, url: str, website: str, domain: str) -> DataFrame:
    return df.withColumns({website: text.website(quoted(url)), domain: text.domain(quoted(url))})


def word_list(df: DataFrame, column: str = fixed.WORD_LIST_COLUMN) -> list[str]:
    """A small one-column dimension on the driver, longer words first; one that is too long is refused."""
    rows = df.select(quoted(column).alias("w")).where("w is not null").limit(MOST_WORDS + 1).collect()
    if len(rows) > MOST_WORDS:
        raise ValueError(f"a word list holds at most {MOST_WORDS} words")
    return sorted((row.w for row in rows), key=lambda w: (-len(w), w))


class BusinessNameCleaner:
    """Company-name cleansing with a stopword and a country table, each read once."""

    def __init__(self, stopwords: DataFrame, countries: DataFrame, column: str = fixed.WORD_LIST_COLUMN):
        self.stopwords = word_list(stopwords, column)
        self.countries = word_list(countries, column)

    def clean(self, name: Column) -> Column:
        return text.clean_name(name, self.stopwords, self.countries)


def fix_job_level(df: DataFrame, column: str, rename: bool) -> DataFrame:
    return df.withColumn(column, text.job_level(quoted(column), rename))


def fix_job_function(df: DataFrame, column: str, by_words: bool) -> DataFrame:
    filled = F.coalesce(quoted(column), F.lit(fixed.OTHERS))
    return df.withColumn(column, text.job_function(filled, by_words))
