"""Text cleansing expressions; all of them stay in the JVM but ``to_ascii``."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F, types as T

from leadmill import fixed_values as fixed
from leadmill.functions import batches
from leadmill.functions.values import strip

MARK = "\u0001 "

def host(url: Column) -> Column:
    """Host part of a URL without scheme, one leading ``www.`` and port numbers."""
    return F.split(F.regexp_replace(strip(url), fixed.URL_NOISE, ""), "/", 2)[0]


def website(url: Column) -> Column:
    name = host(url)
    return F.when(url != "", F.when(name.startswith("www."), name).otherwise(F.concat(F.lit("www."), name)))


def domain(url: Column) -> Column:
    return F.when(url != "", F.regexp_replace(host(url), r"^www\.", ""))


def title_case(text: Column) -> Column:
    """Upper case after every character that has no case, lower case elsewhere.

    ``initcap`` starts words at blanks only, so a marked blank is set before each
    letter that follows another kind of character, and taken out again.
    """
    marked = F.regexp_replace(text, r"([^\p{Lu}\p{Ll}\p{Lt} ])(?=\p{L})", "$1" + MARK)
    return F.replace(F.initcap(marked), F.lit(MARK), F.lit(""))


def drop_legal_forms(name: Column) -> Column:
    """Cut legal forms such as Inc. or GmbH off the end of a company name."""
    forms = "|".join(re.escape(form) for form in fixed.LEGAL_FORMS)
    tail = rf"(?iU)(?:[\s,.&]+(?:{forms})\.?)+[\s,.]*$"
    cut = strip(F.regexp_replace(name, tail, ""))
    return F.when(cut != "", cut).otherwise(strip(name))


def business_name(name: Column) -> Column:
    return title_case(drop_legal_forms(name))


def drop_bracketed(text: Column) -> Column:
    """Bracketed parts, commas, hyphens and runs of blanks become one blank."""
    bare = F.regexp_replace(text, fixed.BRACKETED, " ")
    bare = F.regexp_replace(bare, fixed.SEPARATORS, " ")
    return strip(F.regexp_replace(bare, r"(?U)\s+", " "))


def word_pattern(words: Sequence[str], literal: bool) -> str | None:
    """Java pattern that finds any of the words, ignoring case."""
    if not words:
        return None
    parts = [re.escape(word) for word in words] if literal else list(words)
    return r"(?iU)\b(?:" + "|".join(parts) + r")\b"


def drop_pattern(text: Column, pattern: str | None) -> Column:
    return strip(F.regexp_replace(text, pattern, "")) if pattern else strip(text)


def clean_name(name: Column, stopwords: Sequence[str], countries: Sequence[str]) -> Column:
    """Legal forms, brackets, stopwords (patterns) and countries (plain text) removed."""
    text = drop_bracketed(business_name(name))
    text = drop_pattern(text, word_pattern(stopwords, literal=False))
    return drop_pattern(text, word_pattern(countries, literal=True))


def renamed(value: Column, names: Mapping[str, str]) -> Column:
    """Whole-value replacement; values that are not listed stay."""
    pairs = [F.lit(part) for pair in names.items() for part in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), value), value)


def job_level(value: Column, rename: bool) -> Column:
    level = renamed(value, fixed.JOB_LEVEL_NAMES) if rename else value
    return F.when(level.isin(fixed.JOB_LEVELS), level).otherwise(fixed.OTHERS)


def job_function(value: Column, by_words: bool) -> Column:
    kept = F.when(value.isin(fixed.JOB_FUNCTIONS), value).otherwise(fixed.OTHERS)
    if not by_words:
        return kept
    hits = [
        F.when(value.rlike("(?iu)" + "|".join(words)), F.lit(name))
        for name, words in fixed.JOB_FUNCTION_WORDS.items()
    ]
    return F.coalesce(*hits, kept)


_fold_batch = F.pandas_udf(batches.fold_batch, T.StringType())
_ascii_batch = F.pandas_udf(batches.ascii_batch, T.StringType())


def _only_beyond_ascii(text: Column, batch) -> Column:
    """Send only text with characters beyond ASCII through Arrow."""
    beyond = text.rlike(r"[^\x00-\x7F]")
    return F.when(beyond, batch(F.when(beyond, text))).otherwise(text)


def without_accents(text: Column) -> Column:
    return _only_beyond_ascii(text, _fold_batch)


def to_ascii(text: Column) -> Column:
    return _only_beyond_ascii(text, _ascii_batch)
