"""URL filters by association rules, below fixed host rules.

A URL becomes a set of tokens: its scheme, the words of its host, the last three
labels of it, the words of its path, an extension among them, and the names of its parameters. FP-growth mines
combinations of tokens of any length from labelled URLs, with the label as one more token. A rule
"tokens make a URL bad" stays when enough URLs support it, when it is right often
enough, and when no shorter rule that it contains is as right. Rules match through an
inverted index: a rule is filed under its rarest token, and a URL that has this token
is checked for the others.

Everything runs on SQL functions and Spark's own FP-growth. Null URLs, and URLs
without "://", have an empty host and path and no tokens; nothing blocks them. Every
row is judged, repeated rows too, and keeps page_id and url alone. Tables may be empty;
without rules everything is allowed.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from leadmill.llm.common import partitions
from leadmill.session import materialise

# Fixed host rules: (host, path, verdict).
HOST_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]
BAD = "label:bad"
MIN_SUPPORT = 0.002
#: Labelled URLs that a rule needs at least, whatever share they are.
LEAST_URLS = 20
MIN_CONFIDENCE = 0.6
MIN_LIFT = 2.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_rule(host: Column, path: Column) -> Column:
    """struct<rule, verdict> of the longest fixed rule that fits, else null."""
    fit = F.lit(None).cast("struct<rule:string,verdict:string>")
    for name, start, verdict in sorted(HOST_RULES, key=lambda r: len(r[0] + r[1])):
        inside = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        fit = F.when(inside, F.struct(F.lit(name + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(fit)
    return fit


def tokens(url: Column) -> Column:
    """Distinct tokens; numbers are left out, since they name one page."""
    labels = F.split(host(url), r"\.")
    site = F.slice(labels, F.greatest(F.size(labels) - 2, F.lit(1)), F.lit(3))
    query = F.regexp_extract(url, r"\?([^#]*)", 1)
    parts = [
        F.array(F.concat(F.lit("scheme:"), F.translate(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1), UPPER, LOWER))),
        F.transform(F.filter(F.flatten(F.transform(labels, lambda x: F.split(x, "-"))), lambda x: x != ""), lambda x: F.concat(F.lit("host:"), x)),
        F.array(F.concat(F.lit("site:"), F.array_join(site, "."))),
        F.transform(F.regexp_extract_all(path(url), F.lit(r"([\p{L}_-]*\p{L}[\p{L}_-]*)"), F.lit(1)), lambda x: F.concat(F.lit("path:"), F.lower(x))),
        F.transform(F.regexp_extract_all(query, F.lit(r"(?:^|&)([^=&]+)"), F.lit(1)), lambda x: F.concat(F.lit("query:"), x)),
    ]
    return F.when(host(url) != "", F.array_distinct(F.concat(*parts))).otherwise(F.array().cast("array<string>"))


def mine(labelled: DataFrame, support: float = MIN_SUPPORT, confidence: float = MIN_CONFIDENCE, lift: float = MIN_LIFT) -> DataFrame:
    """(tokens, support, confidence, lift) of the rules that make a URL bad, from rows (url, bad)."""
    spark = labelled.sparkSession
    items = labelled.select(F.when(F.col("bad"), F.array_append(tokens(F.col("url")), F.lit(BAD))).otherwise(tokens(F.col("url"))).alias("items"))
    items = items.where(F.size("items") > 0)
    n = items.count()
    support = min(1.0, max(support, LEAST_URLS / n)) if n else 1.0
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=partitions(spark)).fit(items)
    rules = model.associationRules.where(
        (F.array_contains("consequent", BAD)) & (F.col("lift") >= lift)
    ).select(F.array_sort("antecedent").alias("tokens"), "support", "confidence", "lift")
    rules = materialise(rules, "rules")
    whole = rules.alias("r")
    shorter = rules.select(F.col("tokens").alias("part"), F.col("confidence").alias("as_right"), F.explode("tokens").alias("token"))
    covered = (
        whole.withColumn("token", F.explode("tokens")).join(shorter, "token")
        .where((F.size("part") < F.size("tokens")) & (F.size(F.array_intersect("part", "tokens")) == F.size("part")) & (F.col("as_right") >= F.col("confidence")))
        .select("tokens").distinct()
    )
    return rules.join(covered, "tokens", "left_anti")


def index(rules: DataFrame, pages: DataFrame) -> DataFrame:
    """(token, rule): each rule under the token that the fewest of the given URLs have."""
    needed = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = pages.select(F.explode(tokens(F.col("url"))).alias("token")).join(needed, "token", "left_semi").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = rules.withColumn("token", F.explode("tokens")).join(seen, "token", "left").groupBy("tokens").agg(
        F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token"),
        F.max(F.struct("confidence", "support", F.array_join("tokens", " ").alias("named"))).alias("rule"),
    )
    return filed.select("token", "tokens", "rule")


def judge(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """(page_id, url, host, path, rule, verdict, learned, confidence), a row for each row of ``pages``.

    Equal rows are judged once and given back as often as they came.
    """
    filed = materialise(index(rules, pages), "rule_index")
    url = F.col("url")
    once = pages.select("page_id", "url").groupBy("page_id", "url").agg(F.count(F.lit(1)).alias("times"))
    has = tokens(url)
    entries = once.withColumn("has", has).withColumn("token", F.explode_outer("has"))
    met = entries.join(filed, "token", "left")
    fits = F.when(F.size(F.array_intersect("tokens", "has")) == F.size("tokens"), F.col("rule"))
    best = met.groupBy("page_id", "url", "times").agg(F.max(fits).alias("best"))
    named = best.withColumn("host", host(url)).withColumn("path", path(url)).withColumn("fixed", host_rule(F.col("host"), F.col("path")))
    judged = named.select(
        "page_id", "url", "host", "path", F.col("fixed.rule").alias("rule"),
        F.coalesce(F.col("fixed.verdict"), F.when(F.col("best").isNotNull(), "block").otherwise("allow")).alias("verdict"),
        F.col("best.named").alias("learned"), F.col("best.confidence").alias("confidence"), "times",
    )
    return judged.withColumn("times", F.explode(F.sequence(F.lit(1), F.col("times")))).drop("times")


def labelled_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(url, bad) of the pages that show a labelled document, whose number is the first in the URL's path."""
    shown = pages.where("url is not null").select(
        F.col("url"), F.expr(r"try_cast(regexp_extract(url, '://[^/?#]*/(?:[^0-9?#]*/)?([0-9]+)', 1) as bigint)").alias("doc_id")
    ).where("doc_id is not null")
    bad = labels.groupBy("doc_id").agg(F.max((F.col("quality") == 0) | (F.col("toxic") == 1)).alias("bad"))
    return shown.join(bad.where("bad is not null"), "doc_id").select("url", "bad")
