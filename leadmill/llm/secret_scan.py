"""Secrets in texts: fixed patterns, and long strings that look random.

Two character Markov models, one of random strings and one of ordinary identifiers,
are trained from labelled samples: in a bounded sample of documents, what the fixed
patterns find is labelled random, and longer words that they leave alone are labelled
ordinary. A string of 20 characters or more of the alphabet is a secret when the
log-likelihood ratio per character exceeds a threshold, whatever characters it has and
also where it holds a base span; only one that lies inside a base span adds nothing.
A doubled character that neither sample has says nothing.

Everything runs on SQL functions. Spans are code points, the end exclusive. Null text
is empty and has no spans; long texts are scanned whole. Rows keep all their columns;
the columns this module adds replace columns of the same name. An empty table gives
an empty table, and models without samples are uniform.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, functions as F

from leadmill.llm.common import whole_text

# Fixed patterns of the base rules.
KINDS = ["assign", "access", "hex", "random"]
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A run of the class that is too short hides no longer match, so the length can stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
CANDIDATE = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ORDINARY = r"[A-Za-z_][A-Za-z0-9_-]{7,}"
#: Documents, those with the smallest hashes of their ids, that the models are trained on.
SAMPLE_DOCUMENTS = 20_000
THRESHOLD = 0.7
SMOOTHING = 0.5
SPANS = "array<struct<start:int,place:int,end:int,kind:string,value:string>>"


def found(text: Column, pattern: str, kind: str) -> Column:
    """Leftmost non-overlapping matches with their places.

    The gaps between matches and the matches themselves alternate, so running sums of
    their lengths are the bounds.
    """
    pieces = F.arrays_zip(
        F.transform(F.split(text, pattern, -1), F.length).alias("gap"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
    )
    none = F.lit(None).cast(SPANS)
    empty = F.struct(F.lit(0).alias("at"), F.coalesce(none, F.array().cast(SPANS)).alias("spans"))

    def add(state: Column, piece: Column) -> Column:
        start = state["at"] + piece["gap"]
        end = start + F.coalesce(F.length(piece["match"]), F.lit(0))
        span = F.struct(
            start.alias("start"), F.lit(KINDS.index(kind)).alias("place"), end.alias("end"),
            F.lit(kind).alias("kind"), piece["match"].alias("value"),
        )
        return F.struct(end.alias("at"), F.array_append(state["spans"], span).alias("spans"))

    spans = F.filter(F.aggregate(pieces, empty, add)["spans"], lambda s: s["value"].isNotNull())
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast(SPANS))


def base_spans(text: Column) -> Column:
    assigned = F.filter(
        found(text, ASSIGN, "assign"), lambda s: F.length(F.regexp_extract(s["value"], ASSIGN, 1)) >= LEAST_VALUE
    )
    return F.array_sort(F.concat(assigned, found(text, ACCESS, "access"), found(text, HEX, "hex")))


def pair_counts(strings: DataFrame, name: str) -> DataFrame:
    """How often one character of the alphabet follows another, over distinct strings."""
    pairs = F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2)))
    distinct = strings.where(F.length("value") > 1).distinct()
    return distinct.select(F.explode(pairs).alias("pair")).groupBy("pair").agg(F.count(F.lit(1)).alias(name)).where(
        F.col("pair").rlike(r"^[A-Za-z0-9+/_=-]{2}$")
    )


def train(docs: DataFrame, sample: int = SAMPLE_DOCUMENTS) -> list[float]:
    """Log-likelihood ratios of random to ordinary by character pair, a table of fixed size."""
    ids = docs.select("doc_id").orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    some = docs.join(F.broadcast(ids.distinct()), "doc_id", "left_semi").select(whole_text().alias("text"))  # at most ``sample`` ids
    spans = some.select("text", base_spans(F.col("text")).alias("spans"))
    secret = spans.select(F.explode("spans").alias("s")).select(
        F.when(F.col("s.kind") == "assign", F.regexp_extract("s.value", ASSIGN, 1)).otherwise(F.col("s.value")).alias("value")
    )
    rest = F.aggregate("spans", F.col("text"), lambda text, s: F.replace(text, s["value"], F.lit(" ")))
    word = spans.select(F.explode(F.regexp_extract_all(rest, F.lit(ORDINARY), F.lit(0))).alias("value"))
    counts = pair_counts(secret, "n_random").join(pair_counts(word, "n_word"), "pair", "full").collect()  # at most one row per pair
    size = len(ALPHABET)
    tables = []
    for name in ("n_random", "n_word"):
        seen = {row.pair: row[name] or 0 for row in counts}
        for a in ALPHABET:
            row = [seen.get(a + b, 0) + SMOOTHING for b in ALPHABET]
            tables += [math.log(x / sum(row)) for x in row]
    half = size * size
    met = {row.pair for row in counts}
    pairs = [a != b or a + b in met for a in ALPHABET for b in ALPHABET]
    return [round(r - w, 5) if m else 0.0 for r, w, m in zip(tables[:half], tables[half:], pairs, strict=True)]


def ratio(value: Column, model: list[float]) -> Column:
    """Log-likelihood ratio per pair of a string over the alphabet."""
    # one constant the optimiser folds into an array
    table = F.split(F.lit(",".join(map(str, model))), ",").cast("array<double>")
    n = F.length(value)

    def code(i: Column) -> Column:
        return F.call_function("locate", F.substring(value, i, F.lit(1)), F.lit(ALPHABET)) - 1

    total = F.aggregate(
        F.sequence(F.lit(1), n - 1), F.lit(0.0),
        lambda acc, i: acc + F.element_at(table, (code(i) * len(ALPHABET) + code(i + 1) + 1).cast("int")),
    )
    return total / (n - 1)


def scan(docs: DataFrame, model: list[float] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with base_spans and spans: arrays of (start, place, end, kind, value) in order."""
    model = train(docs) if model is None else model
    text = whole_text()
    based = docs.withColumn("base_spans", base_spans(text))

    def random(s: Column) -> Column:
        inside = F.exists("base_spans", lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))
        return ~inside & (ratio(s["value"], model) > threshold)

    added = F.filter(found(text, CANDIDATE, "random"), random)
    return based.withColumn("spans", F.array_sort(F.concat("base_spans", added)))


def written(spans: str) -> Column:
    """kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def redact(scanned: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The texts of ``scan`` with each stretch of overlapping spans replaced by ``mark``; null texts stay null."""
    text = F.col("text")
    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def cut(state: Column, s: Column) -> Column:
        gap = F.substring(text, state["at"] + 1, s["start"] - state["at"])
        return F.when(
            s["start"] >= state["at"],
            F.struct(F.concat(state["out"], gap, F.lit(mark)).alias("out"), s["end"].alias("at")),
        ).otherwise(F.struct(state["out"].alias("out"), F.greatest(state["at"], s["end"]).alias("at")))

    def finish(state: Column) -> Column:
        return F.concat(state["out"], F.substring(text, state["at"] + 1, F.length(text)))

    clean = F.aggregate("spans", start, cut, finish)
    return scanned.withColumn("text", F.when(F.size("spans") > 0, clean).otherwise(text))
