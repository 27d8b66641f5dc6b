"""Quality rules from how a public tokenizer copes with a text.

For each document the words are tokenised: characters per token, the share of byte
fallback tokens, the share of tokens without a letter, and the entropy of its tokens,
beside plain counts of symbols, repeated lines and repeated three-word windows. Every
language gets a band per measure from its own documents, the median with a tolerance in
interquartile ranges that narrows with the number of words; a document with a measure
outside its language's band is rejected. The tolerances of a language are fitted on
all its labelled documents, measure by measure so that the fewest are judged
wrongly; a language with few labels has those of BANDS.

Null and empty texts have no words and fail the plain rules. Null languages are a
language of their own. Repeated rows are judged alike. Texts are worked on whole, in
runs of bounded size; only counts leave the task. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from leadmill.llm.common import Cache, runs_of, vocabulary, whole_text, worker_value
from leadmill.session import materialise

VOCABULARY = "piece_bpe_32k.model"
SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\r\x0b\x0c"
MIN_WORDS = 50
MOST_REPEATED = 50
#: Tolerance below and above the median in interquartile ranges, per measure; None leaves a side open.
BANDS = {"chars_per_token": (3.5, 6.0), "byte_share": (None, 6.0), "bare_share": (None, 3.0), "entropy_ratio": (3.5, None)}
#: Labelled documents that tolerances are fitted on, the least per language and label.
LEAST_LABELS = 20
#: Smallest interquartile range that counts, so that a uniform corpus rejects nothing for a trifle.
LEAST_RANGE = {"chars_per_token": 0.5, "byte_share": 0.5, "bare_share": 0.5, "entropy_ratio": 0.5}
#: A mean over few words varies more: deviations count times the root of the words, up to this many.
STEADY_WORDS = 800
#: Words from which the measures say something.
BAND_WORDS = 50
COUNTS = [
    ("n_words", "bigint"), ("word_chars", "bigint"), ("n_symbols", "bigint"), ("n_dup_lines", "bigint"), ("n_repeat_words", "bigint"),
    ("n_pieces", "bigint"), ("byte_share", "double"), ("bare_share", "double"), ("entropy", "double"),
]


def repeated_words(words: list[bytes]) -> int:
    """Words in three-word windows that occur at least twice, their first occurrence included."""
    n = len(words) - 2
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    code = np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)
    pair = np.unique(code[:-1] * len(numbers) + code[1:], return_inverse=True)[1]
    _, window, times = np.unique(pair[:-1] * len(numbers) + code[2:], return_inverse=True, return_counts=True)
    twice = times[window] > 1
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift : shift + n] |= twice
    return int(covered.sum())


def repeated_lines(text: bytes) -> int:
    lines = [line for line in text.split(b"\n") if line.strip(SPACE)]
    return len(lines) - len(set(lines))


def word_pieces(path: str) -> tuple[Cache, np.ndarray, np.ndarray]:
    """Piece ids of a word as 32-bit bytes, which ids are byte fallbacks, and which others have no letter."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    fallback = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
    bare = ~fallback & np.array([not any(map(str.isalpha, model.id_to_piece(i))) for i in range(model.get_piece_size())])

    def encode(words: list[bytes]) -> list[bytes]:
        return [np.array(ids, "<u4").tobytes() for ids in model.encode([w.decode() for w in words], num_threads=1)]

    return Cache(encode, 500_000), fallback, bare


def measure(docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id", "lang")) -> DataFrame:
    """The columns ``keep`` and the counts of each text, one row per row, without a shuffle."""
    path = path or vocabulary(VOCABULARY)
    counts = [T.StructField(n, T.LongType() if k == "bigint" else T.DoubleType()) for n, k in COUNTS]
    shape = T.StructType([docs.schema[c] for c in keep] + counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, fallback, bare = worker_value(("quality", path), lambda: word_pieces(path))
        for batch in batches:
            texts = batch.column(len(keep)).cast(pa.binary())
            for a, b in runs_of((len(t.as_buffer()) for t in texts), 4 << 20):
                some = texts.slice(a, b - a).to_pylist()
                split = [text.split() for text in some]
                cache.learn(w for words in split for w in words)
                rows = []
                for text, words in zip(some, split, strict=True):
                    solid = b"".join(words)
                    ids = np.frombuffer(b"".join(map(cache.__getitem__, words)), "<u4")
                    times = np.unique(ids, return_counts=True)[1] / max(1, len(ids))
                    rows.append((
                        len(words), len(solid.decode()), len(solid) - len(solid.translate(None, SYMBOLS)), repeated_lines(text),
                        repeated_words(words), len(ids), float(fallback[ids].mean()) if len(ids) else 0.0,
                        float(bare[ids].mean()) if len(ids) else 0.0,
                        float(-(times * np.log2(times)).sum()) if len(ids) else 0.0,
                    ))
                columns = [pa.array(c, pa.int64() if k == "bigint" else pa.float64()) for c, (_, k) in zip(zip(*rows, strict=True), COUNTS, strict=True)]
                kept = [batch.column(i).slice(a, b - a) for i in range(len(keep))]
                yield pa.record_batch([*kept, *columns], names=[*keep, *(n for n, _ in COUNTS)])

    return docs.select(*keep, whole_text().alias("__text")).mapInArrow(run, shape)


def with_measures(measured: DataFrame) -> DataFrame:
    """Fertility measures from the counts; entropy is set against what as many tokens could have."""
    return measured.withColumns({
        "chars_per_token": F.when(F.col("n_pieces") > 0, F.col("word_chars") / F.col("n_pieces")),
        "entropy_ratio": F.when(F.col("n_pieces") > 1, F.col("entropy") / F.log2(F.col("n_pieces").cast("double"))),
    })


def steadiness() -> Column:
    return F.sqrt(F.least("n_words", F.lit(STEADY_WORDS)).cast("double"))


def bands(measured: DataFrame, by: str = "lang") -> DataFrame:
    """(language, and per measure its median and spread), from all its documents of BAND_WORDS words or more.

    The spread is the interquartile range of the deviations times the root of the words.
    """
    seen = with_measures(measured).where((F.col("n_words") >= BAND_WORDS) & ~plainly_bad())
    medians = seen.groupBy(F.col(by).alias("__by")).agg(*[F.percentile_approx(n, 0.5, 1000).alias(f"{n}_median") for n in BANDS])
    apart = seen.join(medians, F.col(by).eqNullSafe(F.col("__by"))).groupBy("__by").agg(
        *[F.first(f"{n}_median").alias(f"{n}_median") for n in BANDS],
        *[F.percentile_approx((F.col(n) - F.col(f"{n}_median")) * steadiness(), [0.25, 0.75], 1000).alias(n) for n in BANDS],
    )
    return apart.select(
        "__by", *[f"{n}_median" for n in BANDS],
        *[F.greatest(F.col(n)[1] - F.col(n)[0], F.lit(LEAST_RANGE[n])).alias(f"{n}_spread") for n in BANDS],
    )


def plainly_bad() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def deviation(name: str) -> Column:
    return (F.col(name) - F.col(f"{name}_median")) * steadiness() / F.col(f"{name}_spread")


#: What a tolerance bounds, per measure and side: names are columns of ``tolerances``.
SIDES = [(f"{name}_{side}", name, sign, usual) for name, band in BANDS.items() for side, sign, usual in zip(("below", "above"), (-1, 1), band, strict=True) if usual is not None]
#: The order in which tolerances are fitted; what one measure rejects is settled for the next.
FITTED = sorted(SIDES, key=lambda s: s[1] != "bare_share")


def fitted(left: DataFrame, column: str, usual: float) -> DataFrame:
    """(language, cut): the tolerance that judges the fewest of all rows wrongly, the usual one or else the nearest to it.

    The distinct values are range-partitioned and sorted; running counts within a part and
    those of the parts before it give what a cut between two neighbours leaves in and out.
    """
    total = {"bad": F.sum(F.col("bad").cast("bigint")), "good": F.sum((~F.col("bad")).cast("bigint"))}
    counts = left.groupBy("__lang", F.col(column).alias("off")).agg(*[t.alias(n) for n, t in total.items()])
    placed = materialise(counts.repartitionByRange("__lang", "off").withColumn("part", F.spark_partition_id()), "offs")
    own, before = Window.partitionBy("__lang"), Window.partitionBy("__lang").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = placed.groupBy("__lang", "part").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"), F.max("off").alias("last"))
    parts = ends.select(  # a row per part and language
        F.col("__lang").alias("__of"), F.col("part").alias("__part"), F.max("last").over(before).alias("earlier"), F.sum("good").over(own).alias("goods"),
        *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_before") for n in ("bad", "good")],
    )
    line = Window.partitionBy("__lang", "part").orderBy("off")
    below = {n: F.coalesce(F.sum(n).over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.col(f"{n}_before") for n in ("bad", "good")}
    met = placed.join(F.broadcast(parts), F.col("__lang").eqNullSafe(F.col("__of")) & (F.col("part") == F.col("__part")))
    previous = F.coalesce(F.lag("off").over(line), "earlier")
    between = met.select("__lang", F.coalesce((previous + F.col("off")) / 2, F.col("off") - 1).alias("cut"), (below["bad"] + F.col("goods") - below["good"]).alias("wrong"))
    above = ends.groupBy("__lang").agg((F.max("last") + 1).alias("cut"), F.sum("bad").alias("wrong"))
    kept = F.sum((F.col("bad") == (F.col(column) <= usual)).cast("bigint")).alias("wrong")  # bad ones inside, good ones outside
    cuts = between.unionByName(above).where("cut > 0").unionByName(left.groupBy("__lang").agg(F.lit(usual).alias("cut"), kept))
    return cuts.groupBy("__lang").agg(F.min(F.struct("wrong", F.abs(F.col("cut") - usual).alias("apart"), "cut"))["cut"].alias("cut"))


def tolerances(met: DataFrame, labels: DataFrame, by: str, key: Column) -> DataFrame:
    """(language, and per measure and side its tolerance) of languages with enough labels, from measured rows with bands."""
    known = labels.where("doc_id is not null and quality is not null").groupBy(F.col("doc_id").alias("__doc_id")).agg(F.min("quality").alias("__quality"))
    offs = [F.coalesce(sign * deviation(name), F.lit(0.0)).alias(column) for column, name, sign, _ in SIDES]
    seen = met.where((F.col("n_words") >= BAND_WORDS) & ~plainly_bad() & F.col("__by_known")).withColumn("__doc_id", key).join(known, "__doc_id")
    rows = seen.dropDuplicates(["__doc_id"]).select(F.col(by).alias("__lang"), (F.col("__quality") == 0).alias("bad"), *offs)
    left = materialise(rows, "labelled")
    least = F.least(F.sum(F.col("bad").cast("bigint")), F.sum((~F.col("bad")).cast("bigint"))) >= LEAST_LABELS
    found = left.groupBy("__lang").agg(least.alias("enough")).where("enough").select("__lang")
    left = _of_language(left, found)
    for column, _, _, usual in FITTED:
        cut = materialise(fitted(left, column, usual), "cuts")
        found = materialise(_of_language(found, cut, "left").withColumn(column, F.coalesce("cut", F.lit(usual))).drop("cut"), "tolerances")
        left = materialise(_of_language(left, cut).where(F.col(column) <= F.col("cut")).drop("cut"), "labelled")
    return found.select("__lang", *[column for column, *_ in SIDES])


def _of_language(rows: DataFrame, languages: DataFrame, how: str = "inner") -> DataFrame:
    """Rows beside the row of their language, null being one."""
    return rows.join(F.broadcast(languages.withColumnRenamed("__lang", "__of")), F.col("__lang").eqNullSafe(F.col("__of")), how).drop("__of")


def judge(measured: DataFrame, by: str = "lang", labels: DataFrame | None = None, key: Column | None = None) -> DataFrame:
    """Adds base_failed and kept to stored counts, which are read a few times; ``key`` is the doc_id that labels name."""
    limits = materialise(bands(measured, by), "bands")  # its size is known, so a small one is broadcast
    met = with_measures(measured).join(limits, F.col(by).eqNullSafe(F.col("__by")), "left")
    met = met.withColumn("__by_known", F.col(f"{SIDES[0][1]}_median").isNotNull())
    if labels is None:
        met = met.withColumns({column: F.lit(usual) for column, _, _, usual in SIDES})
    else:
        own = tolerances(met, labels, by, F.col("doc_id") if key is None else key)
        met = met.join(F.broadcast(own), F.col(by).eqNullSafe(F.col("__lang")), "left").drop("__lang")  # a row per language
        met = met.withColumns({column: F.coalesce(column, F.lit(usual)) for column, _, _, usual in SIDES})
    inside = F.lit(True)
    for column, name, sign, _ in SIDES:
        inside = inside & F.coalesce(sign * deviation(name) <= F.col(column), F.lit(True))
    return met.withColumn("base_failed", plainly_bad()).withColumn(
        "kept", ~F.col("base_failed") & (inside | (F.col("n_words") < BAND_WORDS))
    ).drop("__by", "__by_known", *(column for column, *_ in SIDES))


def quality(
    docs: DataFrame, path: str | None = None, keep: tuple[str, ...] = ("doc_id", "lang"), by: str = "lang", labels: DataFrame | None = None
) -> DataFrame:
    """Counts, measures and verdict of each document."""
    return judge(materialise(measure(docs, path, keep), "quality"), by, labels)
