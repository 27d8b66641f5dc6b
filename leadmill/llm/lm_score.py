"""Language-model scores by prediction by partial matching over bytes.

Training counts every byte with the ORDER bytes before it. Shorter contexts follow by
summing. A context predicts a byte by its count; an unseen byte costs an escape with as
much weight as the context has different bytes (method C), and the next shorter context
is asked without the bytes that the longer one had seen. Below the empty context all
remaining symbols are alike. The code length of a text is the sum over its bytes and
its end.

Counts cover all training documents and no string is dropped. A table holds the chance
of every string of ORDER + 1 bytes that occurs in any document; one that training has
not seen is followed through the shorter contexts by joins. Tasks receive the chances
of strings with at least SHARE of all symbols, at most 1 / SHARE of them, as a shortcut;
all other strings of a run of documents meet the table by a join. SHARE changes the work, not
the scores.

Beside it a word unigram is scored: word counts of the training documents meet the
postings of all documents by a join on the word, one row per word and run of documents,
so a word of every document is spread over many rows.

Null text is empty: one end symbol. A null doc_id is held in. Repeated rows are rows of
their own. Without training documents all symbols are alike. An empty table gives an
empty table; other columns are left out.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from leadmill.llm.common import LOWER_TABLE, runs_of, whole_text
from leadmill.session import materialise

ORDER = 4
SHARE = 5e-7
BEFORE, END = 0xFF, 0xFE  # bytes that no UTF-8 text has
SYMBOLS = 257
SMOOTHING = 0.1
PIECE_BYTES = 1 << 20  # texts whose symbols are numbers at the same time
RUN_BYTES = 16 << 20
MOST_GRAMS = 2_000_000


def held_out(doc_id: str = "doc_id") -> Column:
    """Whether a document is kept from training."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 10 == 0, F.lit(False))


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each symbol with the ORDER symbols before it as one number, and where each text starts."""
    raw = np.frombuffer(bytes([BEFORE] * ORDER) + bytes([END] + [BEFORE] * ORDER).join(texts) + bytes([END]), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    key = np.zeros(len(raw) - ORDER, np.int64)
    for i in range(ORDER + 1):
        key <<= 8
        key |= raw[i : len(raw) - ORDER + i]
    # between two texts the paddings are not symbols
    starts = np.cumsum(sizes + ORDER) - sizes - ORDER
    real = np.ones(len(key), bool)
    ends = starts[1:]
    for i in range(1, ORDER + 1):
        real[ends - i] = False
    return key[real], np.cumsum(sizes) - sizes


def merged(parts: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    keys, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, *(np.bincount(at, np.concatenate([p[i] for p in parts])).astype(np.int64) for i in (1, 2))


def count_grams(docs: DataFrame, held: Column | None = None) -> DataFrame:
    """(gram, n, met) over all given documents; tasks sum up before the shuffle.

    ``met`` counts all documents and ``n`` those that are not ``held``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[tuple[np.ndarray, ...]] = []

        def out():
            return pa.record_batch([pa.array(c) for c in merged(parts)], names=["gram", "n", "met"])

        for batch in batches:
            texts, kept = batch.column(0).cast(pa.binary()), batch.column(1).to_pylist()
            for a, b in runs_of((len(t.as_buffer()) for t in texts), PIECE_BYTES):
                some = texts.slice(a, b - a).to_pylist()
                for held_out in (False, True):
                    chosen = [t for t, k in zip(some, kept[a:b], strict=True) if k == held_out]
                    if chosen:
                        keys, met = np.unique(grams(chosen)[0], return_counts=True)
                        parts.append((keys, np.zeros_like(met) if held_out else met, met))
                if sum(len(p[0]) for p in parts) > MOST_GRAMS:
                    parts = [merged(parts)]
                    if len(parts[0][0]) > MOST_GRAMS // 2:
                        yield out()
                        parts = []
        if parts:
            yield out()

    marked = docs.select(whole_text().alias("text"), (F.lit(False) if held is None else held).alias("held"))
    counted = marked.mapInArrow(run, "gram bigint, n bigint, met bigint")
    return counted.groupBy("gram").agg(F.sum("n").alias("n"), F.sum("met").alias("met"))


@dataclass
class Level:
    """Contexts of one length: sorted strings with counts, and per context its sums."""

    grams: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    kinds: np.ndarray
    shadow: np.ndarray  # what the next shorter context counts for this one's symbols


class Model:
    """A trie in one process's memory as sorted arrays, one level per context length."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray]]):
        self.levels: list[Level] = []
        for length, (keys, counts) in enumerate(rows):
            order = np.argsort(keys)
            keys, counts = keys[order], counts[order]
            contexts, first = np.unique(keys >> 8, return_index=True)
            if length and len(keys):
                below = self.levels[-1]
                shadow = np.add.reduceat(below.counts[np.searchsorted(below.grams, keys & ((1 << 8 * length) - 1))], first)
            else:
                shadow = np.zeros(len(contexts), np.int64)
            total = np.add.reduceat(counts, first) if len(keys) else counts
            kinds = np.diff(np.append(first, len(keys)))
            self.levels.append(Level(keys, counts, contexts, total, kinds, shadow))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """Log probability of each distinct string's last symbol after the others."""
        out = np.zeros(len(keys))
        left = np.arange(len(keys))
        hidden = np.zeros((2, len(keys)), np.int64)  # counts and kinds of excluded symbols
        for length in reversed(range(len(self.levels))):
            level = self.levels[length]
            if not len(level.grams) or not len(left):
                continue
            key = keys[left] & ((1 << 8 * (length + 1)) - 1)
            at = np.minimum(np.searchsorted(level.grams, key), len(level.grams) - 1)
            hit = level.grams[at] == key
            context = np.minimum(np.searchsorted(level.contexts, key >> 8), len(level.contexts) - 1)
            known = level.contexts[context] == key >> 8
            total, kinds = level.total[context] - hidden[0, left], level.kinds[context] - hidden[1, left]
            asked = known & (total > 0)
            weight = np.where(hit, level.counts[at], kinds)
            out[left[asked]] += np.log10(weight[asked] / (total + kinds)[asked])
            hidden[0, left[known]], hidden[1, left[known]] = level.shadow[context][known], level.kinds[context][known]
            left = left[~(asked & hit)]
        out[left] -= np.log10(np.maximum(SYMBOLS - hidden[1, left], 1))
        return out


def train(docs: DataFrame, share: float = SHARE) -> Model:
    """A model of the given documents in memory, whole with a share of 0, else pruned; ``score`` does without it."""
    full = materialise(count_grams(docs), "grams")
    total = full.agg(F.sum("n")).first()[0] or 0
    lengths = F.explode(F.array(*[
        F.struct(F.lit(i).alias("length"), F.col("gram").bitwiseAND((1 << 8 * (i + 1)) - 1).alias("gram")) for i in range(ORDER + 1)
    ])).alias("g")
    kept = full.select("n", lengths).groupBy("g.length", "g.gram").agg(F.sum("n").alias("n")).where(F.col("n") >= share * total)
    rows = kept.toArrow()  # at most (ORDER + 1) / share rows
    length, gram, n = (rows.column(i).to_numpy() for i in range(3))
    return Model([(gram[length == i], n[length == i]) for i in range(ORDER + 1)])


def low(gram: Column, length: int) -> Column:
    """The last byte of a string with the ``length`` bytes before it."""
    return gram.bitwiseAND((1 << 8 * (length + 1)) - 1)


def context_of(gram: Column) -> Column:
    return F.shiftright(gram, 8)


def chances(full: DataFrame) -> DataFrame:
    """(gram, met, p): log probability of each string's last symbol after the others, from stored (gram, n, met)."""
    counts = [full.where("n > 0").select("gram", "n")]
    for length in reversed(range(ORDER)):
        shorter = counts[0].groupBy(low(F.col("gram"), length).alias("gram")).agg(F.sum("n").alias("n"))
        counts.insert(0, materialise(shorter, f"strings{length}"))
    contexts = []
    for length, level in enumerate(counts):
        below = F.lit(0).cast("bigint")
        if length:
            level = level.join(counts[length - 1].select(F.col("gram").alias("short"), F.col("n").alias("below")), low(F.col("gram"), length - 1) == F.col("short"))
            below = F.col("below")
        sums = level.groupBy(context_of(F.col("gram")).alias("context")).agg(
            F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds"), F.sum(below).alias("shadow")
        )
        contexts.append(materialise(sums, f"contexts{length}"))
    seen = full.where("n > 0").withColumn("context", context_of(F.col("gram"))).join(contexts[ORDER], "context").select(
        "gram", "met", F.log10(F.col("n") / (F.col("total") + F.col("kinds"))).alias("p")
    )
    none = F.lit(0).cast("bigint")
    walk = full.where("n = 0").select("gram", "met", F.lit(0.0).alias("p"), F.lit(False).alias("done"), none.alias("hidden_n"), none.alias("hidden_kinds"))
    for length in reversed(range(ORDER + 1)):
        there = contexts[length]
        walk = walk.withColumn("context", context_of(low(F.col("gram"), length))).join(there, "context", "left").drop("context")
        hits = counts[length].select(F.col("gram").alias("short"), F.col("n").alias("hit"))
        walk = walk.withColumn("short", low(F.col("gram"), length)).join(hits, "short", "left").drop("short")
        total, kinds = F.col("total") - F.col("hidden_n"), F.col("kinds") - F.col("hidden_kinds")
        asked = ~F.col("done") & F.coalesce(total > 0, F.lit(False))
        walk = walk.select(
            "gram", "met",
            F.when(asked, F.col("p") + F.log10(F.coalesce("hit", kinds) / (total + kinds))).otherwise(F.col("p")).alias("p"),
            (F.col("done") | (asked & F.col("hit").isNotNull())).alias("done"),
            F.coalesce("shadow", "hidden_n").alias("hidden_n"),
            F.when(F.col("total").isNotNull(), F.col("kinds")).otherwise(F.col("hidden_kinds")).alias("hidden_kinds"),
        )
    rest = F.log10(F.greatest(SYMBOLS - F.col("hidden_kinds"), F.lit(1)).cast("double"))
    return seen.unionByName(walk.select("gram", "met", F.when(F.col("done"), F.col("p")).otherwise(F.col("p") - rest).alias("p")))


SCORED = (
    "row bigint, doc_id bigint, held_out boolean, n_words bigint, score double, "
    "word string, seen bigint, gram bigint, base bigint, places array<int>, times array<int>"
)
EMPTY = {"row": pa.int64(), "doc_id": pa.int64(), "held_out": pa.bool_(), "n_words": pa.int64(), "score": pa.float64(), "word": pa.string(),
         "seen": pa.int64(), "gram": pa.int64(), "base": pa.int64(), "places": pa.list_(pa.int32()), "times": pa.list_(pa.int32())}


def filled(**columns: pa.Array) -> pa.RecordBatch:
    rows = len(next(iter(columns.values())))
    return pa.record_batch([columns.get(n, pa.nulls(rows, k)) for n, k in EMPTY.items()], names=list(EMPTY))


def postings_of(code: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, places and times of the distinct pairs, in order of the codes."""
    pairs, times = np.unique((code << 32) | place, return_counts=True)
    return pairs >> 32, pairs & 0xFFFFFFFF, times


def ends_of(code: np.ndarray) -> np.ndarray:
    return np.append(np.flatnonzero(np.diff(code, prepend=-1)), len(code)).astype(np.int32)


def score_strings(texts: list[bytes], known: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each text's score by the known strings, and (string, place of its text) of the others, occurrence by occurrence.

    Symbols are numbered a piece of the texts at a time.
    """
    strings, chance = known
    scores, others, places = [], [], []
    for a, b in runs_of(map(len, texts), PIECE_BYTES):
        keys, starts = grams(texts[a:b])
        distinct, at = np.unique(keys, return_inverse=True)
        p, found = np.zeros(len(distinct)), np.zeros(len(distinct), bool)
        if len(strings):
            spot = np.minimum(np.searchsorted(strings, distinct), len(strings) - 1)
            found = strings[spot] == distinct
            p[found] = chance[spot[found]]
        scores.append(np.add.reduceat(p[at], starts))
        left = np.flatnonzero(~found[at])
        others.append(keys[left])
        places.append((np.searchsorted(starts, left, "right") - 1 + a).astype(np.int32))
    return np.concatenate(scores), np.concatenate(others), np.concatenate(places)


def score_batches(batches: Iterator[pa.RecordBatch], known: tuple[np.ndarray, np.ndarray], row: int) -> Iterator[pa.RecordBatch]:
    """The rows of ``score_and_index`` for batches of (doc_id, held_out, text), numbered from ``row``."""
    for batch in batches:
        texts = batch.column(2).cast(pa.binary())
        for a, b in runs_of((len(t.as_buffer()) for t in texts), RUN_BYTES):
            some, held = texts.slice(a, b - a).to_pylist(), batch.column(1).slice(a, b - a)
            score, others, place = score_strings(some, known)
            if len(others):
                distinct, code = np.unique(others, return_inverse=True)
                code, place, times = postings_of(code, place)
                ends = ends_of(code)
                yield filled(
                    gram=pa.array(distinct[code[ends[:-1]]]), base=pa.array(np.full(len(ends) - 1, row)),
                    places=pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                    times=pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
                )
            del others
            # words are numbered text by text; only their numbers are kept
            numbers: dict[bytes, int] = {}
            codes, sizes = array("q"), np.zeros(len(some), np.int64)
            for i, text in enumerate(some):
                words = text.translate(LOWER_TABLE).split()
                codes.extend([numbers.setdefault(w, len(numbers)) for w in words])
                sizes[i] = len(words)
            yield filled(
                row=pa.array(np.arange(row, row + len(some))), doc_id=batch.column(0).slice(a, b - a), held_out=held,
                n_words=pa.array(sizes), score=pa.array(score),
            )
            word, place, times = postings_of(np.array(codes, np.int64), np.repeat(np.arange(len(some)), sizes))
            ends = ends_of(word)
            trained = np.where(held.to_numpy(zero_copy_only=False)[place], 0, times) if len(place) else times
            yield filled(
                word=pa.array([w.decode() for w in numbers], pa.string()),
                seen=pa.array(np.bincount(word, trained, len(numbers)).astype(np.int64)),
                base=pa.array(np.full(len(numbers), row)),
                places=pa.ListArray.from_arrays(ends, pa.array(place.astype(np.int32))),
                times=pa.ListArray.from_arrays(ends, pa.array(times.astype(np.int32))),
            )
            row += len(some)


def score_and_index(docs: DataFrame, known: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """Rows of three sorts: a document's score by the known strings under its row number, and
    the postings of a word and of a string that is not known in a run of documents.

    ``known`` are sorted strings and their chances. Row numbers hold once the result is written.
    """
    shared = docs.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return score_batches(batches, shared.value, TaskContext.get().partitionId() << 33)

    return docs.select(F.col("doc_id").cast("bigint"), "held_out", whole_text().alias("text")).mapInArrow(run, SCORED)


def score(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``."""
    marked = docs.withColumn("held_out", held_out())
    table = materialise(chances(materialise(count_grams(marked, F.col("held_out")), "grams")), "chances")
    symbols = table.agg(F.sum("met")).first()[0] or 0
    often = F.col("met") >= share * symbols
    rows = table.where(often).select("gram", "p").orderBy("gram").toArrow()  # at most 1 / share rows
    done = materialise(score_and_index(marked, tuple(rows.column(i).to_numpy() for i in range(2))), "scores")
    texts = done.where("row is not null").select("row", "doc_id", "held_out", "n_words", "score")
    rare = done.where("gram is not null").select("gram", "base", "places", "times")
    postings = done.where("word is not null").select("word", "seen", "base", "places", "times")
    counts = materialise(postings.groupBy("word").agg(F.sum("seen").alias("c")), "words")
    ends = texts.agg(F.count_if(~F.col("held_out"))).first()[0] or 0
    words, kinds = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    total, kinds = words + ends, kinds + (ends > 0)
    whole = total + SMOOTHING * (kinds + 1)

    def weight(c: Column) -> Column:
        return F.log10((c + SMOOTHING) / F.lit(whole))

    each = F.inline(F.arrays_zip(F.col("places").alias("place"), F.col("times").alias("n")))
    met = postings.drop("seen").join(counts, "word").select("base", "c", F.lit(None).cast("double").alias("p"), each)
    met = met.unionByName(rare.join(table.where(~often), "gram").select("base", F.lit(None).cast("bigint").alias("c"), "p", each))
    summed = met.groupBy((F.col("base") + F.col("place")).alias("row")).agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"), F.sum(F.col("n") * weight(F.col("c"))).alias("sum"),
        F.sum(F.col("n") * F.col("p")).alias("rare"),
    )
    return texts.join(summed, "row", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.coalesce("known", F.lit(0)) + int(ends > 0)).cast("bigint").alias("n_known"),
        F.lit(total).cast("bigint").alias("train_tokens"),
        (F.coalesce("sum", F.lit(0.0)) + weight(F.lit(ends))).alias("base_score"), (F.col("score") + F.coalesce("rare", F.lit(0.0))).alias("score"),
    )
