"""Packing of token sequences: shortest pack first over the histogram of lengths.

Documents are tokenised and cut into pieces of at most ``width`` ids. Only the
histogram of piece lengths, at most ``width`` rows however large the corpus is,
reaches the driver. There the lengths are placed longest first, each into the
packs with the most free room, by updating the counts of packing patterns. The
patterns go back to the pieces by the rank of a piece among those of its length.

Null texts are empty and hold only the end id. Repeated rows are pieces of their
own. An empty table gives no rows. Other columns of the input are left out, except
those named in ``keep``.
"""

from __future__ import annotations

import heapq
import struct
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from leadmill.llm.common import runs_of, vocabulary, whole_text, worker_value
from leadmill.session import materialise

WIDTH = 4096
END_ID = 2
TOKENIZER = "word_bpe_49k.json"
#: Fixed: how this vocabulary splits lower-cased text.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: Pieces of one length that one window group ranks.
GROUP_ROWS = 200
PIECES = "doc_id bigint, start bigint, length bigint, doc_tokens bigint, ids binary"


def byte_letters() -> dict[int, int]:
    """The letter that byte-level vocabularies show for each byte: itself where it prints, else the next from U+0100."""
    printing = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printing]
    return {b: b for b in printing} | {b: 256 + i for i, b in enumerate(rest)}


def as_bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


class ChunkIds(dict):
    """Ids of white-space-free chunks as little-endian 32-bit bytes, kept until there are too many.

    The vocabulary's normaliser and splitter never join across white space, so the
    ids of a text are those of its chunks in order. Chunks of plain Latin characters,
    which Unicode normalisation leaves alone, are lower-cased and split here, one word
    with a mark behind it at once, and the library merges their words; it gets all
    other chunks whole.
    """

    def __init__(self, path: str, most: int = 800_000):
        import regex
        from tokenizers import Tokenizer

        super().__init__()
        self.most, self.words = most, {}
        self.library = Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.model = self.library.model
        self.split = regex.compile(SPLIT).findall
        self.plain = regex.compile(r"[\x21-\x7e\u00a1-\u024f]*").fullmatch
        self.shown = byte_letters()

    def of_word(self, word: str) -> bytes:
        ids = self.words.get(word)
        if ids is None:
            if len(self.words) >= self.most:
                self.words.clear()
            letters = word.encode().decode("latin-1").translate(self.shown)
            ids = self.words[word] = as_bytes([t.id for t in self.model.tokenize(letters)])
        return ids

    def __missing__(self, chunk: bytes) -> bytes:
        text = chunk.decode()
        body, end = (text[:-1], text[-1]) if text[-1] in ".,!?;:" else (text, "")
        low = body.lower()
        if low.isalpha() and max(low) < "\u0250":
            ids = self.of_word(low) + (self.of_word(end) if end else b"")
        elif self.plain(text):
            ids = b"".join(map(self.of_word, self.split(text.lower())))
        else:
            ids = as_bytes(self.library.encode(text, add_special_tokens=False).ids)
        if len(self) >= self.most:
            self.clear()
        self[chunk] = ids
        return ids


def tokenize(docs: DataFrame, path: str | None = None, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """(doc_id, start, length, doc_tokens, ids): each document's ids with the end id, cut every ``width``."""
    path = path or vocabulary(TOKENIZER)
    end = int(end_id).to_bytes(4, "little")

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_value(("packing", path), lambda: ChunkIds(path))
        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1).cast(pa.binary())
            for a, b in runs_of((len(t.as_buffer()) for t in texts), 4 << 20):
                rows: list[tuple] = []
                chunks = [text.split() for text in texts.slice(a, b - a).to_pylist()]
                for doc_id, doc in zip(doc_ids[a:b], chunks, strict=True):
                    ids = b"".join([*map(cache.__getitem__, doc), end])
                    total = len(ids) // 4
                    rows += [
                        (doc_id, s, min(width, total - s), total, ids[4 * s : 4 * (s + width)]) for s in range(0, total, width)
                    ]
                columns = zip(*rows, strict=True)
                yield pa.record_batch(
                    [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 4 + [pa.binary()], strict=True)],
                    names=["doc_id", "start", "length", "doc_tokens", "ids"],
                )

    return docs.select("doc_id", whole_text().alias("text")).mapInArrow(pieces, PIECES)


def shortest_pack_first(histogram: dict[int, int], width: int = WIDTH) -> list[tuple[int, tuple]]:
    """(copies, pattern): a pattern is a linked list (shorter pattern, length), None at its end.

    The work grows with the number of lengths and patterns, not with the counts.
    """
    room: dict[int, list[tuple[int, tuple | None]]] = {}
    emptiest: list[int] = []
    full = []
    for length in sorted(histogram, reverse=True):
        if not 0 < length <= width:
            raise ValueError(f"a piece of {length} ids does not fit into {width}")
        left = histogram[length]
        while left > 0:
            while emptiest and not room[-emptiest[0]]:
                room.pop(-heapq.heappop(emptiest))
            space = -emptiest[0] if emptiest else 0
            if space < length:
                space, copies, pattern = width, -(-left // (width // length)), None  # as many as these pieces need
            else:
                copies, pattern = room[space].pop()
            take = min(copies, left)
            if take < copies:
                room[space].append((copies - take, pattern))
            left -= take
            grown = (take, (pattern, length))
            if space == length:
                full.append(grown)
                continue
            if space - length not in room:
                room[space - length] = []
                heapq.heappush(emptiest, length - space)
            room[space - length].append(grown)
    return full + [pack for packs in room.values() for pack in packs]


def slots(packs: list[tuple[int, tuple]]) -> list[tuple[int, ...]]:
    """(length, first rank, last rank, first sequence, copies, first offset, tokens of the sequence).

    One row per pattern and length: equal lengths of a pattern lie side by side.
    """
    rows, ranked, sequence = [], {}, 0
    for copies, pattern in packs:
        times: dict[int, int] = {}
        while pattern is not None:
            pattern, length = pattern
            times[length] = times.get(length, 0) + 1
        offset, tokens = 0, sum(length * n for length, n in times.items())
        for length, n in times.items():
            first = ranked.get(length, 0)
            ranked[length] = first + n * copies
            rows.append((length, first, first + n * copies - 1, sequence, copies, offset, tokens))
            offset += length * n
        sequence += copies
    return rows


def rank_in_length(pieces: DataFrame, counts: DataFrame) -> DataFrame:
    """Adds ``rank``, gapless from 0 among pieces of a length.

    A length is ranked in groups of about GROUP_ROWS pieces, whose bases are running
    sums of their sizes, so a length with a third of all pieces is no burden.
    """
    groups = counts.select("length", F.ceil(F.col("n") / GROUP_ROWS).alias("groups"))
    dealt = pieces.join(F.broadcast(groups), "length").withColumn(  # at most ``width`` rows
        "part", F.pmod(F.xxhash64("doc_id", "start", "length"), F.col("groups"))
    )
    order = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        dealt.groupBy("length", "part").agg(F.count(F.lit(1)).alias("size"))
        .select("length", "part", F.coalesce(F.sum("size").over(order), F.lit(0)).alias("base"))
    )
    rest = [c for c in pieces.columns if c not in ("doc_id", "start", "length", "ids")]
    inside = Window.partitionBy("length", "part").orderBy("doc_id", "start", *rest)
    ranked = dealt.withColumn("at", F.row_number().over(inside) - 1).join(base, ["length", "part"])
    return ranked.withColumn("rank", F.col("base") + F.col("at")).drop("groups", "part", "at", "base")


def place(pieces: DataFrame, width: int = WIDTH) -> DataFrame:
    """Adds sequence_id, offset and sequence_tokens to stored pieces (doc_id, start, length, ...).

    ``pieces`` is read three times and should be a written table.
    """
    spark = pieces.sparkSession
    counts = pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))
    histogram = [(r.length, r.n) for r in counts.collect()]  # at most ``width`` rows
    lengths = spark.createDataFrame(histogram, "length bigint, n bigint")
    patterns = spark.createDataFrame(
        slots(shortest_pack_first(dict(histogram), width)),
        "length bigint, low bigint, high bigint, sequence bigint, copies bigint, first bigint, sequence_tokens bigint",
    )
    # bounded by the width: a pattern holds fewer than sqrt(2 * width) different lengths
    met = rank_in_length(pieces, lengths).join(
        F.broadcast(patterns), ["length"]
    ).where(F.col("rank").between(F.col("low"), F.col("high")))
    at = F.col("rank") - F.col("low")
    return met.select(
        *pieces.columns,
        (F.col("sequence") + at % F.col("copies")).alias("sequence_id"),
        (F.col("first") + F.floor(at / F.col("copies")) * F.col("length")).alias("offset"),
        "sequence_tokens",
    )


def pack(docs: DataFrame, path: str | None = None, width: int = WIDTH, end_id: int = END_ID) -> DataFrame:
    """The placed pieces of all documents, with a checksum of their ids."""
    pieces = tokenize(docs, path, width, end_id).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens"
    )
    return place(materialise(pieces, "pieces"), width)


def sequences(placed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One row per sequence from placed pieces that carry ``ids``: its ids side by side."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(inside, F.lit(b""), lambda whole, piece: F.concat(whole, piece["ids"]))
    return placed.groupBy("sequence_id", *keep).agg(ids.alias("ids"), F.max("sequence_tokens").alias("tokens"))
