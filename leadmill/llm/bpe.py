"""Byte-level BPE encoding and decoding, done by DuckDB inside each partition.

A text is split by the vocabulary's pattern. Its distinct words become rows of
(word, position, token). A recursive query joins neighbouring tokens with the merge
table and contracts, per word and step, the leftmost pair of minimal rank until no
pair can merge. In words of over 100 bytes it contracts with it every further pair
of that rank that does not overlap: in a vocabulary made by BPE a contraction never
opens a pair of lower rank, so this gives what one at a time would.
Decoding joins tokens with the vocabulary and puts their bytes together by ordered
aggregation.

Null texts are empty and give no tokens; tokens without an entry raise. Words meet
DuckDB in bounded groups, and texts in runs of bounded size, so memory does not
grow with a partition. Repeated rows stay, an empty table gives an empty table.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadmill.llm.common import Cache, runs_of, vocabulary, whole_text, worker_value

RANKS = "byte_bpe_multi_50k.tiktoken"
RUN_BYTES = 2 << 20
RUN_WORDS = 400_000
#: Words whose ids a worker keeps.
MOST_WORDS = 800_000
DUCKDB_MEMORY = "256MB"
#: Bytes of words that one recursive query takes, and the longest word contracted one pair at a time.
QUERY_BYTES, LONG = 400_000, 100

#: One pair per word and step: a word of n bytes needs fewer than n steps. Rows stay in the order
#: of word and position, as DuckDB keeps the order of insertion on one thread, so neighbours are
#: found without sorting.
ENCODE = """
WITH RECURSIVE step(word, pos, token, ended) AS (
    SELECT word, pos, token, false FROM start
    UNION ALL
    SELECT word, pos, CASE WHEN place = best THEN CAST(best // 1048576 AS INTEGER) ELSE token END, best IS NULL
    FROM (
        SELECT word, pos, token, place, best, lag(place = best) OVER () AS swallowed
        FROM (
            WITH pairs AS (
                SELECT word, pos, token, CASE WHEN next_word = word THEN merged::BIGINT * 1048576 + pos END AS place
                FROM (
                    SELECT word, pos, token, lead(token) OVER () AS next, lead(word) OVER () AS next_word
                    FROM step WHERE NOT ended
                ) LEFT JOIN merges ON a = token AND b = next
            ), bests AS (SELECT word, min(place) AS best FROM pairs GROUP BY word)
            SELECT word, pos, token, place, best FROM pairs JOIN bests USING (word)
        )
    ) WHERE swallowed IS NOT TRUE
)
SELECT word, token FROM step WHERE ended ORDER BY word, pos
"""

#: All separate pairs of the minimal rank per word and step, for words so long that one at a time takes too many steps.
ENCODE_LONG = """
WITH RECURSIVE step(word, pos, token, ended) AS (
    SELECT word, pos, token, false FROM start
    UNION ALL
    SELECT word, pos, CASE WHEN taken THEN merged ELSE token END, best IS NULL
    FROM (
        SELECT *, coalesce(lag(taken) OVER (PARTITION BY word ORDER BY pos), false) AS swallowed
        FROM (
            SELECT *, coalesce(merged = best AND (i - max(CASE WHEN merged = best AND before IS DISTINCT FROM best THEN i END)
                OVER (PARTITION BY word ORDER BY pos ROWS UNBOUNDED PRECEDING)) % 2 = 0, false) AS taken
            FROM (
                SELECT *, min(merged) OVER (PARTITION BY word) AS best, lag(merged) OVER (PARTITION BY word ORDER BY pos) AS before
                FROM (
                    SELECT word, pos, token, lead(token) OVER w AS next, row_number() OVER w AS i
                    FROM step WHERE NOT ended WINDOW w AS (PARTITION BY word ORDER BY pos)
                ) LEFT JOIN merges ON a = token AND b = next
            )
        )
    ) WHERE NOT swallowed
)
SELECT word, token FROM step WHERE ended ORDER BY word, pos
"""

#: Sorting narrow rows once is cheaper than an order inside each aggregate; one thread takes them as sorted.
DECODE = """
SELECT row, string_agg(hex, '') AS hex
FROM (SELECT row, hex FROM tokens JOIN vocabulary USING (token) ORDER BY row, pos)
GROUP BY row
"""


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class DuckBpe:
    """One in-process DuckDB with the merge table and the vocabulary of a rank file."""

    def __init__(self, path: str):
        import duckdb
        import public_tokenizers
        import regex

        ranks = read_ranks(path)
        self.byte_token = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.con = duckdb.connect(config={"threads": 1, "memory_limit": DUCKDB_MEMORY, "preserve_insertion_order": True})
        pairs = [
            (ranks[token[:cut]], ranks[token[cut:]], rank)
            for token, rank in ranks.items()
            for cut in range(1, len(token))
            if token[:cut] in ranks and token[cut:] in ranks
        ]
        a, b, merged = zip(*pairs, strict=True) if pairs else ((), (), ())
        merges = pa.table({n: pa.array(v, pa.int32()) for n, v in (("a", a), ("b", b), ("merged", merged))})  # noqa: F841
        vocabulary = pa.table({"token": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})  # noqa: F841
        self.con.execute("CREATE TABLE merges AS SELECT * FROM merges")
        self.con.execute("CREATE TABLE vocabulary AS SELECT * FROM vocabulary")
        self.known = len(ranks)
        self.decimal = np.array([str(i).encode() for i in range(self.known)], object)
        self.words = Cache(self.encode_words, MOST_WORDS, 100_000)

    def encode_words(self, texts: list[str]) -> list[bytes]:
        """Ids, as 32-bit bytes, of distinct non-empty words."""
        words = [t.encode() for t in texts]
        known: dict[bytes, bytes] = {}
        for query, some in ((ENCODE, [w for w in words if len(w) <= LONG]), (ENCODE_LONG, [w for w in words if len(w) > LONG])):
            for a, b in runs_of(map(len, some), QUERY_BYTES):
                known.update(zip(some[a:b], self.contract(query, some[a:b]), strict=True))
        return [known[w] for w in words]

    def contract(self, query: str, words: list[bytes]) -> list[bytes]:
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        starts = np.repeat(np.cumsum(sizes) - sizes, sizes)
        raw = np.frombuffer(b"".join(words), np.uint8)
        start = pa.table({  # noqa: F841
            "word": np.repeat(np.arange(len(words), dtype=np.int32), sizes),
            "pos": (np.arange(len(raw)) - starts).astype(np.int32),
            "token": self.byte_token[raw],
        })
        self.con.register("start", start)
        out = self.con.execute(query).fetchnumpy()
        self.con.unregister("start")
        tokens = out["token"].astype("<u4").tobytes()
        ends = np.cumsum(np.bincount(out["word"], minlength=len(words))) * 4
        return [tokens[a:b] for a, b in zip([0, *ends.tolist()], ends.tolist())]

    def ids_of(self, split: list[list[str]]) -> list[bytes]:
        """Ids of texts that are given as lists of words."""
        self.words.learn(set().union(*split))
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text. A text beyond RUN_BYTES is taken a run of words at a time."""
        short = iter(self.ids_of([self.pattern.findall(t) for t in texts if len(t) <= RUN_BYTES]))
        return [next(short) if len(t) <= RUN_BYTES else self.encode_long(t) for t in texts]

    def encode_long(self, text: str) -> bytes:
        matches, parts = self.pattern.finditer(text), []
        while some := [m[0] for m in islice(matches, RUN_WORDS)]:
            parts += self.ids_of([some])
        return b"".join(parts)

    def decode(self, ids: list[bytes]) -> list[bytes]:
        """Bytes of each list of ids by ordered aggregation."""
        flat = np.frombuffer(b"".join(ids), "<u4")
        if len(flat) and flat.max() >= self.known:
            raise ValueError(f"token {flat.max()} is not in the vocabulary")
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        tokens = pa.table({  # noqa: F841
            "row": np.repeat(np.arange(len(ids), dtype=np.int32), sizes),
            "pos": np.arange(len(flat), dtype=np.int32),
            "token": flat.astype(np.int32),
        })
        self.con.register("tokens", tokens)
        found = dict(self.con.execute(DECODE).fetchall())
        self.con.unregister("tokens")
        return [bytes.fromhex(found.get(row, "")) for row in range(len(ids))]


def duck_bpe(path: str) -> DuckBpe:
    return worker_value(("bpe", path), lambda: DuckBpe(path))


def encode(docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids): the token ids of each text as little-endian 32-bit bytes, one row per row."""
    path = path or vocabulary(RANKS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = duck_bpe(path)
        for batch in batches:
            for a, b in runs_of((len(t.as_buffer()) for t in batch.column(1)), RUN_BYTES):
                ids = bpe.encode(batch.column(1).slice(a, b - a).to_pylist())
                yield pa.record_batch([batch.column(0).slice(a, b - a), pa.array(ids, pa.binary())], names=[key, "ids"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, whole_text(text).alias("text")).mapInArrow(run, f"`{key}` {kind}, ids binary")


def decode(encoded: DataFrame, path: str | None = None, key: str = "doc_id", digest: bool = False) -> DataFrame:
    """(key, ids, bytes) from (key, ids); null ids are empty.

    ``digest`` gives the ids as decimal text and the bytes as SHA-256 columns instead,
    so that neither leaves the task.
    """
    path = path or vocabulary(RANKS)
    kind = encoded.schema[key].dataType.simpleString()
    shape = "n_tokens bigint, ids_sha256 string, decoded_sha256 string" if digest else "ids binary, bytes binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        bpe = duck_bpe(path)
        for batch in batches:
            for a, b in runs_of((len(t.as_buffer()) for t in batch.column(1)), RUN_BYTES):
                ids = batch.column(1).slice(a, b - a).to_pylist()
                texts, keys = bpe.decode(ids), batch.column(0).slice(a, b - a)
                if not digest:
                    yield pa.record_batch([keys, pa.array(ids, pa.binary()), pa.array(texts, pa.binary())], names=[key, "ids", "bytes"])
                    continue
                said = [hashlib.sha256(b",".join(bpe.decimal[np.frombuffer(i, "<u4")].tolist())).hexdigest() for i in ids]
                yield pa.record_batch(
                    [keys, pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(said), pa.array([hashlib.sha256(t).hexdigest() for t in texts])],
                    names=[key, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return encoded.select(key, F.coalesce("ids", F.lit(b"")).alias("ids")).mapInArrow(run, f"`{key}` {kind}, {shape}")
