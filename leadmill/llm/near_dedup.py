"""Near-duplicate documents by minhash with tensored banding, candidates verified.

A document is its set of distinct word shingles. Documents with equal sets fold into
one representative. Each representative gets two collections of HALVES short keys,
each key made of ROWS minhashes; a table key is a pair of one key from either
collection, so HALVES squared tables cost only 2 * HALVES * ROWS minhashes. Short keys
that occur once are dropped before any pair is formed.

Within a bucket no pairs are listed. Members are first set against one member of the
bucket. What then still lies in buckets with several components is joined exactly, on
the rarest shingles of the sets (prefix and place bounds), so a link is lost only where
no table key agrees: at a similarity of 0.8 in about 2 pairs of 100,000 with the
constants below.

Documents without words have an empty set and link with nothing; null text is empty.
Documents with fewer words than a shingle are one shingle. Rows with the same doc_id
are one document. Components are numbered by their smallest doc_id. A null doc_id
takes the component of its copies, and is kept where there is none. Other columns are
left out. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadmill.llm.common import LOWER_TABLE, Cache, runs_of, short_batches, whole_text, worker_value
from leadmill.session import materialise

SHINGLE = 5
SIMILAR_PERCENT = 80
HALVES, ROWS = 16, 3
#: Word hashes a worker keeps, about 200 bytes each; they are cheap to make again.
WORDS_KEPT = 200_000
MIX = np.uint64(0x9E3779B97F4A7C15)
SIGNATURES = "doc_id bigint, n_shingles bigint, digest binary, halves array<bigint>"
SETS = "doc_id bigint, shingles array<bigint>"


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser, so that sums of products become hashes."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_numbers(n: int, seed: int) -> np.ndarray:
    return mixed((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * MIX) | np.uint64(1)


def shingle_set(words: np.ndarray, k: int, factors: np.ndarray) -> np.ndarray:
    """Sorted distinct shingle hashes from word hashes; fewer words than ``k`` are one shingle."""
    n = len(words)
    if n == 0:
        return words
    if n < k:
        return mixed(np.array([(words * factors[:n]).sum(dtype=np.uint64)], np.uint64) + np.array([n], np.uint64) * MIX)
    total = words[: n - k + 1] * factors[0]
    for i in range(1, k):
        total += words[i : n - k + 1 + i] * factors[i]
    return np.unique(mixed(total))


def minhashes(shingles: np.ndarray, factors: np.ndarray) -> np.ndarray:
    least = np.full(len(factors), np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1024):
        value = shingles[None, at : at + 1024] * factors[:, None]
        value ^= value >> np.uint64(29)
        value *= MIX
        np.minimum(least, value.min(axis=1), out=least)
    return least


def word_hashes() -> Cache:
    import xxhash

    return Cache(lambda words: [xxhash.xxh3_64_intdigest(w) for w in words], WORDS_KEPT, WORDS_KEPT)


def doc_sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[pa.Array, list[np.ndarray]]]:
    """Ids and shingle sets, in runs of bounded size."""
    cache = worker_value(("near_dedup",), word_hashes)
    factors = odd_numbers(k, 7)
    texts = batch.column(1).cast(pa.binary())
    for a, b in runs_of((len(t.as_buffer()) for t in texts), 4 << 20):
        split = [text.translate(LOWER_TABLE).split() for text in texts.slice(a, b - a).to_pylist()]
        cache.learn(w for words in split for w in words)
        hashed = [np.fromiter(map(cache.__getitem__, words), np.uint64, len(words)) for words in split]
        yield batch.column(0).slice(a, b - a), [shingle_set(words, k, factors) for words in hashed]


def signatures(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, digest of the set, short keys), one row per row; null keys for an empty set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        factors = odd_numbers(2 * HALVES * ROWS, 1000)
        join = odd_numbers(ROWS, 2000)
        for batch in batches:
            for ids, sets in doc_sets(batch, k):
                digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                halves = [
                    mixed((minhashes(s, factors).reshape(2 * HALVES, ROWS) * join).sum(axis=1, dtype=np.uint64)).view(np.int64) if len(s) else None
                    for s in sets
                ]
                yield pa.record_batch(
                    [ids, pa.array([len(s) for s in sets], pa.int64()), pa.array(digests, pa.binary()), pa.array(halves, pa.list_(pa.int64()))],
                    names=["doc_id", "n_shingles", "digest", "halves"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).mapInArrow(run, SIGNATURES)


def full_sets(docs: DataFrame, ids: DataFrame, k: int) -> DataFrame:
    """(id, shingles) of the documents in ``ids``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, sets in doc_sets(batch, k):
                yield pa.record_batch(
                    [some, pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["doc_id", "shingles"]
                )

    wanted = docs.select(F.col("doc_id").cast("bigint"), whole_text().alias("text")).join(
        ids.select(F.col("id").alias("doc_id")), "doc_id", "left_semi"
    )
    return wanted.mapInArrow(run, SETS).withColumnRenamed("doc_id", "id")


def tensor_buckets(reps: DataFrame) -> DataFrame:
    """(bucket, id) of table keys that at least two representatives share."""
    short = reps.select("id", F.posexplode("halves").alias("place", "value"))
    shared = short.groupBy("place", "value").agg(F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    kept = F.struct("place", "value")
    sides = short.join(shared, ["place", "value"]).groupBy("id").agg(
        F.collect_list(F.when(F.col("place") < HALVES, kept)).alias("left"),
        F.collect_list(F.when(F.col("place") >= HALVES, kept)).alias("right"),
    )
    keys = sides.select("id", F.explode("left").alias("u"), "right").select("id", "u", F.explode("right").alias("v"))
    return keys.select(F.xxhash64("u.place", "u.value", "v.place", "v.value").alias("bucket"), "id")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (id, hub) whose full sets are similar enough.

    Hubs are few, so their sets are written apart: if they are small, Spark sends them
    to the pairs and no set is shuffled with a pair.
    """
    sized = sets.withColumn("n", F.size("shingles"))
    hubs = materialise(sized.join(pairs.select("hub").distinct(), sized["id"] == F.col("hub"), "left_semi"), "hub_sets")
    met = pairs.join(sized.toDF("id", "own", "n"), "id").join(hubs.toDF("hub", "other", "m"), "hub").where(
        100 * F.least("n", "m") >= percent * F.greatest("n", "m")
    )
    both = F.size(F.array_intersect("own", "other"))
    return met.where(100 * both >= percent * (F.col("n") + F.col("m") - both)).select("id", "hub").distinct()


def components(links: DataFrame) -> DataFrame:
    """(id, root): the smallest id that each linked id reaches.

    Every round hooks each root to its smallest neighbour, follows two hooks, and
    contracts the links; tables shrink fast, and nothing but counts reaches the driver.
    """
    edges = materialise(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "edges")
    roots = edges.select(F.col("a").alias("id")).distinct().withColumn("root", F.col("id"))
    while not edges.isEmpty():
        hook = edges.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("up"))
        for _ in range(2):
            hook = materialise(hook, "hooks")
            above = hook.select(F.col("a").alias("up"), F.col("up").alias("top"))
            hook = hook.join(above, "up").select("a", F.col("top").alias("up"))
        hook = materialise(hook, "hooks")
        roots = materialise(
            roots.join(hook, roots["root"] == hook["a"], "left").select("id", F.coalesce("up", "root").alias("root")), "roots"
        )
        left = hook.select("a", F.col("up").alias("ua"))
        right = hook.select(F.col("a").alias("b"), F.col("up").alias("ub"))
        edges = materialise(
            edges.join(left, "a").join(right, "b").select(F.col("ua").alias("a"), F.col("ub").alias("b")).where("a <> b").distinct(), "edges"
        )
    return roots


def first_meetings(members: DataFrame) -> DataFrame:
    """Each member with the smallest of its bucket."""
    hubs = members.groupBy("bucket").agg(F.min("id").alias("hub"))
    return members.join(hubs, "bucket").where("id <> hub").select("id", "hub").distinct()


def exact_meetings(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """All pairs of members of different components that can be similar enough, by their rarest shingles.

    Similar sets share one of their first shingles in order of rarity, and the places of
    the first one they share bound what they can have in common.
    """
    own = members.select("id", "root").distinct().join(sets, "id").withColumn("n", F.size("shingles"))
    tokens = own.select("id", "root", "n", F.explode("shingles").alias("shingle"))
    often = tokens.groupBy("shingle").agg(F.count(F.lit(1)).alias("often"))
    in_order = F.sort_array(F.collect_list(F.struct("often", "shingle")))
    first = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1
    prefix = tokens.join(often, "shingle").groupBy("id", "root", "n").agg(in_order.alias("all")).select(
        "id", "root", "n", F.posexplode(F.slice("all", F.lit(1), first.cast("int"))).alias("place", "t")
    ).where("t.often > 1").select(F.col("t.shingle").alias("shingle"), "id", "root", "n", "place")
    prefix = materialise(prefix, "prefixes")
    other = prefix.toDF("shingle", "hub", "hub_root", "m", "hub_place")
    most = F.least(F.col("n") - F.col("place"), F.col("m") - F.col("hub_place"))
    return prefix.join(other, "shingle").where(
        (F.col("root") != F.col("hub_root")) & (F.col("id") < F.col("hub"))
        & (100 * F.least("n", "m") >= percent * F.greatest("n", "m"))
        & ((100 + percent) * most >= percent * (F.col("n") + F.col("m")))
    ).select("id", "hub").distinct()


def link_buckets(buckets: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(id, root) of the members of buckets, from verified links."""
    roots = buckets.select("id").distinct().withColumn("root", F.col("id"))
    for rest in (False, True):
        members = buckets.join(roots, "id")
        active = members.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
        members = materialise(members.join(active.select("bucket"), "bucket"), "members")
        pairs = exact_meetings(members, sets, percent) if rest else first_meetings(members)
        links = materialise(verified(materialise(pairs, "pairs"), sets, percent), "links")
        ends = links.join(roots.toDF("id", "ra"), "id").join(roots.toDF("hub", "rb"), "hub")
        joined = components(ends.select(F.col("ra").alias("a"), F.col("rb").alias("b")).distinct())
        moved = joined.toDF("root", "new_root")
        roots = materialise(
            roots.join(moved, "root", "left").select("id", F.coalesce("new_root", "root").alias("root")), "labels"
        )
    return roots


def near_duplicates(docs: DataFrame, k: int = SHINGLE, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept), one row per row of ``docs``.

    ``docs`` is read twice; only documents that share a bucket are read for their full sets.
    """
    with short_batches(docs.sparkSession):
        signed = materialise(signatures(docs, k), "signatures")
    groups = signed.where("digest is not null and doc_id is not null").groupBy("digest").agg(
        F.min("doc_id").alias("id"), F.min("halves").alias("halves")
    )
    reps = materialise(groups, "representatives")
    buckets = materialise(tensor_buckets(reps), "buckets")
    ids = buckets.select("id").distinct()
    with short_batches(docs.sparkSession):
        sets = materialise(full_sets(docs, ids, k), "sets")
    roots = link_buckets(buckets, sets, percent)
    named = reps.select("digest", "id").join(roots, "id", "left").select("digest", F.coalesce("root", "id").alias("root"))
    return signed.select("doc_id", "n_shingles", "digest").join(named, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("root", "doc_id").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()))
