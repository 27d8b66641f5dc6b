"""A trie of conversation prefixes with subtree totals.

Each conversation is a path of nodes, one per prefix of its turns (role, text),
from the textless root. A node is named by two running sums of position-salted
64-bit hashes of its turns (decimal, exact), so the node of every prefix comes from
one window over the conversation, and the parent's name is the node's minus the
hash of its last turn.

Subtree totals need no pass per level. Every node is counted once, on the path of
its smallest member (its ``conv_id``), at its depth. A node's subtree is then all
(member, depth below) places of its members, so a subtree total is the sum over the
node's members of suffix sums along their paths: one window per conversation and
one aggregation per node, whatever the depth.

Results: per node conv_id (smallest member), depth, parent_conv_id, n_convs,
n_children, n_leaves (childless nodes in the subtree, itself included),
saved_tokens ((n_convs - 1) times the words of the node's last text, summed over
the subtree) and ends_sha256 (SHA-256 of the comma-joined ids of the conversations
that end there, ascending; the empty string's hash when none do).

Rows with a null conv_id are left out; null role or text is empty; turns of one
conversation are ordered by turn (nulls first), then role, then text, so repeated
rows are turns of their own. An empty table gives no rows. Other columns are
ignored. Two different prefixes share a name with a chance of about 2^-128.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from leadmill.operators.joins import attach
from leadmill.session import materialise

#: White space of the word rule: blank, tab, newline, vertical tab, form feed, return.
WORDS = r"[^\x20\x09-\x0D]+"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()
SEEDS = (0x5EED1, 0x5EED2)


def ordered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text): positions gapless from 0 within a conversation."""
    clean = turns.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("bigint").alias("conv_id"), F.col("turn").cast("bigint").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    return clean.withColumn("pos", F.row_number().over(order) - 1).drop("turn")


def rebuilt_by_prefix(turns: DataFrame, group: int = 20, heads: int = 4) -> DataFrame:
    """(conv_id, pos, role, text) of every conversation rebuilt as the contract says.

    Conversation c takes the first h = crc32(c) % ``heads`` turns of conversation
    c - c % ``group`` (all if fewer, none if absent), then its own turns after its first h.
    Conversations left without turns have no rows here.
    """
    ordered = ordered_turns(turns)
    convs = ordered.select("conv_id").distinct().select(
        "conv_id", (F.crc32(F.col("conv_id").cast("string")) % heads).alias("h"),
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
    )
    heads_of = ordered.where(F.col("pos") < heads - 1).select(F.col("conv_id").alias("base"), "pos", "role", "text")
    taken = convs.join(heads_of, "base").where(F.col("pos") < F.col("h"))
    n_taken = taken.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n_taken"))
    own = ordered.join(convs.select("conv_id", "h"), "conv_id").where(F.col("pos") >= F.col("h")).join(n_taken, "conv_id", "left")
    return taken.select("conv_id", "pos", "role", "text").unionByName(
        own.select("conv_id", (F.coalesce("n_taken", F.lit(0)) + F.col("pos") - F.col("h")).alias("pos"), "role", "text")
    )


def named(k1: Column, k2: Column) -> Column:
    return F.concat_ws(":", k1.cast("string"), k2.cast("string"))


def members(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, node, parent, words, ends): one row per conversation and node on its path, root included."""
    rebuilt = rebuilt_by_prefix(turns)
    path = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    hashes = [F.xxhash64(F.lit(seed), "pos", "role", "text").cast("decimal(38,0)") for seed in SEEDS]
    sums = [F.sum(h).over(path) for h in hashes]
    length = Window.partitionBy("conv_id")
    steps = rebuilt.select(
        "conv_id", (F.col("pos") + 1).cast("bigint").alias("depth"),
        named(*sums).alias("node"), named(sums[0] - hashes[0], sums[1] - hashes[1]).alias("parent"),
        F.regexp_count("text", F.lit(WORDS)).cast("bigint").alias("words"),
        (F.col("pos") == F.max("pos").over(length)).alias("ends"),
    )
    with_turns = steps.select("conv_id").distinct()
    everyone = ordered_turns(turns).select("conv_id").distinct()
    roots = everyone.join(with_turns.withColumn("some", F.lit(True)), "conv_id", "left").select(
        "conv_id", F.lit(0).cast("bigint").alias("depth"), F.lit("0:0").alias("node"), F.lit(None).cast("string").alias("parent"),
        F.lit(0).cast("bigint").alias("words"), F.col("some").isNull().alias("ends"),
    )
    return steps.unionByName(roots)


def ends_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256) from (node, conv_id) rows, one streaming hash per node over ascending ids.

    The rows of a node meet in one task, sorted and spilled by Spark; the task holds one hash at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, hasher, sep = None, None, b""
        for batch in batches:
            nodes, digests = [], []
            for node, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if node != current:
                    if current is not None:
                        nodes.append(current)
                        digests.append(hasher.hexdigest())
                    current, hasher, sep = node, hashlib.sha256(), b""
                hasher.update(sep + str(conv).encode())
                sep = b","
            yield pa.record_batch([pa.array(nodes, pa.string()), pa.array(digests, pa.string())], names=["node", "ends_sha256"])
        if current is not None:
            yield pa.record_batch([pa.array([current]), pa.array([hasher.hexdigest()])], names=["node", "ends_sha256"])

    return ends.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(run, "node string, ends_sha256 string")


def trie(turns: DataFrame, stored: Callable[[DataFrame, str], DataFrame] = materialise) -> DataFrame:
    """One row per node of all conversations in ``turns`` (conv_id, turn, role, text)."""
    path = stored(members(turns), "trie-members")
    nodes = path.groupBy("node", "depth").agg(
        F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"),
        F.first("parent").alias("parent"), F.first("words").alias("words"),
    )
    kids = nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count(F.lit(1)).alias("n_children"))
    nodes = stored(nodes.join(kids, "node", "left").fillna(0, ["n_children"]), "trie-nodes")
    # each node counted once: at its smallest member's place on that member's path
    owned = nodes.select(
        "conv_id", "depth", ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
        (F.col("n_children") == 0).cast("bigint").alias("leaf"),
    )
    below = Window.partitionBy("conv_id").orderBy(F.col("depth").desc()).rowsBetween(Window.unboundedPreceding, 0)
    totals = (
        path.join(owned, ["conv_id", "depth"], "left").fillna(0, ["saved", "leaf"])
        .select("node", F.sum("saved").over(below).alias("saved"), F.sum("leaf").over(below).alias("leaf"))
        .groupBy("node").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))
    )
    digests = ends_digests(path.where("ends").select("node", "conv_id"))
    parents = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    return (
        attach(nodes, parents, ["parent"])
        .join(totals, "node")
        .join(digests, "node", "left")
        .select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.col("n_children").cast("bigint").alias("n_children"), F.col("n_leaves").cast("bigint").alias("n_leaves"),
            F.col("saved_tokens").cast("bigint").alias("saved_tokens"),
            F.coalesce("ends_sha256", F.lit(EMPTY_SHA)).alias("ends_sha256"), "node",
        )
    )
