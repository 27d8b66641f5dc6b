"""The prefix trie against a brute-force trie of the contract, built in Python."""

import hashlib
import re
import zlib

from leadmill.llm import prefix_trie, queries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    """rows: (conv_id, turn, role, text); gives the sorted node rows of the contract."""
    convs = {}
    for c, t, r, x in rows:
        if c is not None:
            convs.setdefault(c, []).append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for _, _, r, x in sorted(ts)] for c, ts in convs.items()}
    rebuilt = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])  # truncated remainder, as in SQL
        rebuilt[c] = base[:h] + ts[h:]
    nodes = {}
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes.setdefault(tuple(seq[:d]), []).append(c)
    out = []
    for key, mem in nodes.items():
        kids = [k for k in nodes if len(k) == len(key) + 1 and k[: len(key)] == key]
        sub = [k for k in nodes if k[: len(key)] == key]
        leaves = sum(1 for k in sub if not any(len(j) == len(k) + 1 and j[: len(k)] == k for j in nodes))
        saved = sum((len(nodes[k]) - 1) * (len(WORD.findall(k[-1][1])) if k else 0) for k in sub)
        ends = sorted(c for c in mem if len(rebuilt[c]) == len(key))
        out.append((min(mem), len(key), min(nodes[key[:-1]]) if key else None, len(mem), len(kids), leaves, saved,
                    hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def got(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=lambda r: (r[1], r[0]))


def test_edges(spark):
    rows = [
        (20, 0, "user", "hi there"), (20, 1, "assistant", "hello you"), (20, 2, "user", "bye"),
        (21, 0, "user", "hi there"), (21, None, "system", "be brief"), (21, 1, "assistant", None),
        (22, 5, None, "x y z"), (22, 5, None, "x y z"), (23, 0, "user", "hi there"),
        (None, 0, "user", "orphan"), (40, 0, "user", "a"), (45, 1, "user", "b b"), (-3, 0, "user", "neg"),
        (41, 0, "user", "hi there"), (42, 0, "user", "hi there"), (43, 0, "user", "hi there"),
    ]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").withColumn("node", F_lit())
    assert got(prefix_trie.trie(df)) == brute(rows)


def F_lit():
    from pyspark.sql import functions as F

    return F.lit("clash")


def test_empty(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert prefix_trie.trie(df).collect() == []


def test_query_equals_brute_force(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert got(queries.QUERIES["op12_prefix_trie"](spark, folder)) == brute(rows)
