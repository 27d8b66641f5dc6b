"""Token-id files against the tokenizers library, document by document."""

import struct
import zlib

import pytest

from leadmill.llm import queries, token_files
from leadmill.llm.common import vocabulary
from leadmill.session import scratch_path


def brute(rows):
    """(doc_id, start, n_tokens, crc) in ascending doc_id, nulls first, equal ids by their text."""
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    tok.encode_special_tokens = True
    coded = []
    for doc_id, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [2]
        coded.append((doc_id, struct.pack(f"<{len(ids)}I", *ids), text or ""))
    coded.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[2]))
    start, out = 0, []
    for doc_id, ids, _ in coded:
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return out


def written(spark, df):
    folder = scratch_path(spark, "token-files-test")
    token_files.write(df, folder)
    return token_files.read(spark, folder).collect()


def test_edges_equal_brute_force(spark):
    long = "Words, and more words! " * 5000
    rows = [(3, "Hello world."), (1, None), (None, "no id here"), (2, ""), (3, "Hello world."), (7, long),
            (5, "zeta alpha"), (5, "alpha zeta"), (None, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'x' as ids", "1 as block", "2 as start")
    got = sorted(map(tuple, written(spark, df.repartition(3))), key=lambda r: (r[1]))
    assert got == brute(rows)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert written(spark, df) == []


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001"])
def test_query_equals_brute_force(spark, folder):
    got = sorted(map(tuple, queries.QUERIES["op13_token_files"](spark, folder).collect()), key=lambda r: r[1])
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    assert got == brute([tuple(r) for r in docs])
