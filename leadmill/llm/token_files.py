"""Token-id files: flat little-endian unsigned 32-bit ids and 64-bit document offsets.

``write`` sorts all documents by doc_id (nulls first; equal doc_ids by their text),
encodes each (null text: empty) with a tokenizers vocabulary inside the task that
writes it, appends the end id and writes, per range partition of that sort, one block:

- ``ids/part-NNNNNN.u16`` (``.u32`` when the vocabulary has more than 65,536 ids):
  the ids of its documents, back to back, as flat little-endian unsigned integers;
- ``offsets/part-NNNNNN.i64``: for each document its first id in the whole corpus,
  then the end of the block (n + 1 values, global positions);
- ``docs/part-NNNNNN.i64`` and ``nulls/part-NNNNNN.u8``: doc_id (0 where null) and 1
  where doc_id is null.

A task writes its block's ids while it streams the sorted rows, so no block is held
in memory; the global offsets need the ids of all blocks before, which come from a
prefix sum over the blocks' totals, one row a block. Files are written under a
temporary name and moved into place, so a task that runs again after a lost
executor replaces its block whole. ``read`` memory-maps the files (reads ranges on
remote file systems) and gives one row per document, with the CRC-32 of its ids as
little-endian unsigned 32-bit integers whatever the width on disk.

The sort moves the texts, not the ids, so its range bounds are sampled from a scan
of two columns and every text is encoded once.

Repeated rows are documents of their own. An empty table writes no block and reads
back no rows. Other columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from leadmill.llm.common import runs_of, vocabulary, whole_text, worker_value
from leadmill.llm.packing import END_ID, TOKENIZER, ChunkIds

INDEX = "block int, at bigint, doc_id bigint, local bigint, n_tokens bigint"

READ = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
#: Documents read back and given out at once.
READ_ROWS = 65_536


def file_system(folder: str):
    """The pyarrow file system of a folder (local, s3, hdfs, ...) and the path inside it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(folder if "://" in folder else f"file://{folder}")


def put(system, path: str, data: bytes | memoryview) -> None:
    """Write a whole file under a temporary name, then move it into place."""
    context = TaskContext.get()
    temporary = f"{path}.{context.attemptNumber() if context else 0}.tmp"
    with system.open_output_stream(temporary) as out:
        out.write(data)
    system.move(temporary, path)


def width_of(path: str) -> int:
    """Bytes an id takes on disk: 2 when every id of the vocabulary fits, else 4."""
    from tokenizers import Tokenizer

    return 2 if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4


def write_blocks(docs: DataFrame, folder: str, path: str, width: int, end_id: int = END_ID) -> DataFrame:
    """Sorts the documents, encodes and writes them block by block; (block, at, doc_id, local, n_tokens) per document.

    ``local`` is the document's first id inside its block, ``at`` its place there.
    """
    system, root = file_system(folder)
    for part in ("ids", "offsets", "docs", "nulls"):
        system.create_dir(f"{root}/{part}")
    kind, suffix = ("<u2", "u16") if width == 2 else ("<u4", "u32")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = worker_value(("packing", path), lambda: ChunkIds(path))
        context = TaskContext.get()
        block = context.partitionId()
        name = f"{root}/ids/part-{block:06d}.{suffix}"
        temporary = f"{name}.{context.attemptNumber()}.tmp"
        out, at, local = None, 0, 0
        for batch in batches:
            texts = batch.column(1).cast(pa.binary())
            for a, b in runs_of((len(t.as_buffer()) for t in texts), 4 << 20):
                ids = [
                    np.frombuffer(b"".join([*map(cache.__getitem__, t.split()), end_id.to_bytes(4, "little")]), "<u4")
                    for t in texts.slice(a, b - a).to_pylist()
                ]
                out = out or system.open_output_stream(temporary)
                out.write(np.concatenate(ids).astype(kind).tobytes())
                sizes = np.array([len(i) for i in ids], np.int64)
                starts = local + np.concatenate([[0], np.cumsum(sizes)[:-1]]).astype(np.int64)
                yield pa.record_batch(
                    [pa.array(np.full(b - a, block, np.int32)), pa.array(np.arange(at, at + b - a, dtype=np.int64)),
                     batch.column(0).slice(a, b - a), pa.array(starts), pa.array(sizes)],
                    names=["block", "at", "doc_id", "local", "n_tokens"],
                )
                at, local = at + b - a, local + int(sizes.sum())
        if out is not None:
            out.close()
            system.move(temporary, name)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), whole_text().alias("text"))
    return texts.orderBy(F.col("doc_id").asc_nulls_first(), "text").mapInArrow(run, INDEX)


def write_offsets(index: DataFrame, folder: str) -> list[tuple[int, int, int]]:
    """Writes the offsets and doc_ids of each block; gives (block, base, ids) of each block.

    Bases are prefix sums over the blocks' totals: one row a block reaches the driver.
    """
    spark = index.sparkSession
    totals = index.groupBy("block").agg(F.sum("n_tokens").alias("ids")).orderBy("block").collect()
    blocks, base = [], 0
    for row in totals:
        blocks.append((row.block, base, row.ids))
        base += row.ids
    bases = spark.createDataFrame(blocks, "block int, base bigint, ids bigint")
    system, root = file_system(folder)

    def run(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("at")
        block, base, total = rows["block"][0].as_py(), rows["base"][0].as_py(), rows["ids"][0].as_py()
        offsets = np.append(rows["local"].to_numpy(), total).astype(np.int64) + base
        doc_ids = rows["doc_id"].combine_chunks()
        missing = doc_ids.is_null().to_numpy(zero_copy_only=False)
        put(system, f"{root}/offsets/part-{block:06d}.i64", offsets.astype("<i8").tobytes())
        put(system, f"{root}/docs/part-{block:06d}.i64", doc_ids.fill_null(0).to_numpy().astype("<i8").tobytes())
        put(system, f"{root}/nulls/part-{block:06d}.u8", missing.astype(np.uint8).tobytes())
        return pa.table({"block": pa.array([block], pa.int32())})

    # one block's index, 32 bytes a document, in one group: blocks are bounded by the sort's partitions
    index.join(F.broadcast(bases), "block").groupBy("block").applyInArrow(run, "block int").write.format("noop").mode(
        "overwrite"
    ).save()
    return blocks


def write(docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> list[tuple[int, int, int]]:
    """Encodes and writes all documents of ``docs`` below ``folder``; gives (block, base, ids) of each block."""
    from leadmill.session import materialise

    path = path or vocabulary(TOKENIZER)
    width = width_of(path)
    system, root = file_system(folder)
    system.create_dir(root)
    put(system, f"{root}/width", str(width).encode())
    index = materialise(write_blocks(docs, folder, path, width, end_id), "token-index")
    return write_offsets(index, folder)


def block_numbers(spark: SparkSession, folder: str) -> list[int]:
    """Blocks found in the folder, one name a block."""
    system, root = file_system(folder)
    from pyarrow import fs

    found = system.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True))
    return sorted(int(f.base_name[5:11]) for f in found if f.base_name.endswith(".i64"))


def read(spark: SparkSession, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""
    system, root = file_system(folder)
    blocks = block_numbers(spark, folder)
    local = type(system).__name__ == "LocalFileSystem"
    with system.open_input_stream(f"{root}/width") as said:
        width = int(said.read())
    kind, suffix = ("<u2", "u16") if width == 2 else ("<u4", "u32")

    def opened(name: str):
        return pa.memory_map(name) if local else system.open_input_file(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in batch.column(0).to_pylist():
                part = f"part-{block:06d}"
                offsets = np.frombuffer(opened(f"{root}/offsets/{part}.i64").read(), "<i8")
                doc_ids = np.frombuffer(opened(f"{root}/docs/{part}.i64").read(), "<i8")
                nulls = np.frombuffer(opened(f"{root}/nulls/{part}.u8").read(), np.uint8).astype(bool)
                ids = opened(f"{root}/ids/{part}.{suffix}")
                base = int(offsets[0])
                for a in range(0, len(doc_ids), READ_ROWS):
                    b = min(a + READ_ROWS, len(doc_ids))
                    crc = [
                        zlib.crc32(np.frombuffer(ids.read_at(int(offsets[i + 1] - offsets[i]) * width, int(offsets[i] - base) * width), kind).astype("<u4"))
                        for i in range(a, b)
                    ]
                    yield pa.record_batch(
                        [pa.array(doc_ids[a:b], mask=nulls[a:b]), pa.array(offsets[a:b]),
                         pa.array(offsets[a + 1 : b + 1] - offsets[a:b]), pa.array(np.array(crc, np.int64))],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    listed = spark.createDataFrame([(b,) for b in blocks], "block int")
    return listed.repartition(max(1, min(len(blocks), spark.sparkContext.defaultParallelism * 4)), "block").mapInArrow(run, READ)
