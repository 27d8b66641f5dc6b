"""Filter interaction audit: what each of five filters removes, in every order, per part.

Filters fail a document when (words: maximal runs of ``[^\\x20\\x09-\\x0D]``):
A under 200 words; B 100 * distinct words < 50 * words; C 100 * ``[A-Z]`` characters
> 3 * code points; D any of ``[#$%&*|]``; E the same text as a smaller doc_id,
anywhere in the table.

A to D look at one document. E needs the whole table, and is kept up to date while
the files of the table arrive: the table is read as a stream in available-now
micro-batches, and the state holds for each text (its SHA-256) the smallest doc_id
seen and the counts of the rows that hold it. Rows above the smallest id fail E at
once. When a smaller id arrives, the rows of the old smallest id are retracted from
the counters (as passing E) and added again (as failing it). The counters, per part,
failure mask and label, are the only output of the stream; each micro-batch writes
its sums under its own batch id, so a batch that runs again replaces them.

Texts are dealt by hash into buckets, and a bucket of texts is one key of the keyed
state: Spark calls Python once per key and micro-batch at about 2 ms, which for a key
per text is most of the work. A bucket's rows of one batch reach the state in chunks
and are summed on the way, so a text with a third of all rows holds no more memory
than any other. The number of buckets follows the size of the table, so a bucket
stays small. A micro-batch writes the states of its buckets again, all of them as a
rule, so a run has at most MOST_BATCHES micro-batches.

From the counters, the 120 orders of ABCDE and their 5 steps are explained per
part: kept after the step, removed at it, redundant (failing it, removed before),
unique_fails (failing it alone), good_lost and toxic_lost (removed at it, labelled
quality = 1 or toxic = 1), shapley (its filter's removals summed over all orders).

Null text is empty; null lang is the part ''; a null doc_id is smaller than nothing
and equal to nothing, so such a row never fails E and makes no other row fail it.
Repeated rows count each. A document is good (toxic) when any of its label rows
says so. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import contextlib
import itertools
import json
import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.state import GroupStateTimeout

from leadmill.session import scratch_path

LETTERS = "ABCDE"
WORDS = r"[^\x20\x09-\x0D]+"
DELTAS = "part string, mask int, good int, toxic int, n long"
STATE = "texts binary, kinds string"
#: SHA-256 of a text, its smallest doc_id, a kind of row that holds it (its place in ``kinds``), and how many do
HELD = struct.Struct("<32sqiq")
E_BIT = 1 << 4
PARTITION_BYTES = 128 << 20  # of the table for each state partition
BUCKETS = 32  # for each state partition
MOST_BATCHES = 16
SHUFFLE_CONF = "spark.sql.shuffle.partitions"
STORE_CONF = "spark.sql.streaming.stateStore.providerClass"
PREALLOCATE_CONF = "spark.sql.streaming.stateStore.rocksdb.allowFAllocate"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, key, has_id, doc_id, mask, good, toxic): mask holds the bits of A to D (bit 0 is A)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    words = F.filter(F.split(text, WORDS.replace("^", "")), lambda w: w != "")
    n_words = F.regexp_count(text, F.lit(WORDS))
    bits = [
        n_words < 200,
        F.lit(100) * F.size(F.array_distinct(words)) < F.lit(50) * n_words,
        F.lit(100) * F.regexp_count(text, F.lit("[A-Z]")) > F.lit(3) * F.length(text),
        text.rlike("[#$%&*|]"),
    ]
    mask = sum((F.when(b, F.lit(1 << i)).otherwise(F.lit(0)) for i, b in enumerate(bits)), F.lit(0))
    marks = labels.groupBy(F.col("doc_id").alias("__label_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    measured = docs.select(
        F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), F.unhex(F.sha2(text, 256)).alias("key"),
        F.col("doc_id").cast("bigint").alias("doc_id"), mask.cast("int").alias("mask"),
    )
    # doc_id without nulls, so that it stays an exact 64-bit integer in pandas
    return measured.join(marks, measured.doc_id == marks.__label_id, "left").select(
        "part", "key", F.col("doc_id").isNotNull().alias("has_id"), F.coalesce("doc_id", F.lit(0)).alias("doc_id"), "mask",
        F.coalesce("good", F.lit(0)).alias("good"), F.coalesce("toxic", F.lit(0)).alias("toxic"),
    )


def retracting(key, chunks: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Counter deltas of one bucket of texts in one micro-batch, and its state: per text the smallest doc_id and the rows holding it.

    Rows are tallied one by one into (part, mask, good, toxic) counts; no frame is
    grouped per text, as most texts have one row.
    """
    out: dict[tuple, int] = {}
    lows: dict[bytes, tuple[int, dict]] = {}

    def add(counts: dict, e_bit: int, sign: int = 1) -> None:
        for (part, mask, good, toxic), n in counts.items():
            k = (part, mask | e_bit, good, toxic)
            out[k] = out.get(k, 0) + sign * n

    for chunk in chunks:
        columns = (chunk[c].tolist() for c in ("key", "has_id", "doc_id", "part", "mask", "good", "toxic"))
        for text, has_id, doc_id, *counted in zip(*columns, strict=True):
            k = tuple(counted)
            if not has_id:
                add({k: 1}, 0)
                continue
            low, holders = lows.get(text, (None, {}))
            if low is None or doc_id < low:
                add(holders, E_BIT)
                lows[text] = doc_id, {k: 1}
            elif doc_id == low:
                holders[k] = holders.get(k, 0) + 1
            else:
                add({k: 1}, E_BIT)
    kept: dict[bytes, tuple[int, dict]] = {}
    if state.exists and lows:
        texts, named = state.get
        kinds = [tuple(k) for k in json.loads(named)]
        for text, low, kind, n in HELD.iter_unpack(texts):
            kept.setdefault(text, (low, {}))[1][kinds[kind]] = n
    changed = False
    for text, (low, holders) in lows.items():
        old, held = kept.get(text, (None, {}))
        if old is not None and old < low:
            add(holders, E_BIT)
            continue
        changed = True
        add(holders, 0)
        if old == low:
            for k, n in holders.items():
                held[k] = held.get(k, 0) + n
        else:
            add(held, 0, -1)  # retract: the old smallest id fails E now
            add(held, E_BIT)
            kept[text] = low, holders
    if changed:
        numbers: dict[tuple, int] = {}
        texts = b"".join(
            HELD.pack(text, low, numbers.setdefault(k, len(numbers)), n) for text, (low, held) in kept.items() for k, n in held.items()
        )
        state.update((texts, json.dumps([list(k) for k in numbers])))
    if out:
        parts, masks, goods, toxics = zip(*out, strict=True)
        yield pd.DataFrame({"part": parts, "mask": masks, "good": goods, "toxic": toxics, "n": list(out.values())})


def stream_source(spark: SparkSession, path: str) -> tuple[str, dict]:
    """A file stream reads folders: a table stored as one file is its folder, filtered to its name."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if system.getFileStatus(jpath).isDirectory():
        return path, {}
    return jpath.getParent().toString(), {"pathGlobFilter": jpath.getName()}


def file_sizes(spark: SparkSession, folder: str, options: dict) -> list[int]:
    """Bytes of the table's files, from the listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    pattern = options.get("pathGlobFilter", "*.parquet")
    return [f.getLen() for f in system.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, pattern)) if f.isFile()]


def wave_files(spark: SparkSession, folder: str, options: dict) -> int:
    """Files per micro-batch: as many as one wave of the cluster reads, its cores times a read split.

    Each micro-batch costs every state partition a Python task and writes the state
    again, so batches are sized to the cluster, not to single files, and are larger
    where there would be more than MOST_BATCHES of them.
    """
    sizes = file_sizes(spark, folder, options)
    if not sizes:
        return 1
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    wave = max(1, spark.sparkContext.defaultParallelism) * split
    return max(1, -(-len(sizes) * wave // max(1, sum(sizes))), -(-len(sizes) // MOST_BATCHES))


def state_partitions(spark: SparkSession, folder: str, options: dict) -> int:
    """Partitions of the state: one per PARTITION_BYTES of the table, and at least one per core.

    Each has a store of its own and a Python task in every micro-batch, however few texts it holds.
    """
    return max(1, spark.sparkContext.defaultParallelism, -(-sum(file_sizes(spark, folder, options)) // PARTITION_BYTES))


@contextlib.contextmanager
def setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    """A setting for what starts inside; a stream keeps those it started with."""
    usual = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def counters(spark: SparkSession, documents: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """(part, mask, good, toxic, n) over all files of the table at ``documents``, streamed as available now.

    ``files_per_batch``: files per micro-batch; by default one wave of the cluster (``wave_files``).
    """
    schema = spark.read.parquet(documents).schema
    if spark.conf.get(STORE_CONF, None) is None:  # state on local disk of the executors, not in their memory
        spark.conf.set(STORE_CONF, ROCKSDB)
    if spark.conf.get(PREALLOCATE_CONF, None) is None:  # else each store reserves megabytes, however little it holds
        spark.conf.set(PREALLOCATE_CONF, "false")
    folder, options = stream_source(spark, documents)
    files_per_batch = files_per_batch or wave_files(spark, folder, options)
    stream = spark.readStream.schema(schema).options(maxFilesPerTrigger=files_per_batch, **options).parquet(folder)
    partitions = state_partitions(spark, folder, options)
    bucketed = failures(stream, labels).withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(BUCKETS * partitions)))
    deltas = bucketed.groupBy("bucket").applyInPandasWithState(
        retracting, DELTAS, STATE, "append", GroupStateTimeout.NoTimeout
    )
    out = scratch_path(spark, "audit-counters")

    def write(batch: DataFrame, batch_id: int) -> None:
        summed = batch.groupBy("part", "mask", "good", "toxic").agg(F.sum("n").alias("n"))
        summed.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    with setting(spark, SHUFFLE_CONF, str(partitions)):
        query = (
            deltas.writeStream.foreachBatch(write).option("checkpointLocation", scratch_path(spark, "audit-state"))
            .trigger(availableNow=True).start()
        )
    query.awaitTermination()
    if query.exception():
        raise query.exception()
    parts = spark.read.parquet(documents).select(F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part")).distinct()
    try:
        found = spark.read.schema(DELTAS + ", batch long").parquet(out).groupBy("part", "mask", "good", "toxic").agg(
            F.sum("n").alias("n")
        )
    except Exception as error:  # no batch had rows
        if "PATH_NOT_FOUND" not in str(error):
            raise
        found = spark.createDataFrame([], DELTAS)
    return parts.join(found, "part", "left")


def orders() -> list[tuple[str, int, str, int, int]]:
    """(filter_order, step, letter, bit of the letter, bits of the letters before): 600 rows, made by rule."""
    rows = []
    for order in map("".join, itertools.permutations(LETTERS)):
        for step in range(1, 6):
            bit = 1 << LETTERS.index(order[step - 1])
            before = sum(1 << LETTERS.index(x) for x in order[: step - 1])
            rows.append((order, step, order[step - 1], bit, before))
    return rows


def explain(counted: DataFrame) -> DataFrame:
    """Per part, order and step the seven counts, from (part, mask, good, toxic, n) counters."""
    by_mask = counted.groupBy("part").agg(
        *[
            F.sum(F.when(F.col("mask") == m, F.col("n") * weight).otherwise(0)).alias(f"{name}{m}")
            for m in range(32)
            for name, weight in (("n", F.lit(1)), ("g", F.col("good")), ("t", F.col("toxic")))
        ]
    )
    steps = F.explode(F.array(*[
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before"))
        for o, s, _, b, p in orders()
    ]))

    def total(name: str, pick) -> Column:
        return sum((F.when(pick(m), F.coalesce(F.col(f"{name}{m}"), F.lit(0))).otherwise(F.lit(0)) for m in range(32)), F.lit(0))

    bit, before = F.col("s.bit"), F.col("s.before")

    def removed(m: int) -> Column:
        return ((F.lit(m).bitwiseAND(bit)) != 0) & ((F.lit(m).bitwiseAND(before)) == 0)

    shapley = sum(
        (F.when(F.lit(m).bitwiseAND(bit) != 0, F.coalesce(F.col(f"n{m}"), F.lit(0)) * (120 // bin(m).count("1"))).otherwise(0)
         for m in range(1, 32)),
        F.lit(0),
    )
    return by_mask.select("*", steps.alias("s")).select(
        "part", "s.filter_order", F.col("s.step").cast("int").alias("step"),
        total("n", lambda m: (F.lit(m).bitwiseAND(bit.bitwiseOR(before))) == 0).cast("bigint").alias("kept"),
        total("n", removed).cast("bigint").alias("removed"),
        total("n", lambda m: ((F.lit(m).bitwiseAND(bit)) != 0) & ((F.lit(m).bitwiseAND(before)) != 0)).cast("bigint").alias("redundant"),
        total("n", lambda m: F.lit(m) == bit).cast("bigint").alias("unique_fails"),
        total("g", removed).cast("bigint").alias("good_lost"),
        total("t", removed).cast("bigint").alias("toxic_lost"),
        shapley.cast("bigint").alias("shapley"),
    )


def audit(spark: SparkSession, documents: str, labels: DataFrame, files_per_batch: int | None = None) -> DataFrame:
    """The audit of the documents table stored at ``documents`` (a folder or file of Parquet)."""
    return explain(counters(spark, documents, labels, files_per_batch))
