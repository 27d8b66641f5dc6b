"""Inputs, word rules and token caches that the operators of this package share."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: White space of all word rules: blank, tab, newline, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
LOWER_TABLE = bytes.maketrans(UPPER, LOWER)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file, as installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def whole_text(column: str = "text") -> Column:
    """The text, with null taken as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


class Cache(dict):
    """Values by chunk of text, computed for many unknown chunks at once.

    A worker process keeps it from task to task. When it is full, only what the current
    call wants stays, so its memory is bounded; values never depend on what it holds.
    """

    def __init__(self, compute: Callable[[list], Iterable], most: int = 400_000, at_once: int = 20_000):
        super().__init__()
        self.compute, self.most, self.at_once = compute, most, at_once

    def learn(self, chunks: Iterable) -> None:
        wanted = set(chunks)
        new = list(wanted.difference(self))
        if len(self) + len(new) > self.most:
            kept = {chunk: self[chunk] for chunk in wanted if chunk in self}
            self.clear()
            self.update(kept)
        for at in range(0, len(new), self.at_once):
            part = new[at : at + self.at_once]
            self.update(zip(part, self.compute(part), strict=True))


WORKER: dict = {}


def worker_value(key: tuple, make: Callable):
    """Something costly that one worker process makes once, such as a tokenizer with its cache.

    A worker holds one such value: the next operator's takes the place of the last one's,
    whose memory goes back to the system where the C library can do that.
    """
    owner = (os.getpid(), key)
    if owner not in WORKER:
        if WORKER:
            WORKER.clear()
            with contextlib.suppress(AttributeError, OSError):
                ctypes.CDLL(None).malloc_trim(0)
        WORKER[owner] = make()
    return WORKER[owner]


BATCH_CONF, BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch", 1_000


@contextlib.contextmanager
def short_batches(spark: SparkSession) -> Iterator[None]:
    """Jobs run inside give Python at most BATCH_ROWS rows at once: both sides hold a batch beside their caches."""
    usual = spark.conf.get(BATCH_CONF)
    if 0 < int(usual) <= BATCH_ROWS:
        yield
        return
    spark.conf.set(BATCH_CONF, str(BATCH_ROWS))
    try:
        yield
    finally:
        spark.conf.set(BATCH_CONF, usual)


def runs_of(sizes: Iterable[int], most: int) -> Iterable[tuple[int, int]]:
    """Cut a list into runs whose sizes add up to about ``most``; a larger item is a run alone."""
    start, total, at = 0, 0, -1
    for at, size in enumerate(sizes):
        if at > start and total + size > most:
            yield start, at
            start, total = at, 0
        total += size
    if at >= start:
        yield start, at + 1
