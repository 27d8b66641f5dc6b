"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
LOCAL_FOLDERS: dict[str, str] = {}
CURRENT: ContextVar[str | None] = ContextVar("leadmill_scratch", default=None)


def local_session(app: str, cores: int | str = "*", **conf: str) -> SparkSession:
    """A session for tests and benchmarks; on a cluster the caller brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder the cluster names; a local folder only in local mode."""
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder every executor can reach")
    return LOCAL_FOLDERS.setdefault(spark.sparkContext.applicationId, tempfile.mkdtemp(prefix="leadmill-"))


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """Intermediate tables written inside go to one folder, which is deleted at the end.

    Write or collect the result before leaving: it may read those tables.
    """
    folder = f"{scratch_root(spark).rstrip('/')}/run-{uuid.uuid4().hex}"
    token = CURRENT.set(folder)
    try:
        yield folder
    finally:
        CURRENT.reset(token)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{CURRENT.get() or scratch_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage without relying on executor-local blocks: a lost executor
    costs a re-read, not a recomputation with other range bounds.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
