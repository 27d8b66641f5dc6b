"""The streamed filter audit against its SQL, with retractions across files and edge rows."""

import duckdb
import pandas as pd

from leadmill.llm import filter_audit
from leadmill.llm.queries import SQL
from leadmill.session import scratch_path

LONG = " ".join(f"w{i}" for i in range(300))
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def by_sql(docs: pd.DataFrame, labels: pd.DataFrame) -> pd.DataFrame:
    con = duckdb.connect()
    con.register("documents", docs)
    con.register("labels", labels)
    return con.execute(SQL["op11_filter_audit"]).df()


def same(spark_rows, sql_rows):
    keys = ["part", "filter_order", "step"]
    a = spark_rows.sort_values(keys).reset_index(drop=True)
    b = sql_rows.sort_values(keys).reset_index(drop=True)[a.columns]
    assert len(a) == len(b)
    assert (a.astype(str).values == b.astype(str).values).all()


def test_smaller_ids_arrive_later(spark):
    files = [
        [(9, LONG, "en", "s", 1), (8, LONG, "en", "s", 1), (7, "short #", None, "s", 1), (None, LONG, "en", "s", 1)],
        [(5, LONG, "en", "s", 1), (5, LONG, "fr", "s", 1), (6, None, "en", "s", 1), (7, "short #", None, "s", 1)],
        [(1, LONG, "en", "s", 1), (2, "UPPER CASE " * 30, "de", "s", 1), (3, "a a a " * 100, "de", "s", 1)],
    ]
    folder = scratch_path(spark, "audit-files")
    for rows in files:  # three files in one folder, written one after the other
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)
    labels = spark.createDataFrame([(5, 1, 0), (5, 0, 1), (9, 1, 1), (1, 0, 0)], "doc_id bigint, quality int, toxic int")
    docs = pd.DataFrame([r for rows in files for r in rows], columns=["doc_id", "text", "lang", "source", "n_chars"])
    docs["doc_id"] = docs["doc_id"].astype("Int64")
    want = by_sql(docs, labels.toPandas())
    assert filter_audit.wave_files(spark, folder, {}) >= 3  # small files: one wave reads them all
    for per_batch in (1, None):  # a file per micro-batch, retracting across them; one wave per batch
        got = filter_audit.audit(spark, folder, labels, per_batch).toPandas()
        assert len(got) == 4 * 600
        same(got, want)


def test_empty(spark):
    folder = scratch_path(spark, "audit-empty")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(spark, folder, labels).collect() == []


def test_query_equals_sql(spark):
    from leadmill.llm import queries

    folder = "/root/testdata/sf0.001"
    got = queries.QUERIES["op11_filter_audit"](spark, folder).toPandas()
    same(got, by_sql(pd.read_parquet(f"{folder}/documents.parquet"), pd.read_parquet(f"{folder}/labels.parquet")))


class Kept:
    """The state of one key, as Spark hands it to the function."""

    exists, get = False, None

    def update(self, value):
        self.exists, self.get = True, value


def test_a_bucket_of_texts_is_one_state():
    columns = ["key", "has_id", "doc_id", "part", "mask", "good", "toxic"]
    a, b = bytes(31) + b"\x01", b"\xff" * 31 + b"\x00"  # digests may hold any byte
    batches = [
        [[(a, True, 5, "en", 1, 0, 0), (b, True, 7, "de", 0, 1, 0)], [(a, True, 9, "en", 1, 0, 0), (a, False, 0, "en", 1, 0, 0)]],
        [[(a, True, 2, "fr", 1, 0, 1), (b, True, 7, "de", 0, 1, 0), (b, True, 8, "de", 0, 0, 0)]],
        [[(a, True, -3, "fr", 1, 0, 0)], [(a, True, -3, "en", 1, 0, 0), (a, True, 2, "fr", 1, 0, 1)]],
    ]
    state, sums = Kept(), {}
    for chunks in batches:
        for out in filter_audit.retracting((0,), iter([pd.DataFrame(c, columns=columns) for c in chunks]), state):
            for *k, n in out.itertuples(index=False):
                sums[tuple(k)] = sums.get(tuple(k), 0) + n
    rows = [r for chunks in batches for c in chunks for r in c]
    lowest = {t: min(r[2] for r in rows if r[0] == t and r[1]) for t in (a, b)}
    want = {}
    for text, has_id, doc_id, part, mask, good, toxic in rows:
        k = (part, mask | (filter_audit.E_BIT if has_id and doc_id > lowest[text] else 0), good, toxic)
        want[k] = want.get(k, 0) + 1
    assert {k: n for k, n in sums.items() if n} == want


def test_python_is_called_per_bucket_and_batches_are_few(spark, tmp_path):
    docs = spark.range(3_000).selectExpr(
        "id as doc_id", "concat('text ', id % 2900) as text", "'en' as lang", "'s' as source", "9L as n_chars"
    )
    folder = str(tmp_path / "documents")
    docs.repartition(40).write.parquet(folder)
    usual = spark.conf.get(filter_audit.SHUFFLE_CONF)
    buckets = filter_audit.BUCKETS * filter_audit.state_partitions(spark, folder, {})
    assert buckets < 1_000
    with filter_audit.setting(spark, "spark.sql.files.maxPartitionBytes", "64"):
        files = filter_audit.wave_files(spark, folder, {})
    assert files == -(-40 // filter_audit.MOST_BATCHES)
    labels = spark.createDataFrame([(2_950, 1, 0)], "doc_id bigint, quality int, toxic int")
    got = filter_audit.counters(spark, folder, labels, 14).where("n <> 0").collect()
    assert spark.conf.get(filter_audit.SHUFFLE_CONF) == usual
    assert sorted((r.mask, r.good, r.toxic, r.n) for r in got) == [(1, 0, 0, 2_900), (17, 0, 0, 99), (17, 1, 0, 1)]
