"""The registered queries of the ten operators, and of the pipeline that chains some of them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadmill.llm import bpe, chat, filter_audit, fingerprint, lm_score, near_dedup, packing, prefix_trie, quality, secret_scan, sharding, token_files, url_filter
from leadmill.llm.common import table
from leadmill.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]):
    QUERIES[run.__name__] = run
    return run


@query
def op1_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


@query
def op2_sharding(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "source", "n_chars")
    return sharding.place(docs, "doc_id", sharding.shard_names())


@query
def op3_url_filters(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    rules = url_filter.mine(url_filter.labelled_urls(pages, table(spark, folder, "labels")))
    return url_filter.judge(pages, rules)


@query
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(table(spark, folder, "documents"))


@query
def op5_secret_scans(spark: SparkSession, folder: str) -> DataFrame:
    scanned = secret_scan.scan(table(spark, folder, "documents").select("doc_id", "text"))

    def count(kind: str):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return scanned.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(secret_scan.written("base_spans"), 256).alias("base_sha256"), secret_scan.written("spans").alias("spans"),
    )


@query
def op6_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    both = fingerprint.edited(table(spark, folder, "documents"))
    named = both.withColumn("edited_anchors", fingerprint.anchors(F.col("edited")))
    return named.select(
        "doc_id", F.length("text").cast("bigint").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"), fingerprint.as_text(fingerprint.sketch_of(F.col("edited_anchors"))).alias("edited_fingerprint"),
        fingerprint.aligned(F.col("anchors"), F.col("edited_anchors")).alias("near_edited"),
        fingerprint.aligned(F.col("anchors"), F.col("next_anchors")).alias("near_next"),
    )


@query
def op7_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality(table(spark, folder, "documents"), labels=table(spark, folder, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "lang", "chars_per_token", "byte_share", "bare_share", "entropy_ratio",
    )


@query
def op8_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, folder, "documents"), k=4)


@query
def op9_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.decode(bpe.encode(table(spark, folder, "documents")), digest=True)


@query
def op10_chat(spark: SparkSession, folder: str) -> DataFrame:
    turns = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], turns.schema)
    return chat.digests(chat.format_turns(turns.unionByName(planted)))


def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)


@query
def op13_token_files(spark: SparkSession, folder: str) -> DataFrame:
    written = scratch_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), written)
    return token_files.read(spark, written)


@query
def op12_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(table(spark, folder, "conversations").select("conv_id", "turn", "role", "text"))


@query
def op11_filter_audit(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(spark, f"{folder}/documents.parquet", table(spark, folder, "labels"))


SQL["op11_filter_audit"] = r"""
WITH d AS (
    SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents
), w AS (
    SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words FROM d
), lab AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels GROUP BY doc_id
), m AS (
    SELECT w.part,
        len(words) < 200 AS fa,
        100 * len(list_distinct(words)) < 50 * len(words) AS fb,
        100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) AS fc,
        regexp_matches(t, '[#$%&*|]') AS fd,
        coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY t), false) AS fe,
        coalesce(lab.good, 0) AS good, coalesce(lab.toxic, 0) AS toxic
    FROM w LEFT JOIN lab ON w.doc_id = lab.doc_id
), letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
    SELECT a.x || b.x || c.x || p.x || q.x AS filter_order
    FROM letters a, letters b, letters c, letters p, letters q
    WHERE a.x NOT IN (b.x, c.x, p.x, q.x) AND b.x NOT IN (c.x, p.x, q.x) AND c.x NOT IN (p.x, q.x) AND p.x <> q.x
), steps AS (
    SELECT filter_order, s AS step, substr(filter_order, s, 1) AS letter, substr(filter_order, 1, s - 1) AS before
    FROM orders, range(1, 6) r(s)
), parts AS (SELECT DISTINCT part FROM d), flags AS (
    SELECT m.part, filter_order, step, letter, good, toxic,
        CASE letter WHEN 'A' THEN fa WHEN 'B' THEN fb WHEN 'C' THEN fc WHEN 'D' THEN fd ELSE fe END AS fails,
        (contains(before, 'A') AND fa) OR (contains(before, 'B') AND fb) OR (contains(before, 'C') AND fc)
            OR (contains(before, 'D') AND fd) OR (contains(before, 'E') AND fe) AS earlier,
        fa::INT + fb::INT + fc::INT + fd::INT + fe::INT AS n_fails
    FROM m, steps
), counted AS (
    SELECT p.part, s.filter_order, s.step, s.letter,
        coalesce(sum(CASE WHEN NOT fails AND NOT earlier THEN 1 ELSE 0 END), 0) AS kept,
        coalesce(sum(CASE WHEN fails AND NOT earlier THEN 1 ELSE 0 END), 0) AS removed,
        coalesce(sum(CASE WHEN fails AND earlier THEN 1 ELSE 0 END), 0) AS redundant,
        coalesce(sum(CASE WHEN fails AND n_fails = 1 THEN 1 ELSE 0 END), 0) AS unique_fails,
        coalesce(sum(CASE WHEN fails AND NOT earlier AND good = 1 THEN 1 ELSE 0 END), 0) AS good_lost,
        coalesce(sum(CASE WHEN fails AND NOT earlier AND toxic = 1 THEN 1 ELSE 0 END), 0) AS toxic_lost
    FROM parts p CROSS JOIN steps s
    LEFT JOIN flags f ON f.part = p.part AND f.filter_order = s.filter_order AND f.step = s.step
    GROUP BY p.part, s.filter_order, s.step, s.letter
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
    CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
    CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted
"""
