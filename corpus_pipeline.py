"""From raw documents to packed training sequences, each stage on all that the one before kept.

Documents that the quality rules reject go; of each group of near duplicates, by words
in fives and a similarity of 0.8, the document with the smallest doc_id stays; secrets
are replaced by a mark, and n_chars follows; the rest is tokenised and packed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from leadmill.llm import near_dedup, packing, quality, secret_scan
from leadmill.session import materialise, scratch, scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    whole = docs.select(F.struct("*").alias("row"), "lang", "text")
    measured = materialise(quality.measure(whole, keep=("row", "lang")), "measured")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.judge(measured, labels=labels, key=F.col("row.doc_id")).where("kept").select("row.*")


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that share a doc_id are one document, of which the row with the smallest text stays.

    Rows without doc_id lose only their exact copies.
    """
    kept = near_dedup.near_duplicates(docs.where("doc_id is not null")).where("kept").select("doc_id")
    order = Window.partitionBy("doc_id").orderBy("text", *[c for c in docs.columns if c not in ("doc_id", "text")])
    one = docs.join(kept, "doc_id", "left_semi").withColumn("__row", F.row_number().over(order)).where("__row = 1").drop("__row")
    return one.select(*docs.columns).unionByName(docs.where("doc_id is null").dropDuplicates(["text"]))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_scan.redact(secret_scan.scan(docs))
    changed = F.size("spans") > 0
    return clean.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars"))).select(
        *[F.col(c.name).cast(c.dataType).alias(c.name) for c in docs.schema]
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near dedup", near_dedup_stage),
    ("secret scans", secret_scans),
    ("packing", pack),
]

#: Tokenising has no SQL; the tests hold the stages against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        with scratch(spark):  # the stage's own tables go when its result is written
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
