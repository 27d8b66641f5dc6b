"""Reading and writing tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T


def run_sql(spark: SparkSession, query: str, **tables: DataFrame) -> DataFrame:
    """Run SQL over registered views, or over frames named in braces."""
    return spark.sql(query, **tables)


def _write(df: DataFrame, mode: str, table: str | None, path: str | None) -> None:
    if (table is None) == (path is None):
        raise ValueError("give a table name or a path")
    writer = df.write.mode(mode)
    writer.saveAsTable(table) if table else writer.parquet(path)


def replace_table(df: DataFrame, table: str | None = None, path: str | None = None) -> None:
    _write(df, "overwrite", table, path)


def append_table(df: DataFrame, table: str | None = None, path: str | None = None) -> None:
    """Create the table with the frame's schema, or add to it."""
    _write(df, "append", table, path)


def read_csv(spark: SparkSession, uri: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header from any file system; types inferred unless a schema is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", True)
    return reader.csv(uri)


def write_csv(df: DataFrame | None, name: str) -> None:
    """Write ``{name}.csv`` with a header; nothing happens without a frame."""
    if df is not None:
        df.write.option("header", True).mode("overwrite").csv(f"{name}.csv")
