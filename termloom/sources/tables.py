"""Tables as documents: one row, one document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.functions.metadata import size_kb
from termloom.operators.index import IndexSpec
from termloom.session import spread

TABLE_SPEC = IndexSpec(
    text=("contents",),
    exact=("path", "lang", "source", "n_chars_str"),
    points=("n_chars",),
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def as_docs(table: DataFrame, doc_id: Column, path: Column) -> DataFrame:
    """The columns of ``TABLE_SPEC``; a column the table lacks is null."""

    def have(name: str, kind: str, otherwise: Column) -> Column:
        return (F.col(name) if name in table.columns else otherwise).cast(kind).alias(name)

    n_chars = have("n_chars", "bigint", F.length("text"))
    return spread(table).select(
        doc_id.cast("bigint").alias("doc_id"),
        path.alias("path"),
        F.col("text").alias("contents"),
        have("lang", "string", F.lit(None)),
        have("source", "string", F.lit(None)),
        n_chars,
        n_chars.cast("string").alias("n_chars_str"),
    )


def document_docs(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("documents/"), F.col("doc_id").cast("string"))
    return as_docs(read_table(spark, folder, "documents"), F.col("doc_id"), path)


def benchmark_docs(spark: SparkSession, folder: str) -> DataFrame:
    path = F.concat(F.lit("benchmark/"), F.col("item_id").cast("string"))
    return as_docs(read_table(spark, folder, "benchmark"), F.col("item_id"), path)


def conversation_docs(spark: SparkSession, folder: str) -> DataFrame:
    """One document per turn; the ids hold once an index is written from them."""
    turn = F.concat_ws("/", F.lit("conversations"), F.col("conv_id"), F.col("turn"))
    return as_docs(
        read_table(spark, folder, "conversations"), F.monotonically_increasing_id(), turn
    )


def doc_metadata(docs: DataFrame, text: str = "text") -> DataFrame:
    """Size of each document: bytes, whole kilobytes, and their string form."""
    kilobytes = size_kb(F.octet_length(text))
    return docs.select(
        "doc_id",
        F.octet_length(text).cast("bigint").alias("n_bytes"),
        kilobytes.alias("size_kb"),
        kilobytes.cast("string").alias("size_kb_str"),
    )
