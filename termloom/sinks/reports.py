"""Text reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from termloom.operators.index import Index
from termloom.operators.ranking import report_lines
from termloom.operators.statistics import list_fields


def vocabulary_lines(index: Index) -> DataFrame:
    """(field, part, value): heading, terms and two blank lines of every field."""
    headings = list_fields(index).select(
        "field",
        F.lit(0).alias("part"),
        F.concat(F.lit("Terms of field '"), "field", F.lit("':")).alias("value"),
    )
    terms = index.term_stats.select("field", F.lit(1).alias("part"), F.col("term").alias("value"))
    blanks = list_fields(index).select(
        "field", F.lit(2).alias("part"), F.explode(F.array(F.lit(""), F.lit(""))).alias("value")
    )
    return headings.unionByName(terms).unionByName(blanks)


def write_vocabulary(index: Index, path: str) -> None:
    """One folder per field; its files, in name order, are the field's listing."""
    ordered = vocabulary_lines(index).repartitionByRange("field", "part", "value")
    (
        ordered.sortWithinPartitions("field", "part", "value")
        .select("field", "value")
        .write.mode("overwrite")
        .partitionBy("field")
        .text(path)
    )


def write_best_terms(ranked: DataFrame, path: str, top: int, order: str) -> None:
    """A best-terms report of one document: title, blank line, ranked terms.

    The report has at most ``top`` rows, so it is one file.
    """
    key = F.col("tfidf" if order == "tfxidf" else order)
    title = ranked.sparkSession.range(2).select(
        F.col("id").cast("int").alias("part"),
        F.when(F.col("id") == 0, F.lit(f"Top {top} terms ordered by '{order}'"))
        .otherwise("")
        .alias("line"),
        F.lit(0.0).alias("key"),
        F.lit("").alias("term"),
    )
    lines = report_lines(ranked, F.lit(2).alias("part"), key.cast("double").alias("key"), "term")
    (
        title.unionByName(lines)
        .repartition(1)
        .sortWithinPartitions("part", F.col("key").desc(), "term")
        .select("line")
        .write.mode("overwrite")
        .text(path)
    )
