"""The corpus pipeline: five stages from raw documents to encoded token ids."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from termloom.llm import stages
from termloom.session import stage

STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", stages.drop_toxic),
    ("near_dedup", stages.drop_near_copies),
    ("decontaminate", stages.drop_contaminated),
    ("mix", stages.mix_sources),
    ("encode", stages.encode_tokens),
]

#: Trained scores and MinHash candidates have no SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each one's rows are a table the next one reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
