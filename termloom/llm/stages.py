"""The stages of the corpus pipeline: (spark, docs, sf_dir) to documents or token ids.

All but the last return the columns of their input; each decides by its own input alone.
Filters decide by ``doc_id``: rows without an id stay, rows that share one stay or go
together.  Null, empty and wordless texts are neither toxic, copies nor contaminated.
Extra columns are carried through, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import decontaminate, huffman, mixing, oddsketch, toxicity
from termloom.llm.queries import tokenizer_file
from termloom.session import stage
from termloom.sources.tables import read_table


def _without(docs: DataFrame, gone: DataFrame, label: str) -> DataFrame:
    """The rows of ``docs`` whose id is not in ``gone``; rows without an id stay."""
    return docs.join(stage(gone.distinct(), label), "doc_id", "left_anti").select(*docs.columns)


def _spare(docs: DataFrame, *names: str) -> list[str]:
    """Column names that ``docs`` does not have."""
    longest = max(len(c) for c in docs.columns)
    return [f"{name}_".ljust(longest + 1, "_") for name in names]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score at the threshold or above go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return _without(
        docs, scored.filter(F.col("score") >= toxicity.THRESHOLD).select("doc_id"), "toxic-ids"
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: the one of the smallest id."""
    found = oddsketch.near_duplicates(docs, 75)
    return _without(docs, found.filter("not kept").select("doc_id"), "near-gone")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a twentieth of their words or more in benchmark windows go."""
    hits = decontaminate.digest(
        decontaminate.benchmark_hits(docs, read_table(spark, sf_dir, "benchmark"))
    )
    return _without(docs, hits.filter("contaminated").select("doc_id"), "contaminated-ids")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as many times as the mix takes it.

    Rows that share an id, or have none, are taken equally often: as often as the one of
    them that is taken most.  Documents without words are taken once.
    """
    times, turn = _spare(docs, "times", "turn")
    chosen = mixing.repeats(docs, times).filter(F.col(times) > 0)
    repeated = F.explode(F.sequence(F.lit(1), F.col(times).cast("int")))
    return chosen.withColumn(turn, repeated).select(*docs.columns)


def encode_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the written and reread token files."""
    return huffman.encoded(docs, tokenizer_file())
