"""The registered queries of the operators: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from termloom.llm import (
    decontaminate,
    egojoin,
    filteraudit,
    hosttrust,
    huffman,
    mixing,
    oddsketch,
    perfecthash,
    pseudolm,
    sharding,
    suffixdedup,
    toxicity,
    whitening,
)
from termloom.sources.tables import read_table


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op1_huffman(spark: SparkSession, sf_dir: str) -> DataFrame:
    return huffman.encoded(read_table(spark, sf_dir, "documents"), tokenizer_file())


def op2_entropy_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read_table(spark, sf_dir, "documents"))
    taken = F.col("copies") * F.col("size")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "copies")


def op3_label_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(read_table(spark, sf_dir, "documents"), 24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op4_host_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hosttrust.judge_pages(read_table(spark, sf_dir, "pages"))


def op5_suffix_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    return decontaminate.digest(decontaminate.benchmark_hits(docs, items))


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudolm.score_documents(read_table(spark, sf_dir, "documents"))


def op7_induced_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixdedup.digest(suffixdedup.remove_repeats(read_table(spark, sf_dir, "documents")))


def op8_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_odd_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return oddsketch.near_duplicates(read_table(spark, sf_dir, "documents"), 75)


def op10_epsilon_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return egojoin.near_vectors(read_table(spark, sf_dir, "embeddings"), 0.98)


def op11_qdwh_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_perfect_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perfecthash.exact_duplicates(read_table(spark, sf_dir, "documents"))


def op13_radix_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filteraudit.audit(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_huffman": op1_huffman,
        "op2_entropy_balance": op2_entropy_balance,
        "op3_label_shards": op3_label_shards,
        "op4_host_trust": op4_host_trust,
        "op5_suffix_automaton": op5_suffix_automaton,
        "op6_pseudo_likelihood": op6_pseudo_likelihood,
        "op7_induced_sort": op7_induced_sort,
        "op8_bigru": op8_bigru,
        "op9_odd_sketch": op9_odd_sketch,
        "op10_epsilon_grid": op10_epsilon_grid,
        "op11_qdwh_whitening": op11_qdwh_whitening,
        "op12_perfect_hash": op12_perfect_hash,
        "op13_radix_tries": op13_radix_tries,
    }
