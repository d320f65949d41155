"""PageRank over hosts goes on until it settles."""

from __future__ import annotations

from termloom.llm import hosttrust


def test_trust_reaches_the_end_of_a_long_chain(spark):
    edges = spark.createDataFrame(
        [(f"h{k}", f"h{k + 1}", 1.0) for k in range(12)], "source string, target string, share double"
    )
    seed = spark.createDataFrame([("h0", 1.0)], "host string, weight double")
    rank = {r["host"]: r["rank"] for r in hosttrust.personal_rank(edges, seed).collect()}
    assert all(abs(rank[f"h{k}"] - 0.15 * 0.85**k) < 1e-5 for k in range(13))
