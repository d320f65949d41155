"""A piece with more snippets than a shard is for never meets in one task."""

from __future__ import annotations

import random

from pyspark.sql import functions as F

from termloom.llm import suffixdedup
from tests.llm import plain

PHRASE = "this one line is in very many of the texts; "


def test_a_piece_in_many_surroundings_is_split(spark, monkeypatch):
    draw = random.Random(5)

    def noise():
        return "".join(draw.choice("abcdefghij") for _ in range(60))

    ends = [noise() for _ in range(4)]
    rows = [(i, noise() + PHRASE + draw.choice([noise(), draw.choice(ends)])) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 4000)
    sizes, plain_parts = [], suffixdedup.earlier_parts

    def watched(different, shards, span):
        by_piece = different.groupBy("piece").agg(F.sum(F.octet_length("snippet")).alias("n"))
        sizes.append(by_piece.agg(F.max("n")).first()[0] or 0)
        return plain_parts(different, shards, span)

    monkeypatch.setattr(suffixdedup, "earlier_parts", watched)
    found = suffixdedup.digest(suffixdedup.remove_repeats(docs)).collect()
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found}
    assert got == plain.repeat_rows(rows)
    assert any(r[1] for r in got.values())
    assert sizes and max(sizes) <= 4000
