"""Nulls, empty and odd texts, ties, repeated rows, empty tables, extra columns."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from termloom.llm import decontaminate, egojoin, hosttrust, huffman, mixing, oddsketch
from termloom.llm import pseudolm, sharding, stages, suffixdedup, toxicity
from termloom.llm.queries import tokenizer_file
from tests.llm import plain

PASSAGE = "the quick brown fox jumps over the lazy dog and runs far away from all of us today "
TEXTS = [
    (1, PASSAGE * 2 + "one two three"), (2, PASSAGE * 2 + "one two four"), (3, None), (4, ""), (5, " \n\t"),
    (6, PASSAGE * 2 + "one two three"), (7, "ab" * 400), (8, "ab" * 300 + "cd"), (9, "\x00 é ü 漢字 " * 20),
    (10, "word"), (11, "word"), (12, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 200),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n bigint, key string, size int"


def table(spark, rows=TEXTS):
    """Documents with columns whose names clash with those used inside."""
    full = [(i, t, "en", None if i and i % 5 == 0 else f"s{(i or 0) % 2}", None, 1, "k", None) for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def keyed(df, *columns):
    return {r[0]: tuple(r[c] for c in columns) for r in df.collect()}


ITEMS = "item_id bigint, text string, n bigint"


def items(spark, rows):
    return spark.createDataFrame([(i, t, 0) for i, t in rows], ITEMS)


def test_token_files(spark):
    from tokenizers import Tokenizer

    found = huffman.encoded(table(spark), tokenizer_file())
    want = plain.token_rows(TEXTS, Tokenizer.from_file(tokenizer_file()))
    assert keyed(found, "start", "n_tokens", "ids_crc32") == want
    assert huffman.encoded(table(spark, []), tokenizer_file()).count() == 0
    twice = huffman.encoded(table(spark, [(None, "x"), (1, "y"), (1, "y")]), tokenizer_file())
    assert sorted((r["start"], r["doc_id"]) for r in twice.collect()) == [(0, None), (2, 1), (4, 1)]


def test_near_duplicates(spark):
    found = oddsketch.near_duplicates(table(spark))
    assert keyed(found, "n_shingles", "component_id", "kept") == plain.near_rows(TEXTS)
    assert oddsketch.near_duplicates(table(spark, [])).count() == 0
    odd = oddsketch.near_duplicates(table(spark, [(None, "a b"), (2, "a b"), (2, "a b"), (3, "a b")]))
    got = sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in odd.collect())
    assert got == [(0, 0, True), (2, 2, True), (2, 2, True), (3, 2, False)]


def test_a_chain_of_links_is_one_component(spark):
    words = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(words[: 60 + 4 * i])) for i in range(9)]
    rows += [(100 + i, " ".join([*words[:40], *(f"x{i}y{k}" for k in range(6))])) for i in range(12)]
    found = oddsketch.near_duplicates(table(spark, rows))
    assert keyed(found, "n_shingles", "component_id", "kept") == plain.near_rows(rows)


def test_benchmark_windows(spark, monkeypatch):
    tests = [(1, PASSAGE), (2, "word"), (3, None), (4, ""), (5, "A B, c. d"), (6, "one TWO three"), (7, PASSAGE)]
    want = plain.benchmark_rows(TEXTS, tests)
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")

    def found():
        hits = decontaminate.benchmark_hits(table(spark), items(spark, tests))
        return keyed(decontaminate.digest(hits), *columns)

    assert found() == want
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", 90)
    assert found() == want
    none = decontaminate.benchmark_hits(table(spark), items(spark, []))
    assert none.count() == len(TEXTS) and none.filter(F.size("spans") > 0).count() == 0


def test_repeated_substrings(spark, monkeypatch):
    columns = ("n_bytes", "n_removed", "n_spans", "kept_sha256")

    def found():
        return keyed(suffixdedup.digest(suffixdedup.remove_repeats(table(spark))), *columns)

    assert found() == plain.repeat_rows(TEXTS)
    monkeypatch.setattr(suffixdedup, "MAX_SHARED", 1)
    monkeypatch.setattr(suffixdedup, "SHARD_BYTES", 2000)
    assert found() == plain.repeat_rows(TEXTS)
    assert suffixdedup.remove_repeats(table(spark, [])).count() == 0
    null = suffixdedup.digest(suffixdedup.remove_repeats(table(spark, [(None, PASSAGE), (1, PASSAGE), (1, PASSAGE)])))
    assert [r["n_removed"] for r in null.collect()] == [0, 0, 0]


def test_near_vectors(spark):
    rows = [
        (1, [1.0, 0.0, 0.0], 1), (2, [2.0, 0.0, 0.0], 1), (3, [1.0, 0.0, 0.0], 1), (4, [1.0, 0.0, 0.0], None),
        (5, None, 1), (6, [], 1), (7, [0.0, 0.0, 0.0], 1), (8, [float("nan"), 1.0, 0.0], 1), (9, [None, 1.0, 0.0], 1),
        (10, [1.0, 0.1, 0.0], 1), (11, [1.0, 0.25, 0.0], 1), (12, [1.0, 0.0, 0.0], 2), (13, [float("inf"), 1.0, 0.0], 1),
    ]
    df = spark.createDataFrame(
        [(i, v, x, 0, "k") for i, v, x in rows], "vec_id bigint, embedding array<float>, label int, n int, key string"
    )
    found = egojoin.near_vectors(df)
    assert keyed(found, "n_links", "component_id", "kept") == plain.vector_rows(rows)
    assert egojoin.near_vectors(df.limit(0)).count() == 0


def test_mix_of_odd_rows(spark):
    found = mixing.mix(table(spark, [*TEXTS, (None, "x y"), (1, TEXTS[0][1])]))
    got = found.collect()
    assert len(got) == len(TEXTS) + 2
    assert all(0 <= r["copies"] <= 3 for r in got)
    targets = {r["source"]: (r["target"], r["source_size"]) for r in got}
    assert sum(t for t, _ in targets.values()) == pytest.approx(sum(s for _, s in targets.values()))
    assert mixing.mix(table(spark, [])).count() == 0
    assert {r["copies"] for r in mixing.mix(table(spark, [(1, ""), (2, None)])).collect()} <= {0, 1, 3}


def test_shards_of_odd_rows(spark):
    got = sharding.shard_documents(table(spark, [*TEXTS, (None, None), (1, "again")]), 5).collect()
    assert len(got) == len(TEXTS) + 2
    by: dict[int, list] = {}
    for r in got:
        by.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in by.values()) and set(by) <= set(range(5))
    assert sharding.shard_documents(table(spark, []), 5).count() == 0


def test_a_group_larger_than_a_shard_is_cut_evenly(spark):
    rows = [(i, "same text") for i in range(200)] + [(1000 + i, f"other {i}") for i in range(400)]
    got = sharding.shard_documents(table(spark, rows), 6).collect()
    loads = [sum(r["size"] for r in got if r["shard"] == k) for k in range(6)]
    assert max(loads) - min(loads) <= 40
    held = [sum(r["doc_id"] < 1000 for r in got if r["shard"] == k) for k in range(6)]
    assert sum(n >= 20 for n in held) <= 3


def test_propagation_gathers_groups_that_start_apart(spark):
    """No shard is overfull here; labels start without regard to links."""
    rows = [(i, i // 4, 10 + i % 3) for i in range(400)]
    linked = spark.createDataFrame([(i, f"g{g}", n) for i, g, n in rows], "row bigint, grp string, size bigint")
    shards, capacity = 5, 2.0 * sum(r[2] for r in rows) / 5
    before = {r["row"]: r["shard"] for r in sharding.start_labels(linked, shards).collect()}
    after = {r["row"]: r["shard"] for r in sharding.propagate(linked, shards, capacity).collect()}
    assert before.keys() == after.keys()
    assert sum(before[i] != after[i] for i in before) > 200

    def cut(labels):
        pairs = [(i, j) for i in range(400) for j in range(i + 1, i // 4 * 4 + 4)]
        frame = spark.createDataFrame([(f"g{i // 4}", s) for i, s in labels.items()], "grp string, shard int")
        assert sharding.cut_edges(frame) == sum(labels[i] != labels[j] for i, j in pairs)
        return sharding.cut_edges(frame)

    assert cut(before) > 300 and cut(after) == 0
    loads = [sum(n for i, _, n in rows if after[i] == k) for k in range(shards)]
    assert max(loads) <= capacity


def test_hosts(spark):
    link = '<a class=x href="http://bad.net/x">'
    pages = spark.createDataFrame(
        [(1, None, None, 0), (2, "no scheme", "", 0), (3, "HTTP://Good.ORG/a?b", link, 0), (4, "x://bad.net", None, 0),
         (5, "http://a.example.com/de/1", '<A HREF=https://BAD.net#f>', 0), (5, "http://example.org/en/12", None, 0)],
        "page_id bigint, url string, html string, n int",
    )
    found = hosttrust.judge_pages(pages)
    got = sorted((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect())
    assert got == [
        (1, "", "", None, "allow"), (2, "", "", None, "allow"), (3, "good.org", "/a", "org/", "allow"),
        (4, "bad.net", "", None, "allow"), (5, "a.example.com", "/de/1", "com/de/", "block"),
        (5, "example.org", "/en/12", "example.org/en/1", "block"),
    ]
    assert hosttrust.judge_pages(pages.limit(0)).count() == 0


def test_distrust_flows_against_links(spark):
    edges = spark.createDataFrame([("a", "b", 1.0), ("b", "c", 1.0)], "source string, target string, n double")
    seed = spark.createDataFrame([("a", 1.0)], "host string, weight double")
    rank = keyed(hosttrust.personal_rank(hosttrust.shares(edges), seed), "rank")
    assert rank["a"][0] > rank["b"][0] > rank["c"][0] > 0


def test_language_model(spark):
    rows = [(i, "the cat sat on the mat and the dog ran " * 30) for i in range(20)]
    rows += [(90, "mat the on sat dog ran cat and the the " * 30), (91, None), (92, "..."), (None, "cat")]
    got = keyed(pseudolm.score_documents(table(spark, rows)), "n_words", "score")
    assert got[91] == (0, None) and got[92] == (0, None) and got[None][0] == 1
    assert got[0][1] > got[90][1]
    assert pseudolm.score_documents(table(spark, [])).count() == 0


def test_toxicity(spark):
    rows = [(i, f"plain words number {i} are here and there " * 3) for i in range(80)]
    rows += [(100 + i, f"plain words {i} you wretch and there it is " * 2) for i in range(40)]
    labels = spark.createDataFrame(
        [(i, None, int(i >= 100), "x") for i, _ in rows] + [(3, 1, None, "x"), (None, 1, 1, "x")],
        "doc_id bigint, quality int, toxic int, text string",
    )
    odd = [(900, None), (901, ""), (902, "you wretch"), (903, "..."), (904, "here and there " * 2000), (None, "x")]
    model = toxicity.fit(table(spark, rows), labels)
    got = keyed(toxicity.score(table(spark, [*rows, *odd]), model), "score")
    assert got[902][0] >= 0.3 > got[904][0]
    assert got[900] == got[901] == got[903] and len(got) == len(rows) + len(odd)
    empty = toxicity.fit(table(spark, []), labels)
    assert toxicity.score(table(spark, odd), empty).filter("score >= 0.3").count() == 0


def test_stages_keep_rows_without_an_id(spark, tmp_path):
    docs = table(spark, [*TEXTS, (None, "a row without id")]).select("doc_id", "text", "lang", "source", "n_chars")
    items(spark, [(1, PASSAGE)]).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = stages.drop_contaminated(spark, stages.drop_near_copies(spark, docs, str(tmp_path)), str(tmp_path))
    assert kept.filter("doc_id is null").count() == 1
    assert {1, 2, 6}.isdisjoint(r["doc_id"] for r in kept.collect())


def test_stages_of_odd_tables(spark, tmp_path):
    """Nulls, repeated rows, no rows, and columns named like those that stages use inside."""
    folder = str(tmp_path)
    items(spark, [(1, PASSAGE), (2, None)]).write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, 0) for i, _ in TEXTS] + [(None, 1, 1), (1, None, None)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    extra = ["_id", "_n", "_copy", "id_", "times_", "turn_", "copies", "kept", "score", "spans", "row", "target"]
    rows = [*TEXTS, (None, "a row without id"), (11, "word")]
    for docs in (table(spark, rows), table(spark, [])):
        docs = docs.select("*", *(F.lit(7).alias(name) for name in extra))
        kept = {}
        for name, step in corpus_pipeline.STAGES[:-1]:
            after = step(spark, docs, folder)
            assert after.columns == docs.columns
            kept[name] = sorted((r["doc_id"] or 0, r["text"] or "") for r in after.collect())
        plain_rows = sorted((i or 0, t or "") for i, t in rows) if docs.count() else []
        gone = {k: {r[0] for r in plain_rows} - {r[0] for r in v} for k, v in kept.items()}
        if plain_rows:
            assert kept["toxicity"] == plain_rows
            near = plain.near_rows(TEXTS)
            assert gone["near_dedup"] == {i for i, v in near.items() if not v[2]}
            assert gone["decontaminate"] == {1, 2, 6}
            assert set(kept["mix"]) <= set(plain_rows)
        else:
            assert not any(kept.values())
        encoded = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
        assert encoded.count() == len(plain_rows)
