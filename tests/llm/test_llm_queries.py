"""The registered queries against brute force on the smallest tables."""

from __future__ import annotations

import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest

import corpus_pipeline
from termloom.llm import queries as registry
from tests.llm import plain

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no tables")


def rows(spark, table, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(*columns).collect()]


def run(spark, name, *columns):
    found = registry.queries()[name](spark, SF_DIR)
    key = found.columns[0]
    return {r[key]: tuple(r[c] for c in columns) for r in found.collect()}


def test_token_files(spark):
    from tokenizers import Tokenizer

    want = plain.token_rows(rows(spark, "documents", "doc_id", "text"), Tokenizer.from_file(registry.tokenizer_file()))
    assert run(spark, "op1_huffman", "start", "n_tokens", "ids_crc32") == want


def test_mix(spark):
    found = registry.queries()["op2_entropy_balance"](spark, SF_DIR).collect()
    source = dict(rows(spark, "documents", "doc_id", "source"))
    assert sorted(r["doc_id"] for r in found) == sorted(source)
    sizes, taken, target = defaultdict(int), defaultdict(int), {}
    for r in found:
        s = source[r["doc_id"]]
        sizes[s] += r["size"]
        taken[s] += r["taken"]
        target[s] = r["target"]
        assert r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 3 * r["size"]
    assert sum(target.values()) == pytest.approx(sum(sizes.values()))
    for k, s in enumerate(sorted(sizes)):
        assert target[s] <= 3 * sizes[s] * (1 + 1e-12)
        assert taken[s] == pytest.approx(target[s], rel=0.05)
        below = target[s] < 3 * sizes[s] * (1 - 1e-9)
        other = sorted(sizes)[k - 1]
        if below and target[other] < 3 * sizes[other] * (1 - 1e-9):
            assert target[s] * (1 + (k - 1) % len(sizes) % 3) == pytest.approx(target[other] * (1 + k % 3))


def test_shards(spark):
    found = registry.queries()["op3_label_shards"](spark, SF_DIR).collect()
    text = dict(rows(spark, "documents", "doc_id", "text"))
    slots, loads, homes = defaultdict(list), defaultdict(int), defaultdict(set)
    for r in found:
        raw = (text[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(raw) + 8, zlib.crc32(raw))
        assert r["law"] == "bytes" and r["grown_shard"] is None
        slots[r["shard"]].append(r["slot"])
        loads[r["shard"]] += r["size"]
        homes[raw].add(r["shard"])
    assert len(found) == len(text)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(len((t or "").encode()) + 8 for t in text.values())
    assert max(loads[k] for k in range(24)) - min(loads[k] for k in range(24)) <= largest
    assert sum(len(h) > 1 for h in homes.values()) == 0


def test_url_rules(spark):
    rules = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"),
             ("allow", "com", "/fr/"), ("block", "com", "/de/")]
    found = run(spark, "op4_host_trust", "host", "path", "rule", "verdict")
    urls = rows(spark, "pages", "page_id", "url")
    assert len(urls) == len(found)
    for page, url in urls:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        cut = min([k for k in (rest.find(c) for c in "/?#") if k >= 0], default=len(rest))
        host, path = rest[:cut].translate(plain.UPPER), rest[cut:].split("?")[0].split("#")[0]
        fits = [r for r in rules if (host == r[1] or host.endswith("." + r[1])) and path.startswith(r[2])]
        best = max(fits, key=lambda r: len(r[1] + r[2]), default=None)
        assert found[page][:3] == (host, path, best and best[1] + best[2])
        assert found[page][3] == best[0] if best else found[page][3] in ("allow", "block")


def test_benchmark_windows(spark):
    want = plain.benchmark_rows(rows(spark, "documents", "doc_id", "text"), rows(spark, "benchmark", "item_id", "text"))
    columns = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    assert run(spark, "op5_suffix_automaton", *columns) == want


def test_language_model_scores(spark):
    found = run(spark, "op6_pseudo_likelihood", "n_words", "pseudo_log_likelihood", "score")
    docs = dict(rows(spark, "documents", "doc_id", "text"))
    assert set(found) == set(docs)
    for n, total, mean in found.values():
        assert np.isfinite(total) and total <= 0
        assert mean == pytest.approx(total / n) if n else mean is None


def test_repeated_substrings(spark):
    want = plain.repeat_rows(rows(spark, "documents", "doc_id", "text"))
    assert run(spark, "op7_induced_sort", "n_bytes", "n_removed", "n_spans", "kept_sha256") == want


def test_toxicity(spark):
    found = run(spark, "op8_bigru", "held_out", "score", "predicted")
    docs = rows(spark, "documents", "doc_id", "text")
    assert set(found) == {i for i, _ in docs}
    for i, (held, score, predicted) in found.items():
        assert held == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= score <= 1 and predicted == int(score >= 0.3)


def test_near_duplicates(spark):
    want = plain.near_rows(rows(spark, "documents", "doc_id", "text"))
    assert run(spark, "op9_odd_sketch", "n_shingles", "component_id", "kept") == want


def test_near_vectors(spark):
    want = plain.vector_rows(rows(spark, "embeddings", "vec_id", "embedding", "label"))
    assert run(spark, "op10_epsilon_grid", "n_links", "component_id", "kept") == want


def test_pipeline(spark):
    """Each stage keeps whole rows of its input; the last encodes what is left."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns = docs.columns
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, SF_DIR)
        assert docs.columns == columns
        after = docs.collect()
        assert after and all(before[r["doc_id"]] == r["text"] for r in after)
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert len(found) == len(after)
    assert sorted(r["doc_id"] for r in found) == sorted(r["doc_id"] for r in after)
