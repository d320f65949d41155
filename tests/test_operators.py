"""Hand-worked figures on a corpus of four documents."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

import termloom as tl
from termloom.operators import clusters, index, similarity
from termloom.session import new_path

SPEC = tl.IndexSpec(text=("contents",), exact=("path", "lang"), points=("size",))
TEXTS = ["Apple banana apple", "banana cherry", "apple cherry banana", "banana can't a1.b 3,000.5"]
WORDS = ["3,000.5", "a1", "apple", "b", "banana", "can't", "cherry"]


def docs(spark, texts=TEXTS, paths=None, first_id=0):
    rows = [
        (first_id + i, (paths or [f"p{i}" for i in range(len(texts))])[i], "en", i, text)
        for i, text in enumerate(texts)
    ]
    return spark.createDataFrame(rows, "doc_id long, path string, lang string, size long, contents string")


@pytest.fixture(scope="module", params=["lazy", "stored"])
def corpus(spark, request):
    if request.param == "lazy":
        return tl.build_index(docs(spark), SPEC)
    return tl.write_index(docs(spark), SPEC, new_path(spark, "test"))


def pairs(df):
    return [tuple(row) for row in df.collect()]


def test_field_stats(corpus):
    assert pairs(tl.field_stats(corpus, "contents")) == [("contents", 4, 4, 13, 12)]
    assert sorted(pairs(tl.all_field_stats(corpus))) == [
        ("contents", 4, 4, 13, 12), ("lang", 4, 4, 4, 4), ("path", 4, 4, 4, 4)
    ]
    assert pairs(tl.field_stats(corpus, "size")) == []


def test_empty_document_counts_only_in_max_doc(spark):
    found = tl.build_index(docs(spark, [*TEXTS, "", None]), SPEC)
    assert pairs(tl.field_stats(found, "contents")) == [("contents", 6, 4, 13, 12)]


def test_vocabulary(corpus):
    want = [("contents", w) for w in WORDS] + [("lang", "en")]
    want += [("path", f"p{i}") for i in range(4)] + [("size", None)]
    assert pairs(tl.vocabulary(corpus)) == want
    assert [r["field"] for r in tl.list_fields(corpus).collect()] == list(SPEC.fields)


def test_document_frequency(corpus):
    found = {t: df for f, t, df, _ in pairs(tl.doc_freq(corpus)) if f == "contents"}
    assert found == {**dict.fromkeys(WORDS, 1), "banana": 4, "apple": 2, "cherry": 2}


def test_lookups(corpus):
    assert pairs(tl.term_vector(corpus, 0, "contents")) == [("apple", 2), ("banana", 1)]
    assert pairs(tl.term_vector(corpus, 1, "lang")) == [("en", 1)]
    assert pairs(tl.term_vector(corpus, 99, "contents")) == []
    assert sorted(pairs(tl.postings_lookup(corpus, "contents", "apple"))) == [(0, 2), (2, 1)]
    assert pairs(tl.postings_lookup(corpus, "contents", "none")) == []


def test_best_terms(corpus):
    by = {o: pairs(tl.best_terms(corpus, 0, "contents", 2, o)) for o in ("tf", "df", "tfxidf")}
    assert by["tf"] == [("apple", 2, 2, 2 * math.log10(2)), ("banana", 1, 4, 0.0)]
    assert [r[0] for r in by["df"]] == ["banana", "apple"]
    assert [r[0] for r in by["tfxidf"]] == ["apple", "banana"]
    assert [r[0] for r in pairs(tl.best_terms(corpus, 3, "contents", 2, "tf"))] == ["3,000.5", "a1"]
    assert pairs(tl.best_terms(corpus, 0, "contents", 0, "tf")) == []


@pytest.mark.parametrize("order", ["tf", "df", "tfxidf"])
def test_best_terms_of_all_documents(corpus, order):
    found = tl.best_terms_all_docs(corpus, "contents", 3, order)
    for doc in range(4):
        one = found.filter(F.col("doc_id") == doc).orderBy("rank")
        assert pairs(one.select("term", "tf", "df", "tfidf")) == pairs(
            tl.best_terms(corpus, doc, "contents", 3, order)
        )


@pytest.mark.parametrize(
    ("rep", "ranked"),
    [
        ("bin", [("apple", 1.0), ("banana", 0.707107), ("cherry", 0.5)]),
        ("tf", [("apple", 1.0), ("banana", 0.670820), ("cherry", 0.316228)]),
        ("tfxidf", [("banana", math.nan), ("apple", 1.0), ("cherry", 0.316228)]),
    ],
)
def test_similar_terms(corpus, rep, ranked):
    found = pairs(tl.similar_terms(corpus, "contents", "apple", 10, rep))
    zero = [("3,000.5", 0.0), ("a1", 0.0), ("b", 0.0), ("can't", 0.0)]
    want = ranked + zero
    assert [t for t, _ in found] == [t for t, _ in want]
    assert [s for _, s in found] == pytest.approx([s for _, s in want], abs=1e-6, nan_ok=True)
    dropped = pairs(tl.similar_terms(corpus, "contents", "apple", 2, rep, nan="drop"))
    assert dropped == [p for p in found if not math.isnan(p[1])][:2]


def test_similar_to_an_absent_or_ubiquitous_term(corpus):
    for term, rep in (("absent", "bin"), ("absent", "tfxidf"), ("banana", "tfxidf")):
        found = pairs(tl.similar_terms(corpus, "contents", term, 10, rep))
        assert [t for t, _ in found] == WORDS
        assert all(math.isnan(s) for _, s in found)


def test_similarity_of_an_exact_field(corpus):
    found = pairs(tl.similar_terms(corpus, "path", "p1", 2, "tf"))
    assert found == [("p1", 1.0), ("p0", 0.0)]


@pytest.mark.parametrize("rep", ["bin", "tf", "tfxidf"])
def test_cosine_against_dense_vectors(corpus, rep):
    """Brute force: a dense vector per term, as the definition has it."""
    weights: dict[str, list[float]] = {w: [0.0] * 4 for w in WORDS}
    for term, doc, weight in pairs(tl.term_weights(corpus, "contents", rep)):
        weights[term][doc] = weight
    norms = dict(pairs(tl.term_norms(corpus, "contents", rep)))
    dots = dict(pairs(tl.cosine_dot(corpus, "contents", "cherry", rep)))
    cosines = dict(pairs(tl.cosine_similarity(corpus, "contents", "cherry", rep)))
    length = math.hypot(*weights["cherry"])
    for term, vector in weights.items():
        dot = sum(a * b for a, b in zip(vector, weights["cherry"]))
        norm = math.hypot(*vector)
        assert norms[term] == pytest.approx(norm, abs=1e-8)
        assert dots.get(term, 0.0) == pytest.approx(dot, abs=1e-6)
        want = math.nan if norm == 0 else dot / norm / length
        assert cosines[term] == pytest.approx(want, abs=1e-7, nan_ok=True)


def test_wrong_arguments(corpus):
    with pytest.raises(ValueError, match="no field"):
        tl.similar_terms(corpus, "missing", "a", 1, "tf")
    with pytest.raises(ValueError, match="no terms"):
        tl.best_terms(corpus, 0, "size", 1, "tf")
    with pytest.raises(ValueError, match="no terms"):
        tl.best_terms(corpus, 99, "contents", 1, "tf")
    with pytest.raises(ValueError, match="order"):
        tl.best_terms(corpus, 0, "contents", 1, "idf")
    with pytest.raises(ValueError, match="rep"):
        tl.similar_terms(corpus, "contents", "a", 1, "idf")
    with pytest.raises(ValueError, match="top"):
        tl.similar_terms(corpus, "contents", "a", -1, "tf")


def test_frequent_and_rare_terms_take_both_ways(spark, corpus, monkeypatch):
    """The split join gives what the plain join gives, at every threshold."""
    want = sorted(pairs(tl.postings_with_df(corpus, "contents")))
    assert len(want) == 12
    for limit in (1, 3, 6, 100):
        monkeypatch.setattr(index, "BROADCAST_ROWS", limit)
        assert sorted(pairs(tl.postings_with_df(corpus, "contents"))) == want


@pytest.mark.parametrize("rep", ["bin", "tf", "tfxidf"])
def test_rare_and_frequent_query_terms_take_both_ways(corpus, rep, monkeypatch):
    found = []
    for limit in (0, 1, 10):
        monkeypatch.setattr(similarity, "BROADCAST_ROWS", limit)
        for term in ("apple", "b", "absent"):
            ranked = tl.similar_terms(corpus, "contents", term, 7, rep, nan="drop")
            dots = tl.cosine_dot(corpus, "contents", term, rep).orderBy("term")
            found.append((pairs(ranked), pairs(dots)))
    assert found[:3] == found[3:6] == found[6:]


# Clusters


def points(spark, values):
    rows = [(f"t{i}", float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "term string, similarity double")


def test_nearest_takes_the_lowest_index_on_a_tie(spark):
    found = tl.kmeans_assign(points(spark, [0.5, 0.9, 0.0]), [1.0, 0.0]).orderBy("term")
    assert pairs(found.select("cluster", "centroid")) == [(0, 1.0), (0, 1.0), (1, 0.0)]


def test_kmeans_fixed_point(spark, monkeypatch):
    values = [1.0, 0.9, 0.2, 0.1, 0.1]
    start = spark.createDataFrame([(0, 1.0), (1, 0.1)], "cluster int, centroid double")
    monkeypatch.setattr(clusters, "kmeans_init", lambda *_: start)
    fitted = tl.kmeans_fit(points(spark, values), 2)
    found = tl.kmeans_assign(points(spark, values), fitted)
    summary = sorted(pairs(tl.cluster_summary(found, fitted)))
    assert [s[0::2] for s in summary] == [(0, 2), (1, 3)]
    assert [s[1] for s in summary] == pytest.approx([0.95, 0.4 / 3])


def test_summary_reports_clusters_without_members(spark):
    found = tl.kmeans_assign(points(spark, [0.1, 0.2, 0.9]), [0.15, 0.5, 0.9])
    summary = sorted(pairs(tl.cluster_summary(found, [0.15, 0.5, 0.9])))
    assert summary == [(0, 0.15, 2), (1, 0.5, 0), (2, 0.9, 1)]


def test_kmeans_without_convergence_is_an_error(spark):
    values = [round(((i * 37) % 101) / 101, 9) for i in range(60)]
    with pytest.raises(RuntimeError, match="did not converge"):
        tl.kmeans_fit(points(spark, values), 4, max_iter=1)


def test_close_cosines_rank_by_their_raw_value(spark):
    """Two similarities that agree in nine places: the smaller one has the earlier name."""
    rows = spark.createDataFrame(
        [(0, "q " * 1_000 + "b " * 1_000 + "a " * 1_000), (1, "a")], "doc_id bigint, contents string"
    )
    index = tl.build_index(rows, tl.IndexSpec(text=("contents",)))
    found = pairs(tl.similar_terms(index, "contents", "q", 3, "tf"))
    assert [t for t, _ in found] == ["b", "q", "a"]
    assert 0 < found[1][1] - found[2][1] < 1e-6


def test_kmeans_is_a_lloyd_fixed_point(spark):
    values = [round(((i * 37) % 101) / 101, 9) for i in range(60)]
    for seed in (0, 1):
        found = pairs(tl.kmeans_1d(points(spark, values), 4, seed=seed))
        centroid = {c: m for c, m, _, _ in found}
        for c, mean in centroid.items():
            members = [s for k, _, _, s in found if k == c]
            assert mean == pytest.approx(sum(members) / len(members), abs=1e-9)
        for c, _, _, s in found:
            assert abs(s - centroid[c]) <= min(abs(s - m) for m in centroid.values()) + 1e-9


def test_kmeans_init_draws_distinct_values(spark):
    found = pairs(tl.kmeans_init(points(spark, [0.1, 0.1, 0.2, 0.3]), 3, seed=5))
    assert [c for c, _ in found] == [0, 1, 2]
    assert sorted(v for _, v in found) == [0.1, 0.2, 0.3]


def test_too_few_values_and_nan(spark):
    values = [1.0, 0.9, 0.2, 0.1, 0.1]
    with pytest.raises(ValueError, match="distinct"):
        tl.kmeans_1d(points(spark, values), 5)
    found = pairs(tl.kmeans_1d(points(spark, [*values, math.nan]), 4))
    assert len(found) == 5


def test_an_emptied_cluster_keeps_its_centroid(spark, monkeypatch):
    start = spark.createDataFrame([(0, 0.0), (1, 9.0), (2, 0.1)], "cluster int, centroid double")
    monkeypatch.setattr(clusters, "kmeans_init", lambda *_: start)
    assert clusters.kmeans_fit(points(spark, [0.0, 0.1, 0.2]), 3)[1] == 9.0


def test_terms_clusters(corpus):
    found = tl.terms_clusters(corpus, "contents", "apple", 10, "tfxidf", 3)
    assert sorted((t, s) for _, _, t, s in pairs(found)) == sorted(
        pairs(tl.similar_terms(corpus, "contents", "apple", 10, "tfxidf", nan="drop"))
    )


def test_a_short_list_takes_no_job_per_step(spark, monkeypatch):
    """Its centroids are those of a job per step, and the number of jobs does not grow with the steps."""
    values = [((k * 7919) % 1000 / 1000) ** 3 for k in range(1000)] + [0.5, 0.5, 1.0]
    points = spark.createDataFrame([(f"t{k}", v) for k, v in enumerate(values)], "term string, similarity double")
    calls = []
    inner = clusters.kmeans_assign
    monkeypatch.setattr(clusters, "kmeans_assign", lambda *a: calls.append(a) or inner(*a))
    short = clusters.kmeans_fit(points, 5)
    assert not calls
    monkeypatch.setattr(clusters, "SHORT", 10)
    assert clusters.kmeans_fit(points, 5) == short
    assert len(calls) > 5
