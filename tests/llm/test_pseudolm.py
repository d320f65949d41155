"""The masked language model: what it trains on and what rare words cost."""

from __future__ import annotations

import numpy as np

from termloom.llm import pseudolm


def corpus(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


def test_every_word_is_a_target_once():
    bounds = np.array([0, 1, 3, 3, 10])
    place = np.arange(10) * 7
    taken = [pseudolm.targets(place, bounds, turn, 2).tolist() for turn in range(2)]
    assert sorted(sum(taken, [])) == place.tolist()
    # The same words of a document, however the documents are cut into batches.
    own = [pseudolm.targets(place[3:], bounds[3:] - 3, turn, 2).tolist() for turn in range(2)]
    assert all(set(o) == set(t) & set(place[3:].tolist()) for o, t in zip(own, taken, strict=True))


def test_words_at_all_places_are_learned(spark):
    docs = corpus(spark, ["aa bb cc dd " * 100_000] * 2)
    vocabulary = pseudolm.vocabulary_of(pseudolm.count_words(docs, "text"))
    network = pseudolm.train(docs, vocabulary)
    ids = np.tile(vocabulary.look_up(pseudolm.words_of(
        np.frombuffer(b"aa bb cc dd", np.uint8), np.array([0, 11]), pseudolm.WORD_BYTE).hashes), 5)
    padded, place = pseudolm.contexts(ids, np.array([0, 20]))
    logs = network.log_probabilities(padded, place[8:12])
    assert (logs > np.log(0.5)).all(), logs


def test_rare_words_pay_by_their_own_counts(spark):
    common = " ".join(f"w{i}" for i in range(4095)) + " "
    docs = corpus(spark, [common * 10, "often " * 8, "seldom", "never often seldom", None, ""])
    got = {r["doc_id"]: r for r in pseudolm.score_documents(docs).collect()}
    assert len(got) == 6 and got[4]["score"] is None and got[5]["pseudo_log_likelihood"] == 0
    counts = pseudolm.count_words(docs, "text")
    vocabulary = pseudolm.vocabulary_of(counts)
    assert vocabulary.other == 12  # often 9, seldom 2, never 1
    # With a network that has learned nothing, the whole sum is known.
    network = pseudolm.Network(vocabulary)
    got = {r["doc_id"]: r for r in pseudolm.score(docs, network, vocabulary, counts).collect()}
    price = dict(often=np.log(9 / 12), seldom=np.log(2 / 12), never=np.log(1 / 12))
    for i, words in ((1, ["often"] * 8), (2, ["seldom"]), (3, ["never", "often", "seldom"])):
        want = sum(vocabulary.log_share[0] + price[w] for w in words)
        assert abs(got[i]["pseudo_log_likelihood"] - want) < 1e-3


def trained_network(seed=3):
    """Parameters without zeros, in double precision where numbers are compared."""
    hashes = np.arange(pseudolm.VOCABULARY - 1, dtype=np.uint64)
    network = pseudolm.Network(pseudolm.Vocabulary.of(hashes, np.arange(pseudolm.VOCABULARY - 1, 0, -1), 50))
    rng = np.random.default_rng(seed)
    network.p = {k: v + rng.standard_normal(v.shape) * 0.2 for k, v in network.p.items()}
    return network


def plain_log_probability(p, padded, i):
    """Of the word at ``i``, straight from the definition."""
    h = p["bias"].copy()
    for k, j in enumerate([*range(i - pseudolm.REACH, i), *range(i + 1, i + pseudolm.REACH + 1)]):
        h += p["vector"][padded[j]] * p["place"][k]
    h = np.tanh(h)
    group, word = divmod(int(padded[i]), pseudolm.WITHIN)
    first = np.exp(h @ p["class"] + p["class_bias"])
    second = np.exp(h @ p["word"][group] + p["word_bias"][group])
    return np.log(first[group] / first.sum()) + np.log(second[word] / second.sum())


def sample():
    rng = np.random.default_rng(5)
    ids = np.minimum(rng.zipf(1.2, 60) - 1, pseudolm.VOCABULARY - 1)
    return pseudolm.contexts(ids, np.array([0, 1, 1, 25, 60]))


def test_scores_are_those_of_the_definition():
    network = trained_network()
    padded, place = sample()
    got = np.concatenate([network.log_probabilities(w, at) for _, w, at in pseudolm.batches_of(padded, place)])
    want = [plain_log_probability(network.p, padded, i) for i in place]
    assert np.allclose(got, want, rtol=1e-6, atol=1e-6)


def test_gradients_are_those_of_small_steps():
    network = trained_network()
    padded, place = sample()
    at = place[::2]
    found = network.gradients(padded, at)
    rng = np.random.default_rng(1)

    def loss():
        return -np.mean([plain_log_probability(network.p, padded, i) for i in at])

    for name, g in found.items():
        assert g.shape == network.p[name].shape
        used = np.flatnonzero(g)
        for flat in rng.choice(used, min(6, len(used)), replace=False):
            where = np.unravel_index(flat, g.shape)
            kept = network.p[name][where]
            network.p[name][where] = kept + 1e-4
            up = loss()
            network.p[name][where] = kept - 1e-4
            down = loss()
            network.p[name][where] = kept
            assert abs((up - down) / 2e-4 - g[where]) < 1e-5, (name, where)


def test_steep_logits_stay_finite():
    network = trained_network()
    network.p["class"] *= 1e4
    network.p["word"] *= -1e4
    padded, place = sample()
    assert np.isfinite(network.log_probabilities(padded, place)).all()
    assert all(np.isfinite(g).all() for g in network.gradients(padded, place).values())


def test_words_are_looked_up_without_a_search(monkeypatch):
    rng = np.random.default_rng(4)
    hashes = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))[: pseudolm.VOCABULARY - 1]
    hashes[1:4] = hashes[0] + np.arange(1, 4, dtype=np.uint64)  # the same leading bits
    hashes = rng.permutation(hashes)
    vocabulary = pseudolm.Vocabulary.of(hashes, np.arange(len(hashes), 0, -1), 7)
    monkeypatch.setattr(np, "searchsorted", None)
    assert (vocabulary.look_up(hashes) == np.arange(len(hashes)) + 1).all()
    others = np.append(np.setdiff1d(hashes + np.uint64(9), hashes), np.uint64(2**64 - 1))
    assert not vocabulary.look_up(others).any()
