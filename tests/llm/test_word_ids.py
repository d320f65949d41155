"""Ids through the table of units are those of the whole text."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from termloom.llm import wordids
from termloom.llm.queries import tokenizer_file


@pytest.fixture(scope="module")
def encoder():
    return wordids.Encoder(tokenizer_file())


def whole(encoder, texts):
    return [np.array(e.ids, encoder.wide).tobytes() for e in encoder.tokenizer.encode_batch(texts, add_special_tokens=False)]


ODD = [
    "", " ", "\n", "a", " a", "a ", "a b", "a  b", "a\nb", "a\n\nb", "a\n\n\nb", "\n\na", "a\n", "a\n\n", "a \nb",
    "a\n b", "a\n\n b", "a\tb", "a\t b", "a \tb", "a\t\nb", "a\n\tb", "a,", "a, b", "a.b,", "(a), b", "é, b.", "it's 's",
    "x'", "don't.", "5, 6.", "a,\nb", ",", ", ,", "a\u00a0b", "a \u00a0b", "a\u2028b", "<|endoftext|>", "a<|endoftext|> b",
    "w" * 300, "a " + "w" * 255 + " b", "漢字 かな", "🙂 🙂🙂.", "a\r\nb", "\x1c a", "a|b|", "A! B? C:",
]


def test_odd_texts(encoder):
    assert encoder.encode(ODD) == whole(encoder, ODD)
    assert encoder.encode(ODD[::-1]) == whole(encoder, ODD[::-1])  # now from the table
    assert encoder.encode([]) == []


def test_gaps():
    import re

    wide = "\x1c\x85\xa0\u1680\u2000\u200a\u200b\u2028\u202f\u205f\u3000\u3001«\t"
    texts = [a + x + b for a in (" ", "\n", "z") for x in (*wide, " ", "\n") for b in (" ", "\n", "z", "")]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found = wordids.odd_gaps(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert found.tolist() == [bool(re.search(r" \s|[^\S\n ]\n|\n[^\S\n ]", t)) for t in texts]


@given(st.lists(st.text(alphabet=" \n\t.,'ab1é漢)", max_size=30), max_size=20))
@settings(max_examples=300, deadline=None)
def test_random_texts(texts):
    found = wordids.encoder(tokenizer_file())
    assert found.encode(texts) == whole(found, texts)


def test_a_full_table_starts_anew(encoder, monkeypatch):
    monkeypatch.setattr(wordids, "MOST_UNITS", 50)
    rng = random.Random(2)
    for _ in range(5):
        texts = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(100)) for _ in range(3)]
        assert encoder.encode(texts) == whole(encoder, texts)
    assert encoder.table.units < 1000


def test_a_table_of_many_units():
    table = wordids.UnitTable("<u2")
    keys = np.unique(np.random.default_rng(1).integers(1, 2**63, 200_000, dtype=np.uint64))
    for part in np.array_split(keys, 7):
        odd = part % 2 == 1
        table.add(part, odd.astype(np.int64), (part[odd] % 65_536).astype("<u2"))
    slots = table.find(keys)
    assert (slots >= 0).all() and len(set(slots.tolist())) == len(keys)
    assert (table.n[slots] == keys % 2).all()
    odd = keys % 2 == 1
    assert (table.ids[table.at[slots[odd]]] == keys[odd] % 65_536).all()
    assert (table.find(keys + np.uint64(1))[~np.isin(keys + np.uint64(1), keys)] == -1).all()
