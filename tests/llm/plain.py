"""Brute-force versions of the operators, in plain Python over small tables."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Union:
    def __init__(self, ids):
        self.parent = {i: i for i in ids}

    def root(self, i):
        while self.parent[i] != i:
            i = self.parent[i]
        return i

    def join(self, i, j):
        i, j = self.root(i), self.root(j)
        self.parent[max(i, j)] = min(i, j)


def token_rows(docs, tokenizer):
    """{doc_id: (start, n_tokens, ids_crc32)}"""
    out, at = {}, 0
    for i, text in sorted(docs):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out[i] = (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    return out


def benchmark_rows(docs, items, window=13):
    """{doc_id: (n_words, n_hit, n_items, items_sha256, contaminated)}"""

    def words(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(UPPER))

    windows = {}
    for item, text in items:
        seq = words(text)
        n = min(window, len(seq))
        for k in range(len(seq) - n + 1 if n else 0):
            windows.setdefault(n, {}).setdefault(tuple(seq[k : k + n]), set()).add(item)
    out = {}
    for i, text in docs:
        seq, found = words(text), set()
        hit = [False] * len(seq)
        for n, known in windows.items():
            for k in range(len(seq) - n + 1):
                if tuple(seq[k : k + n]) in known:
                    found |= known[tuple(seq[k : k + n])]
                    hit[k : k + n] = [True] * n
        names = hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest()
        n_hit = sum(hit)
        out[i] = (len(seq), n_hit, len(found), names, n_hit > 0 and 20 * n_hit >= len(seq))
    return out


def repeat_rows(docs, span=50):
    """{doc_id: (n_bytes, n_removed, n_spans, kept_sha256)}"""
    seen, out = set(), {}
    for i, text in sorted(docs):
        raw = (text or "").encode()
        grams = [raw[k : k + span] for k in range(len(raw) - span + 1)]
        gone = bytearray(len(raw))
        for k, gram in enumerate(grams):
            if gram in seen:
                gone[k : k + span] = b"\1" * span
        seen.update(grams)
        kept = bytes(c for c, g in zip(raw, gone, strict=True) if not g)
        spans = sum(g and not (k and gone[k - 1]) for k, g in enumerate(gone))
        out[i] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


def near_rows(docs, percent=75):
    """{doc_id: (n_shingles, component_id, kept)}"""
    sets = {}
    for i, text in docs:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(UPPER))
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or ({tuple(w)} if w else set())
    union, ids = Union(sets), sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[x + 1 :]:
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                union.join(i, j)
    return {i: (len(s), union.root(i), union.root(i) == i) for i, s in sets.items()}


def vector_rows(rows, least=0.98):
    """{vec_id: (n_links, component_id, kept)}"""
    good = {}
    for i, v, label in rows:
        x = np.array([np.nan if c is None else c for c in v], dtype=float) if v is not None else np.zeros(0)
        if label is not None and len(x) and np.isfinite(x).all() and x.any():
            good[i] = (label, x / np.linalg.norm(x))
    union, links = Union([r[0] for r in rows]), dict.fromkeys((r[0] for r in rows), 0)
    ids = sorted(good)
    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if good[i][0] == good[j][0] and good[i][1] @ good[j][1] >= least:
                links[i] += 1
                links[j] += 1
                union.join(i, j)
    return {i: (n, union.root(i), union.root(i) == i) for i, n in links.items()}
