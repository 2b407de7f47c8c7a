import hashlib
import random

import numpy as np
import pytest

from aisle.llm import fingerprints as fpr
from tests.llm.conftest import DOCS, edge_texts, prose


def brute(text):
    """Order MinHash with dicts and sorted lists."""
    codes = [ord(c) for c in text]
    if not codes:
        return np.zeros(fpr.HASHES, np.uint16)
    kmers, _ = fpr.numbered_kmers(np.array(codes, np.uint32))
    seen, numbered = {}, []
    for h in kmers.tolist():
        occ = seen.get(h, 0)
        seen[h] = occ + 1
        x = fpr.mix(np.array([(h + occ * 0xD6E8FEB86659FD93) % 2**64], np.uint64))[0]
        numbered.append(int(x) >> 32)
    best = []
    for j in range(fpr.HASHES):
        a, m = int(fpr._XOR[j, 0]), int(fpr._MUL[j, 0])
        order = sorted(range(len(numbered)), key=lambda i: ((((numbered[i] ^ a) * m) % 2**32), i))[:fpr.TUPLE]
        best.append(sorted(order) if len(order) == fpr.TUPLE else [-1, *order])
    out = []
    for j, picks in enumerate(best):
        v = fpr._SALT[j:j + 1].copy()
        for i in picks:
            part = fpr.mix(kmers[i:i + 1]) if i >= 0 else np.zeros(1, np.uint64)
            v = fpr.mix(v * np.uint64(0x9E3779B97F4A7C15) + part)
        out.append(int(v[0]) >> 48)
    return np.array(out, np.uint16)


@pytest.mark.parametrize("chunk", [3, 50, 4096])
def test_fingerprint_equals_brute_force(monkeypatch, chunk):
    monkeypatch.setattr(fpr, "CHUNK", chunk)
    rng = random.Random(4)
    for t in ["a", "ab" * 9, "x" * 40, "日本語テキスト", prose(rng, 30), "aaaa bbbb " * 20, prose(rng, 60) * 2]:
        assert (fpr.fingerprint(t) == brute(t)).all(), t
        assert (fpr.Sketched(t).fp == fpr.fingerprint(t)).all()


def test_kmers_equal_where_text_is_equal():
    t = prose(random.Random(1), 50)
    codes = fpr.code_points(t + t)
    h, _ = fpr.numbered_kmers(codes)
    n = len(fpr.code_points(t))
    assert (h[:n - fpr.KMER] == h[n:2 * n - fpr.KMER]).all()
    assert len(set(h[:n].tolist())) == len({tuple(codes[i:i + fpr.KMER]) for i in range(n)})


def test_sensitive_to_order():
    rng = random.Random(9)
    parts = [prose(rng, 60) for _ in range(10)]
    whole, turned = fpr.fingerprint(" ".join(parts)), fpr.fingerprint(" ".join(reversed(parts)))
    changed = fpr.fingerprint(" ".join(parts).replace("tion", "tian", 3))
    other = fpr.fingerprint(prose(rng, 600))
    assert fpr.likeness(whole, whole) == 1.0
    assert fpr.likeness(whole, changed) > 0.6 > fpr.likeness(whole, turned) > fpr.likeness(whole, other)


def edited(rows):
    """By the contract: descending doc_id, after the last the first."""
    rows = sorted(rows, key=lambda r: r[0], reverse=True)
    for i, (d, t) in enumerate(rows):
        own, nxt = t or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(own) // 2
        yield d, own, own[:len(own) - half] + nxt[:half], nxt


@pytest.mark.parametrize("n", [1, 2, 59])
def test_query(spark, edge_docs, table, n):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()][:n]
    docs = edge_docs.filter(edge_docs.doc_id.isin([r[0] for r in rows]))
    out = {r.doc_id: r for r in fpr.op1_order_minhash(spark, table(documents=docs)).collect()}
    assert len(out) == len(rows)
    for d, own, want, nxt in edited(rows):
        r = out[d]
        a, b, c = fpr.fingerprint(own), fpr.fingerprint(want), fpr.fingerprint(nxt)
        assert r.n_chars == len(own) and r.edited_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert r.fingerprint == a.tobytes().hex() and r.edited_fingerprint == b.tobytes().hex()
        assert r.near_edited == (a == b).mean() and r.near_next == (a == c).mean()


def test_ties_nulls_and_nothing(spark, empty_docs):
    assert fpr.compare_with_next(empty_docs).count() == 0
    rows = [(i % 5, t, "en", "s", 0, "", "", "", "") for i, t in enumerate(edge_texts()[:30])] + [(None, "q", "", "", 0, "", "", "", "")] * 3
    out = fpr.compare_with_next(spark.createDataFrame(rows, DOCS)).collect()
    assert len(out) == 33 and sum(r.doc_id is None for r in out) == 3
