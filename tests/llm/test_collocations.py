"""Phrase collocation mining (11) against brute force."""

import os
import re
from collections import Counter
from urllib.parse import urlparse

import numpy as np
import pyarrow as pa
import pytest

from aisle.llm import collocations as C
from aisle.llm import kernels as K
from aisle.session import ensure_checkpoint_dir
from tests.llm.conftest import DOCS, edge_texts, rows_of


def pieces(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def brute(rows, least, longest, top):
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, longest + 1):
                f.update((lang, tuple(w[i:i + k])) for i in range(len(w) - k + 1))
    cand = {p: a for p, a in f.items() if a >= least and len(p[1]) > 1}
    covered = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            covered |= {(lang, w[i:i + k]) for i in range(len(w) - k + 1) if 100 * a >= 100 * f[lang, w[i:i + k]]}
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) not in covered:
            cuts = [(1000 * a * n[lang] // (f[lang, w[:j]] * f[lang, w[j:]]), j, f[lang, w[:j]], f[lang, w[j:]]) for j in range(1, len(w))]
            score, _, left, right = min(cuts)
            out.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), left, right))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(found)[:top]))


def run(docs, **kw):
    return sorted(tuple(r) for r in C.collocations(docs, **kw).collect())


def test_words_follow_each_other_inside_pieces_only():
    texts = ["A b.c  d\te\nf", "", "g", " . ,", "É! h i"]
    found, follows = C.words(K.texts_of(pa.array(texts)))
    assert found.to_pylist() == ["a", "b", "c", "d", "e", "f", "g", "É", "h", "i"]
    assert follows.tolist() == [False, True, False, True, True, False, False, False, False, True]
    seq = C.with_gaps(np.arange(10), follows)
    assert seq.tolist() == [0, 1, -1, 2, 3, 4, -1, 5, -1, 6, -1, 7, -1, 8, 9]


def test_gaps_close_up():
    of = lambda x: C.closed_up(np.array(x, np.int32)).tolist()
    assert of([-1, -1, 3, 4, -1, -1, 5, -1]) == [3, 4, -1, 5]
    assert of([-1]) == of([]) == [] and of([2]) == [2]


@pytest.mark.parametrize("block", [1 << 20, 50])
def test_edge_texts_equal_brute_force(spark, edge_docs, block):
    rows = [(r.text, r.lang) for r in edge_docs.collect()]
    docs = edge_docs.select("text", "lang")
    for least, longest, top in ((2, 5, 2000), (3, 3, 7), (1, 2, 50)):
        assert run(docs, min_count=least, longest=longest, top=top, block_words=block) == brute(rows, least, longest, top)


def test_copies_overlaps_and_ties(spark):
    texts = ["x x x x x x", "to be or not to be"] * 40 + ["rare pair here"] * 3 + ["a b c d e f"] * 30 + [None, "", "  "]
    rows = [(t, None if i % 2 else "en") for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(5)
    assert run(docs, min_count=15) == brute(rows, 15, 5, 2000)


@pytest.mark.parametrize("shard_words", [1, 40])
def test_any_number_of_shards(spark, edge_docs, shard_words):
    rows = [(r.text, r.lang) for r in edge_docs.collect()]
    got = run(edge_docs.select("text", "lang"), min_count=2, block_words=60, shard_words=shard_words)
    assert got == brute(rows, 2, 5, 2000) and got


def test_packed_columns():
    rng = np.random.default_rng(5)
    for n in (0, 1, 1000):
        columns = rng.integers(-2**63, 2**63 - 1, (3, n)), rng.integers(0, 9, (1, n))
        for c in columns:
            assert (C.unpacked(C.packed(*c), len(c)) == c).all()
    assert C.opened(C.squeezed(b"")) == b"" and C.opened(C.squeezed("é a".encode())).decode() == "é a"


def test_a_block_sends_a_shard_one_small_row(spark):
    # a row per phrase and block took 18 compressed bytes in the shuffle, and 14 in the table
    rng, shards = np.random.default_rng(6), 4
    texts = [" ".join(f"w{x}" for x in (rng.zipf(1.3, 2000) % 5000)) for _ in range(30)]
    docs = spark.createDataFrame([(t, "en") for t in texts], "text string, lang string").repartition(3)
    blocks = C.word_blocks(docs, 20000).cache()
    found = C.frequent(C.dealt(blocks, shards), 5, shards).cache()
    back = found.filter("items IS NOT NULL").selectExpr("block AS within", "items")
    longer = C.next_blocks(blocks.select("block", "lang", "seq"), back, shards).cache()
    sent = longer.filter("shard IS NOT NULL").collect()
    assert blocks.count() == 3 and len(sent) == 3 * shards == len({(r.block, r.shard) for r in sent})
    ids = {r.word: r.id for r in C.once(found).collect()}
    word = {i: w for w, i in ids.items()}
    pairs, entries = Counter(), 0
    for r in sent:
        head, tail, times = C.unpacked(r.counts, 3)
        entries += len(times)
        for h, t, n in zip(np.cumsum(head).tolist(), tail.tolist(), times.tolist()):
            pairs[word[h], word[t]] += n
    assert pairs == Counter((a, b) for t in texts for w in [t.split()] for a, b in zip(w, w[1:]) if a in ids and b in ids)
    assert sum(len(r.counts) for r in sent) < 5 * entries
    for df in (blocks, found, longer):
        df.unpersist()


def test_few_files_in_the_shared_folder(spark):
    # a file for each task of each step, with processes to set its rights, showed an executor's memory twice
    def files():
        top = urlparse(ensure_checkpoint_dir(spark)).path
        return {os.path.join(at, f) for at, _, found in os.walk(top) for f in found if f.startswith("part-")}

    rows = [(f"a b c d e f {i % 7} g", "en" if i % 3 else None) for i in range(300)]
    docs = spark.createDataFrame(rows, "text string, lang string").repartition(6)
    before, stored = files(), spark.sparkContext._jsc.getPersistentRDDs().size()
    found = C.collocations(docs, min_count=20, block_words=100)
    # one shard: the sizes, the frequent items of 5 lengths and the phrases of 4, a file each
    assert 0 < len(files() - before) <= 10
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == stored
    assert sorted(tuple(r) for r in found.collect()) == brute(rows, 20, 5, 2000)


@pytest.mark.parametrize("file_shards", [1, 3])
def test_shards_share_files(spark, edge_docs, monkeypatch, file_shards):
    monkeypatch.setattr(C, "FILE_SHARDS", file_shards)
    rows = [(r.text, r.lang) for r in edge_docs.collect()]
    assert run(edge_docs.select("text", "lang"), min_count=2, block_words=60, shard_words=40) == brute(rows, 2, 5, 2000)


def test_very_long_text(spark):
    text = " ".join(f"w{i * i % 97}" for i in range(30000))
    assert run(spark.createDataFrame([(text, "en")], "text string, lang string"), min_count=100) == brute([(text, "en")], 100, 5, 2000)


def test_arithmetic_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, n, left, right = 3 * 10**12, 9 * 10**14, 10**13 + 1, 4 * 10**12 + 3
    row = spark.createDataFrame([(a, [left, 0], [right, 0], n)], "f long, begins array<long>, ends array<long>, n long")
    assert int(row.select(C.lowest_cut(2, F.col("n"))["score"]).first()[0]) == 1000 * a * n // (left * right)


def test_empty_table(spark, empty_docs):
    assert run(empty_docs) == []


def test_clashing_columns_are_not_read(spark, table):
    from aisle.llm.queries import QUERIES
    rows = rows_of(edge_texts() + ["one two three"] * 120)
    folder = table(documents=spark.createDataFrame(rows, DOCS))
    got = sorted(tuple(r) for r in QUERIES["op11_setm_collocations"](spark, folder).collect())
    assert got == brute([(r[1], r[2]) for r in rows], 100, 5, 2000) and got
