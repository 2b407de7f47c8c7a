import random
import re
from collections import Counter

import duckdb
import pyarrow as pa
import pytest

from aisle.llm import kernels as K
from aisle.llm import rules
from tests.llm.conftest import DOCS, edge_texts, prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    t = text or ""
    w = WORD.findall(t)
    grams = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    n, hit = Counter(grams), set()
    for i, g in enumerate(grams):
        if n[g] > 1:
            hit |= set(range(i, i + 5))
    seen, dup, full = set(), 0, 0
    for line in t.split("\n"):
        if WORD.search(line):
            full += 1
            dup += line in seen
            seen.add(line)
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(t.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": dup, "n_repeat_words": len(hit), "n_lines": full, "n_upper": len(re.findall("[A-Z]", t))}


@pytest.mark.parametrize("most", [64, 5000, K.SLICE_BYTES])
def test_counts_equal_brute_force(monkeypatch, most):
    texts = edge_texts()
    monkeypatch.setattr(K.slices, "__defaults__", (most,))
    got = rules.count_texts(pa.array(texts))
    for i, t in enumerate(texts):
        assert {c: int(got[c][i]) for c in rules.COUNTS} == brute(t), t
    sliced = rules.count_texts(pa.array(["q q", *texts]).slice(1))
    assert all((sliced[c] == got[c]).all() for c in rules.COUNTS)


def test_query_rows_and_verdict(spark, edge_docs, table):
    out = {r.doc_id: r for r in rules.op9_adaptive_rules(spark, table(documents=edge_docs)).collect()}
    for r in edge_docs.collect():
        x, b = out[r.doc_id], brute(r.text)
        assert all(x[c] == b[c] for c in rules.COUNTS[:5])
        failed = b["n_words"] < 10 or 100 * b["n_repeat_words"] > 20 * b["n_words"]
        assert x.base_failed == failed and not (failed and x.kept)
    kept = {r.doc_id for r in rules.filter_documents(edge_docs).collect()}
    assert kept == {k for k, r in out.items() if r.kept}
    assert rules.filter_documents(edge_docs).columns == edge_docs.columns


def test_sketch_quartiles_are_within_the_stated_error(spark, edge_docs):
    counted = rules.with_counts(edge_docs.select("doc_id", "lang", "source", "text"), False)
    merged = rules.sketches(counted)
    rows = [r for r in counted.collect() if not (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)]
    group = Counter((r.lang, r.source) for r in rows).most_common(1)[0][0]
    values = sorted(r.word_chars / r.n_words for r in rows if (r.lang, r.source) == group)
    limits = {(r._lang, r._source): r for r in rules.fences(merged).collect()}[group]
    q = [values[-(-len(values) * i // 4) - 1] for i in (1, 3)]
    spread = max(3 * (q[1] - q[0]), 5.0)
    assert abs(limits.mean_word_hi - (q[1] + spread)) < 0.08 * (q[1] + spread)


def test_outliers_go_and_clean_documents_stay(spark):
    rng_rows = rows_of([t for t in edge_texts()[19:]] * 4)
    rng_rows = [(i, r[1], "en", "s", *r[4:]) for i, r in enumerate(rng_rows)]
    odd = " ".join(f"wo{i}*** rd{i}%%%" for i in range(40))
    shout = " ".join(f"QU{chr(65 + i % 26)}{chr(65 + i // 26)}IET!!" for i in range(60))
    docs = spark.createDataFrame(rng_rows + [(9000, odd, "en", "s", 0, "", "", "", ""), (9001, shout, "en", "s", 0, "", "", "", "")], DOCS)
    kept = {r.doc_id for r in rules.filter_documents(docs).collect()}
    assert not kept & {9000, 9001}
    clean = {r[0] for r in rng_rows if len(WORD.findall(r[1])) >= 10}
    assert clean <= kept


def test_fences_beyond_the_broadcast_bound(spark, edge_docs, monkeypatch):
    want = sorted(r.doc_id for r in rules.filter_documents(edge_docs).collect())
    monkeypatch.setattr(rules, "BROADCAST_GROUPS", 0)
    assert sorted(r.doc_id for r in rules.filter_documents(edge_docs).collect()) == want


def test_empty_table(spark, empty_docs):
    assert rules.filter_documents(empty_docs).count() == 0


def test_base_counts_in_sql(spark, edge_docs, table):
    """The share of the contract that SQL can express."""
    folder = table(documents=edge_docs)
    got = {r.doc_id: (r.n_words, r.n_symbols) for r in rules.op9_adaptive_rules(spark, folder).collect()}
    want = duckdb.sql(rf"""SELECT doc_id, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n_words,
        length(coalesce(text, '')) - length(regexp_replace(coalesce(text, ''), '[#*$%&|<>]', '', 'g')) AS n_symbols
        FROM '{folder}/documents.parquet/*.parquet'""").fetchall()
    assert got == {d: (n, s) for d, n, s in want}


def odd(i):
    return " ".join(f"wo{i}x{j}*** rd{i}y{j}%%%" for j in range(40))


@pytest.mark.parametrize("others", [0, 300])
def test_a_source_of_a_third_junk_loses_it(spark, others):
    """Alone in the table, or beside clean sources; few rows of a group do not
    set their own fence either, and clean documents stay."""
    rng = random.Random(17)
    clean = [(i, prose(rng, rng.randint(20, 200)), "en", "s") for i in range(200 + others)]
    clean = [(i, t, g, s if i < 200 else f"t{i % 3}") for i, t, g, s in clean]
    junk = [(5000 + i, odd(i), "en", "s") for i in range(100)]
    alone = [(6000, odd(6000), "en", "rare"), (6001, odd(6001), None, None), (6002, odd(6002), "xx", "s")]
    docs = spark.createDataFrame([(*r, 0, "", "", "", "") for r in clean + junk + alone], DOCS).repartition(5)
    kept = {r.doc_id for r in rules.filter_documents(docs).collect()}
    assert kept == {r[0] for r in clean}


def test_fences_with_parents_equal_brute_force(spark, edge_docs):
    """The sketches with their parents' quantiles, rebuilt from the counts in plain Python."""
    counted = rules.with_counts(edge_docs.select("doc_id", "lang", "source", "text"), False)
    merged = rules.sketches(counted).collect()
    value = lambda b: 0.0 if b == rules.ZERO_BUCKET else rules.GAMMA ** b * 2 / (1 + rules.GAMMA)

    def at(buckets, k, of):
        """The k/of quantile of a sorted list of buckets."""
        return buckets[-(-len(buckets) * k // of) - 1]

    def points(buckets):
        return [at(sorted(buckets), k, 16) for k in range(1, 16, 2)] * 6
    by = {}
    for r in merged:
        for key in ((r.statistic,), (r.statistic, r.lang), (r.statistic, r.lang, r.source)):
            by.setdefault(key, []).extend([r.bucket] * r.n)
    for r in rules.fences(spark.createDataFrame(merged)).collect():
        for s, (_, below, above) in rules.STATISTICS.items():
            own = sorted(by.get((s, r._lang, r._source), []))
            if not own:
                continue
            lang = by[(s, r._lang)] + points(by[(s,)])
            m = [value(at(sorted(own + points(lang)), k, 4)) for k in (1, 2, 3)]
            q1, q3 = value(at(own, 1, 4)), value(at(own, 3, 4))
            if below is not None:
                want = max(q1 - max(3 * (q3 - q1), below), 2 * m[1] - m[2] - max(6 * (m[2] - m[1]), below))
                assert r[f"{s}_lo"] == pytest.approx(want)
            if above is not None:
                want = min(q3 + max(3 * (q3 - q1), above), 2 * m[1] - m[0] + max(6 * (m[1] - m[0]), above))
                assert r[f"{s}_hi"] == pytest.approx(want)
