import random
import re

import numpy as np
import pytest

from aisle.llm import kernels as K
from aisle.llm import neardup
from tests.llm.conftest import DOCS, edge_texts, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = WORD.findall(low)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def brute(rows):
    """Smallest reachable id by comparing all pairs."""
    sets = [(d, shingles(t)) for d, t in rows]
    up = {d: d for d, _ in sets if d is not None}

    def root(x):
        while up[x] != x:
            x = up[x]
        return x
    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is None or b is None or not x or not y:
                continue
            both = len(x & y)
            if 100 * both >= 75 * (len(x) + len(y) - both):
                r, s = sorted((root(a), root(b)))
                up[s] = r
    return {d: root(d) for d in up}, {d: len(x) for d, x in sets}


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 0, "", "", "", "") for d, t in rows], DOCS).repartition(5)


def corpus():
    rng = random.Random(12)
    texts = edge_texts()
    for _ in range(12):                                      # near copies around the threshold
        base = prose(rng, rng.choice([6, 20, 60, 200])).split()
        for _ in range(7):
            w = list(base)
            for _ in range(rng.randint(0, 1 + len(w) // 40)):
                w[rng.randrange(len(w))] = "new" + str(rng.randrange(99))
            texts.append(" ".join(w))
    chain = prose(rng, 120).split()                          # a chain: only neighbours link
    for _ in range(20):
        chain = chain[4:] + prose(rng, 4).split()
        texts.append(" ".join(chain))
    rng.shuffle(texts)
    return list(enumerate(texts))


def test_components_equal_brute_force(spark, table):
    rows = corpus()
    comp, n = brute(rows)
    out = {r.doc_id: r for r in neardup.op2_minhash_dedup(spark, table(documents=frame(spark, rows))).collect()}
    assert {d: r.component_id for d, r in out.items()} == comp
    assert {d: r.n_shingles for d, r in out.items()} == n
    assert all(r.kept == (r.component_id == d) for d, r in out.items())
    assert len(set(comp.values())) < len(comp) - 60


@pytest.mark.parametrize("ids", [0, neardup.BROADCAST_IDS])
def test_hidden_links_behind_a_star(spark, monkeypatch, ids):
    """Members that link with each other but not with their buckets' smallest;
    with and without broadcast ids."""
    monkeypatch.setattr(neardup, "BROADCAST_IDS", ids)
    rng = random.Random(5)
    far = prose(rng, 400).split()
    rows = [(0, " ".join(far[:240] + prose(rng, 160).split()))]
    for i in range(1, 40):
        w = list(far)
        w[rng.randrange(400)] = f"n{i}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(neardup, "BLOCK", 8)                  # a hot bucket becomes many blocks
    got = {r.doc_id: r.component_id for r in neardup.near_duplicates(frame(spark, rows)).collect()}
    assert got == brute(rows)[0]


def test_hidden_links_of_ids_that_also_have_empty_texts(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(3)
    base = prose(rng, 200).split()
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(200)] = f"z{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    classes = neardup.sketched(frame(spark, rows)).selectExpr("doc_id AS cid", "n", "sig")
    shared = classes.selectExpr("1L AS bucket", "cid")
    empty = [(i, t) for i in range(0, 40, 2) for t in (None, "", " \n")]
    links = neardup.across_components(shared, classes, spark.createDataFrame([], "a long, b long"), frame(spark, rows + empty))
    names = {r.node: r.comp for r in neardup.components(links).collect()}
    want = brute(rows)[0]
    assert {d: names.get(d, d) for d in want} == want


def test_blocks_join_every_component(spark, monkeypatch):
    """A group of one bucket in many blocks, no star: the joins alone connect it
    as brute force does, and send no more rows than there are."""
    monkeypatch.setattr(neardup, "BLOCK", 4)
    rng = random.Random(3)
    base = prose(rng, 200).split()
    rows = []
    for i in range(40):
        w = list(base)
        for _ in range(rng.randint(1, 9)):
            w[rng.randrange(200)] = f"z{rng.randrange(10 ** 6)}"
        rows.append((i, " ".join(w)))
    docs = frame(spark, rows)
    classes = neardup.sketched(docs).selectExpr("doc_id AS cid", "n", "sig")
    shared = classes.selectExpr("1L AS bucket", "cid")
    none = spark.createDataFrame([], "a long, b long")
    links = neardup.across_components(shared, classes, none, docs)
    names = {r.node: r.comp for r in neardup.components(links).collect()}
    want = brute(rows)[0]
    assert {d: names.get(d, d) for d in want} == want and len(set(want.values())) > 1
    sets = {d: shingles(t) for d, t in rows}
    for r in links.collect():
        x, y = sets[r.a], sets[r.b]
        assert 100 * len(x & y) >= 75 * len(x | y)
    assert neardup.plausible(shared.withColumn("comp", shared.cid), classes).count() <= 40 * 10


def test_null_ids_shared_ids_and_filter(spark, empty_docs):
    a, b = prose(random.Random(1), 80), prose(random.Random(2), 80)
    rows = [(None, a), (None, a), (3, a), (3, b), (9, b), (9, b), (7, a + " x"), (11, None), (12, "")]
    got = sorted((r.doc_id or -1, r.component_id or -1) for r in neardup.near_duplicates(frame(spark, rows)).collect())
    assert got == sorted([(-1, -1), (-1, -1), (3, 3), (3, 3), (9, 3), (9, 3), (7, 3), (11, 11), (12, 12)])
    left = neardup.drop_near_duplicates(frame(spark, rows))
    assert left.columns == DOCS.names
    assert sorted(r.doc_id or -1 for r in left.collect()) == [-1, -1, 3, 11, 12]
    assert neardup.near_duplicates(empty_docs).count() == 0 and neardup.drop_near_duplicates(empty_docs).count() == 0


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randint(100, 160), rng.randint(100, 160)) for _ in range(50)]
    edges += [(200, i) for i in range(201, 260)]
    got = {r.node: r.comp for r in neardup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    up = {x: x for e in edges for x in e}
    for _ in up:
        for a, b in edges:
            up[a] = up[b] = min(up[a], up[b])
    assert got == {k: v for k, v in up.items() if any(k in e and e[0] != e[1] for e in edges)}


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(1)
    for n, common in ((4, 3), (40, 30), (2000, 1500)):
        got = []
        for _ in range(60):
            both = rng.integers(0, 2**63, common).astype(np.uint64) * np.uint64(2)
            x = np.unique(both)
            y = np.unique(np.concatenate((both, rng.integers(0, 2**63, n - common).astype(np.uint64) * np.uint64(2))))
            x, y = np.unique(K.mix(x)), np.unique(K.mix(y))
            sig = neardup.signatures(np.concatenate((x, y)), np.array([0, len(x), len(x) + len(y)]))
            got.append((sig[0] == sig[1]).mean())
        assert abs(np.mean(got) - common / n) < 0.05


@pytest.mark.parametrize("most", [50, K.SLICE_BYTES])
def test_shingle_sets(monkeypatch, most):
    import pyarrow as pa
    texts = edge_texts()
    sizes = []
    for _, t in K.slices(pa.array(texts), most):
        _, off = K.shingle_sets(t, 5)
        sizes += np.diff(off).tolist()
    assert sizes == [len(shingles(t)) for t in texts]
    sets, off = K.shingle_sets_of(pa.array(texts), 5)
    assert np.diff(off).tolist() == sizes and len(sets) == off[-1]


def test_a_hot_bucket_ships_few_rows(spark):
    """64,000 members of one bucket: beside one stranger each is sent about twice,
    with two halves once per block of the other; all pairs across are still met."""
    n = 64_000
    for stranger, most in (("id = 7", 2.2), ("id < 32000", 10)):
        rows = spark.range(n, numPartitions=8).selectExpr("1L AS bucket", "id AS cid", f"IF({stranger}, 1L, 0L) AS comp")
        sent = neardup.in_blocks(rows, "bucket", neardup.F.lit(1), neardup.BLOCK).select("cid", "comp", "own", "lo", "hi")
        assert sent.count() <= most * n
        # every block that holds one component meets every block of the other (a shared block also itself)
        met = sent.filter("lo < hi").select("lo", "hi").distinct().count()
        blocks = {c: {r.own for r in sent.filter(f"comp = {c}").select("own").distinct().collect()} for c in (0, 1)}
        assert met == len(blocks[0]) * len(blocks[1]) and not blocks[0] & blocks[1]
        assert sent.groupBy("lo", "hi").count().agg({"count": "max"}).first()[0] <= 2.2 * neardup.BLOCK


@pytest.mark.parametrize("ids", [0, neardup.BROADCAST_IDS])
def test_blocks_meet_every_pair_of_components(spark, monkeypatch, ids):
    monkeypatch.setattr(neardup, "BROADCAST_IDS", ids)
    rng = random.Random(4)
    data = [(rng.randrange(3), i, min(rng.randrange(9), rng.randrange(9)) * 1000 + i % 3 // 2 * rng.randrange(40)) for i in range(300)]
    rows = spark.createDataFrame(data, "bucket long, cid long, comp long")
    met = set()
    groups: dict = {}
    for r in neardup.in_blocks(rows, "bucket", neardup.F.lit(1), 16).collect():
        groups.setdefault((r.bucket, r.lo, r.hi), []).append(r)
    for (_, lo, hi), g in groups.items():
        met |= {(a.cid, b.cid) for a in g for b in g if a.own == lo and b.own == hi and a.comp != b.comp}
    want = {(a, b) for k, a, c in data for m, b, d in data if k == m and c != d and a < b}
    assert want <= {(min(p), max(p)) for p in met}


def test_repeated_rows_are_confirmed_once(spark):
    rng = random.Random(6)
    base = prose(rng, 80)
    rows = [(1, base)] * 300 + [(2, base + " tail")] * 300
    docs = frame(spark, rows)
    pairs = spark.createDataFrame([(1, 2)], "a long, b long")
    assert neardup.full_sets(docs, pairs.selectExpr("explode(array(a, b)) AS doc_id")).count() == 2
    assert [tuple(r) for r in neardup.confirmed(pairs, docs).collect()] == [(1, 2)]
    assert {(r.doc_id, r.component_id) for r in neardup.near_duplicates(docs).collect()} == {(1, 1), (2, 1)}


def test_marks_and_edges_equal_all_pairs():
    rng = np.random.default_rng(9)
    for _ in range(30):
        n = 150
        group = rng.integers(0, 6, n)
        sig = rng.integers(0, 60, (6, neardup.BINS))[group]
        noise = rng.random((n, neardup.BINS)) < rng.random((n, 1)) * 0.5
        sig = np.where(noise, rng.integers(100, 60000, (n, neardup.BINS)), sig).astype(np.uint16)
        comp, size = rng.integers(0, 25, n), rng.integers(90, 121, n)
        own = rng.integers(0, 2, n)
        for cross in (True, False):
            marked, edges = neardup._marks(cross, own if cross else np.zeros(n, int), comp, size, sig)
            want = np.zeros(n, bool)
            near = [(i, j) for i in range(n) for j in range(n) if i != j and comp[i] != comp[j] and (not cross or own[i] != own[j])
                    and 100 * min(size[i], size[j]) >= 75 * max(size[i], size[j])
                    and (sig[i] == sig[j]).mean() >= neardup.LEAST_ESTIMATE]

            def joined(pairs):
                up = list(range(25))
                for _ in range(25):
                    for a, b in pairs:
                        up[a] = up[b] = min(up[a], up[b])
                return up
            for i, j in near:
                want[i] = want[j] = True
            assert (marked == want).all()
            assert joined(edges) == joined([(comp[i], comp[j]) for i, j in near])
