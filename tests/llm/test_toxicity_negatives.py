"""Factorization machine (12) and hard negatives (13)."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from aisle.llm import hard_negatives as H
from aisle.llm import kernels as K
from aisle.llm import toxicity as X
from aisle.llm.queries import QUERIES
from tests.llm.conftest import DOCS, prose, rows_of

SF = "/root/testdata/sf0.1"


# ---- factorization machine ---------------------------------------------------

def of(texts):
    return X.terms(K.texts_of(pa.array(texts)))


def test_terms_are_distinct_words_and_heads():
    bucket, doc = of(["Stupid, stupid STUPID!", None, "", "abc", "stupid"])
    by = {d: set(bucket[doc == d].tolist()) for d in range(5)}
    assert len(by[0]) == 3 and by[0] == by[4]           # the word and its heads of 4 and 5 bytes
    assert by[1] == by[2] == set() and len(by[3]) == 1
    assert (doc == 0).sum() == 3
    assert by[0] - set(of(["stupidity"])[0].tolist()) == by[0] - set(of(["stupidly"])[0].tolist()) != by[0]


def test_margins_equal_the_sum_over_pairs():
    rng = np.random.default_rng(1)
    m = X.Model(0.3, rng.normal(size=X.BUCKETS).astype(np.float32), rng.normal(size=(X.BUCKETS, X.FACTORS)).astype(np.float32))
    texts = ["one two three four", "", "a", prose(random.Random(4), 60)]
    bucket, doc = of(texts)
    z = m.margins(bucket, doc, len(texts))
    for d in range(len(texts)):
        b = bucket[doc == d]
        pairs = sum(float(m.v[i].astype(float) @ m.v[j].astype(float)) for x, i in enumerate(b) for j in b[:x])
        want = 0.3 + m.w[b].sum(dtype=float) + pairs * X.PAIR_TERMS / max(len(b), X.PAIR_TERMS)
        assert z[d] == pytest.approx(want, rel=1e-4, abs=1e-4)


def test_interactions_that_no_sum_of_weights_can_learn():
    """Toxic only where insult and group meet: exclusive pairs of two words."""
    words = np.array([11, 12, 13, 14])                     # two of kind A, two of kind B
    rng = np.random.default_rng(3)
    rows = []
    for _ in range(400):
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((np.concatenate((words[[0, 1]] if a else words[[0]], words[[2, 3]] if b else words[[2]])), float(a != b), 1.0))
    model = X.Model(0.0, np.zeros(X.BUCKETS, np.float32), np.zeros((X.BUCKETS, X.FACTORS), np.float32))
    model.v[words] = rng.normal(0, 0.3, (4, X.FACTORS))
    for r in range(60):
        model = X.epochs(model, rows, np.random.default_rng(r))
    bucket, doc = np.concatenate([r[0] for r in rows]), np.repeat(np.arange(400), [len(r[0]) for r in rows])
    right = (model.margins(bucket, doc, 400) > 0) == np.array([r[1] > 0 for r in rows])
    assert right.mean() > 0.95                             # an additive model is right on 3 of 4 kinds at most


def test_held_out_labels(spark):
    got = QUERIES["op12_factorization_machine"](spark, SF).toPandas()
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    assert len(got) == 10000 and got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.5)).all()
    assert (got["held_out"] == got["doc_id"].map(lambda d: zlib.crc32(str(d).encode()) % 5 == 0)).all()
    held = got[got["held_out"]].merge(labels, on="doc_id")
    toxic, clean = held[held["toxic"] == 1], held[held["toxic"] == 0]
    assert (toxic["predicted"] == 1).mean() > 0.5          # 352 toxic rows to learn from; 0.99 with 1735 of them
    assert (clean["predicted"] == 1).mean() < 0.01


def test_labels_of_held_out_rows_teach_nothing(spark):
    docs = spark.createDataFrame([(i, "vile wording" if i % 2 else "fair wording") for i in range(200)], "doc_id long, text string")
    every = [(i, i % 2) for i in range(200)]
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 0
    labels = lambda rows: spark.createDataFrame(rows, "doc_id long, toxic int")
    a = X.scored(docs, X.fit(docs, labels(every))).collect()
    b = X.scored(docs, X.fit(docs, labels([(i, 1 - y if held(i) else y) for i, y in every]))).collect()
    assert sorted(a) == sorted(b)
    assert all((r["score"] >= 0.5) == bool(r["doc_id"] % 2) for r in a)


def test_edge_rows_and_missing_labels(spark, edge_docs, table):
    labels = "doc_id long, toxic int"
    folder = table(documents=edge_docs, labels=spark.createDataFrame([(0, 1), (0, 0), (3, 0), (6, None), (None, 1), (9, 1)], labels))
    got = QUERIES["op12_factorization_machine"](spark, folder).toPandas()
    assert len(got) == edge_docs.count() and got["score"].notna().all()
    docs = edge_docs.select("doc_id", "text")
    none = X.scored(docs, X.fit(docs, spark.createDataFrame([], labels)))
    assert {round(r["score"], 9) for r in none.collect()} == {0.0}
    extra = docs.unionByName(spark.createDataFrame([(None, "x")], "doc_id long, text string"))
    assert X.scored(extra, X.Model(0.0, np.zeros(X.BUCKETS, np.float32), np.zeros((X.BUCKETS, X.FACTORS), np.float32))).count() == len(got) + 1


def test_empty_tables(spark, empty_docs, table):
    folder = table(documents=empty_docs, labels=spark.createDataFrame([], "doc_id long, toxic int"))
    assert QUERIES["op12_factorization_machine"](spark, folder).count() == 0


# ---- hard negatives ------------------------------------------------------------

def brute(points, is_anchor):
    out = []
    for a, label, z in points:
        if not is_anchor(a):
            continue
        scored = sorted((-int(np.dot(np.array(z, object), np.array(y, object))), b, other) for b, other, y in points if b != a)
        for s, p, _ in [x for x in scored if x[2] == label][:5]:
            hits = [x for x in scored if x[2] != label and 50 * -s <= 100 * -x[0] <= 95 * -s]
            out += [(a, p, i + 1, b, -s, -t) for i, (t, b, _) in enumerate(hits[:3])]
    return sorted(out)


def mined(spark, points, is_anchor, tile_rows):
    df = spark.createDataFrame([(b, o, [int(x) for x in z]) for b, o, z in points], "vec_id long, label long, z array<long>")
    return sorted(tuple(r) for r in H.hard_negatives(df.repartition(4), is_anchor, tile_rows).collect())


def vectors(kind, rng):
    if kind == "clustered":
        centres = rng.normal(size=(6, 8)) * 60
        return [(int(i), int(i % 5), (centres[i % 6] + rng.normal(size=8) * 9).astype(int).tolist()) for i in range(500)]
    if kind == "ties":
        return [(int(i), int(rng.integers(0, 3)), rng.integers(0, 3, 4).tolist()) for i in range(400)]
    if kind == "copies":           # a third of all rows are one vector
        return [(int(i), int(i % 4), [5, 5, 1, 0] if i % 3 == 0 else rng.integers(-6, 7, 4).tolist()) for i in range(600)]
    return [(int(i), int(i % 7), (rng.integers(-2**40, 2**40, 3) if i % 2 else rng.integers(-9, 9, 3)).tolist()) for i in range(120)]


@pytest.mark.parametrize("kind", ["clustered", "ties", "copies", "large"])
def test_negatives_equal_brute_force(spark, kind):
    points = vectors(kind, np.random.default_rng(5))
    if kind == "large":            # products beyond 2**53 stay exact; scores fit 64 bits
        points = [(b, o, [x // 2**10 for x in z]) for b, o, z in points]
    for tile_rows in (4096, 40):
        assert mined(spark, points, F.col("vec_id") % 25 == 0, tile_rows) == brute(points, lambda a: a % 25 == 0)


def test_boxes_hold_their_products():
    rng = np.random.default_rng(2)
    z, a = rng.integers(-50, 50, (300, 6)), rng.integers(-50, 50, (20, 6))
    ids, labels = np.arange(300), rng.integers(0, 3, 300)
    order, starts = H.pack(ids, labels, z)
    assert sorted(order.tolist()) == list(range(300))
    tree = H.Tree(ids[order], labels[order], z[order], starts)
    lower, upper = H.interval(a, tree.low, tree.high)
    score = a @ tree.z.T
    for i, (s, e) in enumerate(zip(tree.starts, tree.ends)):
        assert len(set(tree.labels[s:e])) == 1 and e - s <= H.LEAF_ROWS
        assert (lower[:, i] <= score[:, s:e].min(1)).all() and (upper[:, i] >= score[:, s:e].max(1)).all()
    root = len(tree.children) - 1
    assert (upper[:, root] >= score.max(1)).all() and (lower[:, root] <= score.min(1)).all()


def test_rows_that_take_no_part(spark, table):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [0.01 * (i % 9), 0.5, -0.25], i % 3, "x") for i in range(200)]
    rows += [(None, [1.0, 1.0, 1.0], 1, "x"), (300, None, 1, "x"), (350, [1.0, None, 0.0], 1, "x"), (400, [nan, 1.0, 1.0], 1, "x"),
             (450, [inf, 1.0, 1.0], 2, "x"), (500, [0.5, 0.5, 0.5], None, "x"), (550, [0.5], 2, "x"), (600, [], 1, "x"),
             (50, [0.05, 0.5, -0.25], 50 % 3, "x")]        # the last repeats a row
    folder = table(embeddings=spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, z string"))
    got = sorted(tuple(r) for r in QUERIES["op13_rtree_negatives"](spark, folder).collect())
    seen, points = set(), []
    for b, v, o, _ in rows:
        if b is None or v is None or o is None or any(x is None or x != x or abs(x) == inf for x in v):
            continue
        z = tuple(int(np.floor(256 * np.float64(np.float32(x)))) for x in v) + (0,) * (3 - len(v))
        o = (o + 1) % 10 if b % 7 == 0 else o
        if (b, o, z) not in seen:
            seen.add((b, o, z))
            points.append((b, o, z))
    assert got == brute(points, lambda a: a % 50 == 0) and got


def test_empty_embeddings(spark, table):
    folder = table(embeddings=spark.createDataFrame([], "vec_id long, embedding array<float>, label int"))
    assert QUERIES["op13_rtree_negatives"](spark, folder).count() == 0
