"""Operator 12: toxicity by a factorization machine over hashed terms.

A document's terms are the distinct ones among its words (runs of letters,
lower-cased A-Z) and their first 4, 5 and 6 bytes, hashed into ``BUCKETS``
buckets; whole texts, present or absent, so the length of a text adds nothing by
itself. The score is the logistic function of

    bias + sum w[i] + scale * sum over pairs i < j of <v[i], v[j]>,

whose pair part is read from per-factor sums; ``scale`` is 1 up to ``PAIR_TERMS``
known terms and falls in proportion beyond, so that the many pairs of a long text
do not drown its words. A pair of terms, such as an insult
with the mention of a group, can count though neither does alone, which no sum
of weights can say.

Fit. The learning rows are labelled documents whose crc32(doc_id as text) mod 5
is not 0, at most ``CLASS_ROWS`` of each class by keyed hash of ``doc_id`` (a
documented bound), weighted by the class's share of all learning labels. They are
dealt into ``SHARDS`` shards; in each of ``ROUNDS`` rounds every shard runs
AdaGrad steps from the common model, with a lasso step that holds the weights of
terms of either class at zero, and the means of the shards' models, over the
shards that hold a term, are the next one. Terms of fewer than ``MIN_DOCS``
learning rows have no parameters. The driver holds the model alone.

Scoring is map-side over slices of about 1 MB of text or one longer document,
with the model (``BUCKETS`` rows) broadcast; no text is shuffled.

Defined results: a null or empty text, or one without known terms, scores the
bias; a label that is null is none; contradicting labels of an id count as toxic;
a null ``doc_id`` has no label and is not held out; without learning rows every
score is 0, with one class alone it is that class's; repeated rows score alike;
texts of any length are read whole; an empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.llm import kernels as K
from aisle.llm.store import kept

BITS = 18
BUCKETS = 1 << BITS
FACTORS = 4
HEADS = (4, 5, 6)
CLASS_ROWS = 8000
MIN_DOCS = 2
PAIR_TERMS = 32
SHARDS = 6
ROUNDS = 6
EPOCHS = 2
RATE_W, RATE_V = 0.3, 0.1
LASSO = 0.005
DECAY = 1e-5
SEED = 12

IS_LETTER = np.zeros(256, bool)
IS_LETTER[[*range(65, 91), *range(97, 123), *range(0x80, 0x100)]] = True


def terms(t: K.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of the distinct terms of every document, in order of document."""
    t = t.lower()
    s, e, doc = K.runs(t, ~IS_LETTER[t.data])
    prefix = K.prefix_hash(t)
    word = K.span_hash(prefix, s, e)
    # a word's first row stands for all of its rows in the document
    order = np.lexsort((word, doc))
    first = np.ones(len(order), bool)
    first[1:] = (word[order][1:] != word[order][:-1]) | (doc[order][1:] != doc[order][:-1])
    at = order[first]
    s, e, doc = s[at], e[at], doc[at]
    hashes, docs = [word[at]], [doc]
    for n in HEADS:
        has = e - s > n
        hashes.append(K.mix(K.span_hash(prefix, s[has], s[has] + n) + K.U64(n)))
        docs.append(doc[has])
    bucket = (np.concatenate(hashes) >> K.U64(64 - BITS)).astype(np.int64)
    key = np.unique(np.concatenate(docs) << BITS | bucket)
    return key & (BUCKETS - 1), key >> BITS


def pair_scale(n):
    """Weight of the pair part of a document with ``n`` known terms."""
    return PAIR_TERMS / np.maximum(n, PAIR_TERMS)


class Model:
    """Bias, weights (BUCKETS) and factors (BUCKETS x FACTORS)."""

    def __init__(self, bias: float, w: np.ndarray, v: np.ndarray):
        self.bias, self.w, self.v = bias, w, v

    def margins(self, bucket: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
        known = np.flatnonzero((self.w[bucket] != 0) | self.v[bucket].any(1))
        b, d = bucket[known], doc[known]
        pairs = np.zeros(n)
        for f in range(FACTORS):
            v = self.v[b, f].astype(np.float64)
            pairs += 0.5 * (np.bincount(d, v, n) ** 2 - np.bincount(d, v * v, n))
        return self.bias + np.bincount(d, self.w[b], n) + pairs * pair_scale(np.bincount(d, minlength=n))


def logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -60, 60).astype(np.float64)))


def epochs(model: Model, rows: list[tuple[np.ndarray, float, float]], rng: np.random.Generator) -> Model:
    """AdaGrad over (terms, label, weight) rows, in a random order of each epoch."""
    bias, w, v = model.bias, model.w.copy(), model.v.copy()
    gb, gw, gv = 1.0, np.ones(len(w), np.float32), np.ones(v.shape, np.float32)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            at, y, weight = rows[i]
            vs = v[at]
            total, scale = vs.sum(0), pair_scale(len(at))
            z = bias + w[at].sum() + 0.5 * scale * float((total * total - (vs * vs).sum(0)).sum())
            g = weight * float(logistic(np.array(z)) - y)
            dv = g * scale * (total - vs) + DECAY * vs
            gb += g * g
            gw[at] += g * g
            gv[at] += dv * dv
            bias -= RATE_W * g / np.sqrt(gb)
            rate = RATE_W / np.sqrt(gw[at])
            moved = w[at] - rate * g
            w[at] = np.sign(moved) * np.maximum(np.abs(moved) - rate * LASSO, 0)
            v[at] = vs - RATE_V * dv / np.sqrt(gv[at])
    return Model(bias, w, v)


def learning_labels(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of the labels that may be learned from."""
    return (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
            .groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).cast("int").alias("toxic"))
            .filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0))


def sampled(docs: DataFrame, labels: DataFrame, class_rows: int) -> tuple[DataFrame, dict[int, float]]:
    """(shard, doc_id, toxic, text) of the learning rows, and the weight of a row of each class."""
    able = kept(learning_labels(labels).join(docs.select(F.col("doc_id").cast("long").alias("doc_id")).distinct(), "doc_id"))
    count = {r["toxic"]: r["n"] for r in able.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids = [r["doc_id"] for c in count for r in
           able.filter(F.col("toxic") == c).orderBy(F.xxhash64("doc_id", F.lit(SEED)), "doc_id").limit(class_rows).collect()]
    share = {c: count[c] / min(count[c], class_rows) for c in count}
    mean = sum(share[c] * min(count[c], class_rows) for c in count) / max(1, len(ids))
    spark = docs.sparkSession
    some = spark.createDataFrame(pa.table({"doc_id": pa.array(ids, pa.int64())})).join(able, "doc_id")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # at most 2 * class_rows ids by construction
    rows = texts.join(F.broadcast(some), "doc_id")
    return (rows.withColumn("shard", F.pmod(F.xxhash64("doc_id"), F.lit(SHARDS)).cast("int")),
            {c: share[c] / mean for c in share})


def fit(docs: DataFrame, labels: DataFrame, class_rows: int = CLASS_ROWS) -> Model:
    rows, weight = sampled(docs, labels, class_rows)
    if not weight:
        return Model(-500.0, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))

    def features(batches):
        for b in batches:
            for lo, t in K.slices(b.column(3)):
                bucket, doc = terms(t)
                cut = np.searchsorted(doc, np.arange(t.n + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([*[b.column(i).slice(lo, t.n) for i in range(3)],
                                                  pa.ListArray.from_arrays(pa.array(cut), pa.array(bucket.astype(np.int32)))],
                                                 names=["shard", "doc_id", "toxic", "terms"])

    # one row per learning document: repeated rows of an id are equal or versions of it
    data = kept(rows.select("shard", "doc_id", "toxic", "text").mapInArrow(features, "shard int, doc_id long, toxic int, terms array<int>"))
    common = data.select(F.explode("terms").alias("t")).groupBy("t").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS)
    # at most BUCKETS numbers
    at = np.sort(common.toArrow()["t"].to_numpy())
    seen = np.zeros(BUCKETS, bool)
    seen[at] = True
    model = Model(0.0, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))
    model.v[at] = np.random.default_rng(SEED).normal(0, 0.02, (len(at), FACTORS))
    spark = docs.sparkSession
    for r in range(ROUNDS):
        sent = spark.sparkContext.broadcast((model, seen))

        def run(part: pa.Table) -> pa.Table:
            start, known = sent.value
            part = part.sort_by([("doc_id", "ascending")])
            lists = part["terms"].combine_chunks()
            flat, cut = lists.values.to_numpy(), lists.offsets.to_numpy()
            examples = []
            for i, y in enumerate(part["toxic"].to_pylist()):
                one = flat[cut[i]:cut[i + 1]]
                examples.append((one[known[one]], float(y), weight[y]))
            new = epochs(start, examples, np.random.default_rng([SEED, r, part["shard"][0].as_py()]))
            own = np.unique(flat)
            own = own[known[own]]
            return pa.table({"bucket": pa.array(np.concatenate(([-1], own)), pa.int64()),
                             "value": pa.array([[new.bias, *[0.0] * FACTORS], *np.column_stack((new.w[own], new.v[own])).tolist()],
                                               pa.list_(pa.float64()))})

        steps = data.groupBy("shard").applyInArrow(run, "bucket long, value array<double>")
        means = steps.groupBy("bucket").agg(*[F.avg(F.col("value")[i]).alias(f"p{i}") for i in range(FACTORS + 1)])
        # at most BUCKETS + 1 rows
        found = means.toArrow()
        b = found["bucket"].to_numpy()
        p = np.column_stack([found[f"p{i}"].to_numpy() for i in range(FACTORS + 1)])
        model = Model(float(p[b == -1, 0][0]), model.w.copy(), model.v.copy())
        model.w[b[b >= 0]], model.v[b[b >= 0]] = p[b >= 0, 0], p[b >= 0, 1:]
    return model


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            score = [np.zeros(0)]
            for _, t in K.slices(b.column(1)):
                score.append(logistic(sent.value.margins(*terms(t), t.n)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(score))], names=["doc_id", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, score double")


def op12_factorization_machine(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return scored(docs, fit(docs, labels)).select(
        "doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


# Learned; tests hold it against held-out labels, brute-force margins and an interaction
SQL = None
