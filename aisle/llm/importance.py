"""Operator 6: importance resampling with hashed n-gram models.

Words and word pairs (lower-cased A-Z) fall into ``BUCKETS`` hash buckets. The
raw model counts the grams of all documents; the target model those of a bounded
sample of labelled clean documents (quality 1, not toxic; at most
``TARGET_ROWS``, by keyed hash of ``doc_id``). A document's log weight is the
sum over its grams of ``log p_target - log p_raw`` (add-one smoothing). Adding
Gumbel noise, keyed by the row, and taking the k largest draws k documents
without replacement in proportion to their weights.

k is the share of quality 1 among all labelled documents of the input, counted
by a join, plus ``SLACK``, times the rows: a table that is already clean is kept
almost whole. Documents tied with the k-th are kept too.

Every task sends one count vector; they are summed by bucket, and the two
vectors of ``BUCKETS`` numbers are broadcast. The k-th key is found by
narrowing ranges of bucket counts, never by one global sort.

Defined results: a document without words has weight 0 and takes part; a null
``doc_id`` has no label; without labelled clean documents in the input all
weights are 0, and without any labelled document all are kept; labels that
contradict each other count as bad; repeated rows share key and fate; an empty
table gives no rows; further columns pass through ``resample_documents``.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.llm import kernels as K
from aisle.llm.store import kept, packed
from aisle.operators.prefix import bucket_by, cut_points

BITS = 17
BUCKETS = 1 << BITS
TARGET_ROWS = 20_000
SLACK = 0.005
SEED = 6


def grams(t: K.Texts) -> tuple[np.ndarray, np.ndarray]:
    """(bucket, document) of every word and pair of consecutive words."""
    t = t.lower()
    s, e, wdoc = K.words(t)
    wh = K.span_hash(K.prefix_hash(t), s, e)
    pair, at = K.word_grams(wh, wdoc, 2)
    h = np.concatenate((K.mix(wh), pair))
    return (h >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate((wdoc, wdoc[at]))


def by_document(labels: DataFrame) -> DataFrame:
    """One row (doc_id, quality, toxic) per labelled document."""
    return (labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
            .agg(F.min(F.coalesce("quality", F.lit(0))).alias("quality"), F.max(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def target_sample(one: DataFrame) -> list[int]:
    """Ids of at most TARGET_ROWS labelled clean documents."""
    order = [F.xxhash64("doc_id", F.lit(SEED)), F.col("doc_id")]
    return [r["doc_id"] for r in one.filter("quality = 1 AND toxic = 0").orderBy(*order).limit(TARGET_ROWS).select("doc_id").collect()]


def label_counts(docs: DataFrame, one: DataFrame) -> tuple[int, int]:
    """Rows of ``docs`` that are labelled good, and bad; an id's rows are counted
    before the join, so a repeated one is a single row in it."""
    ids = docs.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.count(F.lit(1)).alias("n"))
    good = F.col("quality") == 1
    r = (ids.join(one.select("doc_id", "quality"), "doc_id")
         .agg(F.sum(F.when(good, F.col("n")).otherwise(0)).alias("good"),
              F.sum(F.when(good, 0).otherwise(F.col("n"))).alias("bad")).first())
    return r["good"] or 0, r["bad"] or 0


class Model:
    """Bucket log ratios, the number of rows to keep of ``rows``."""

    def __init__(self, ratio: np.ndarray, rows: int, keep: int):
        self.ratio, self.rows, self.keep = ratio, rows, keep


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    one = by_document(labels)
    good, bad = label_counts(docs, one)
    sent = spark.sparkContext.broadcast(np.sort(np.array(target_sample(one), np.int64)))

    def run(batches):
        target = sent.value
        raw, aim = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        n = 0
        for b in batches:
            null = b.column(0).is_null().to_numpy(zero_copy_only=False)
            ids = b.column(0).fill_null(0).to_numpy(zero_copy_only=False)
            inside = np.isin(ids, target) & ~null
            n += len(ids)
            for lo, t in K.slices(b.column(1)):
                h, doc = grams(t)
                raw += np.bincount(h, minlength=BUCKETS)
                aim += np.bincount(h[inside[lo + doc]], minlength=BUCKETS)
        at = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate((at, [BUCKETS]))), pa.array(np.concatenate((raw[at], [n]))),
             pa.array(np.concatenate((aim[at], [0])))],
            names=["bucket", "raw", "aim"])

    counts = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "bucket long, raw long, aim long")
              .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("aim").alias("aim")))
    # BUCKETS + 1 rows by construction
    found = counts.toArrow()
    raw, aim = np.zeros(BUCKETS + 1), np.zeros(BUCKETS + 1)
    at = found["bucket"].to_numpy().astype(np.int64)
    raw[at], aim[at] = found["raw"].to_numpy(), found["aim"].to_numpy()
    rows = int(raw[BUCKETS])
    raw, aim = raw[:BUCKETS], aim[:BUCKETS]
    ratio = np.log((aim + 1) / (aim.sum() + BUCKETS)) - np.log((raw + 1) / (raw.sum() + BUCKETS))
    share = min(1.0, good / (good + bad) + SLACK) if good + bad else 1.0
    return Model(ratio if aim.any() else np.zeros(BUCKETS), rows, math.ceil(rows * share))


def log_weights(texts: pa.Array, ratio: np.ndarray) -> np.ndarray:
    out = [np.zeros(0)]
    for _, t in K.slices(texts):
        h, doc = grams(t)
        out.append(np.bincount(doc, weights=ratio[h], minlength=t.n))
    return np.concatenate(out)


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` (with ``text`` and ``noise_key``) with ``log_weight`` and ``rank_key``,
    smallest first, instead of these two."""
    sent = rows.sparkSession.sparkContext.broadcast(model.ratio)
    keep = [f for f in rows.schema.fields if f.name not in ("text", "noise_key")]
    names = [f.name for f in keep]

    def run(batches):
        for b in batches:
            col = lambda n: b.column(b.schema.get_field_index(n))
            w = log_weights(col("text"), sent.value)
            u = (col("noise_key").to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(11)).astype(np.float64)
            gumbel = -np.log(-np.log((u + 0.5) / 2.0**53))
            yield pa.RecordBatch.from_arrays([*[col(f) for f in names], pa.array(w), pa.array(-(w + gumbel))],
                                             names=[*names, "log_weight", "rank_key"])

    return rows.mapInArrow(run, T.StructType([*keep, T.StructField("log_weight", T.DoubleType()),
                                              T.StructField("rank_key", T.DoubleType())]))


def kth_smallest(df: DataFrame, col: str, k: int, total: int, small: int = 5000) -> float:
    """The k-th smallest value of a double column without nulls, exactly: the
    range that holds it is narrowed by counts until it has few rows."""
    if k >= total:
        return math.inf
    if k < 1:
        return -math.inf
    rest = df.select(col)
    while True:
        if k <= small:
            return rest.orderBy(col).limit(k).agg(F.max(col)).first()[0]
        cuts = cut_points(rest, col, 256)
        # rows equal to a cut are a group of their own, so every round sheds a value
        counts = {(r["b"], not r["at"]): (r["n"], r["lo"], r["hi"])
                  for r in rest.groupBy(bucket_by(F.col(col), cuts).alias("b"), F.col(col).isin(cuts).alias("at"))
                  .agg(F.count(F.lit(1)).alias("n"), F.min(col).alias("lo"), F.max(col).alias("hi")).collect()}
        for b in sorted(counts):
            n, lo, hi = counts[b]
            if k <= n:
                break
            k -= n
        if lo == hi:
            return lo
        rest = rest.filter(F.col(col).between(lo, hi))


def _noise(*cols):
    return F.xxhash64(*cols, F.lit(SEED))


def resample_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the resampling draws, with all their columns. They are
    scored twice (for the k-th key, then beside the whole rows), so that no text
    is shuffled or written in between."""
    model = fit(docs, labels)
    light = docs.select("text", _noise(F.col("doc_id"), F.col("text")).alias("noise_key"))
    limit = kth_smallest(kept(scored(light, model).select("rank_key")), "rank_key", model.keep, model.rows)
    rows = packed(docs, text=F.col("text"), noise_key=_noise(F.col("doc_id"), F.col("text")))
    return scored(rows, model).filter(F.col("rank_key") <= F.lit(limit)).select("_row.*")


def op6_importance_resampling(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality", "toxic")
    model = fit(docs, labels)
    out = kept(scored(docs.withColumn("noise_key", _noise(F.col("doc_id"), F.col("text"))), model))
    limit = kth_smallest(out, "rank_key", model.keep, model.rows)
    return out.select("doc_id", "log_weight", (-F.col("rank_key")).alias("gumbel_key"), (F.col("rank_key") <= F.lit(limit)).alias("kept"))


# Hashed n-gram models are not SQL; tests hold them against brute force
SQL = None
