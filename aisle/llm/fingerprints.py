"""Operator 1: Order MinHash fingerprints.

A text's k-mers (of code points) are numbered by occurrence, so that repeats
count. Each of ``HASHES`` hash functions picks the ``TUPLE`` smallest numbered
k-mers; they keep their order in the text, and the hash of that ordered tuple is
one entry of the fingerprint. Entries agree only where texts share k-mers in
the same order, so the share of equal entries falls with the edit distance.

The query compares every text with an edited form that ends in the next
document's beginning (descending ``doc_id``). Documents are dealt out once, by
ranges of ``doc_id``; the first document of each range also goes to the range
before it, so every task sees its rows and the one that follows them, streams
them in order and holds two texts. k-mers of the part that the edit keeps are
hashed once for both forms.

Defined results: a null text is the empty text, whose fingerprint is all zeros
(alike with itself, unlike all others); a text shorter than a k-mer is one
k-mer; with one k-mer the tuple has one part; rows with one ``doc_id`` follow
each other by text; a null ``doc_id`` comes last; a single row is its own next
document; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.llm.kernels import mix
from aisle.llm.store import tasks_of
from aisle.operators.prefix import cut_points

KMER = 16                       # a power of two
HASHES = 64
TUPLE = 2
CHUNK = 4096                    # positions hashed together
PAD = 0x110000                  # no code point
NONE = np.uint32(0xFFFFFFFF)

_rng = np.random.default_rng(11)
_XOR = _rng.integers(0, 2**32, HASHES, dtype=np.uint64).astype(np.uint32)[:, None]
_MUL = (_rng.integers(0, 2**31, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)).astype(np.uint32)[:, None]
_SALT = np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407)
_ROWS = np.arange(HASHES)
_B = 0xC2B2AE3D27D4EB4F
_STEPS = [(1 << i, np.uint64(pow(_B, 1 << i, 1 << 64))) for i in range(KMER.bit_length() - 1)]


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")


def numbered_kmers(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(k-mer hash, hash of k-mer and occurrence) by position."""
    if len(codes) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint32)
    if len(codes) < KMER:
        codes = np.concatenate((codes, np.full(KMER - len(codes), PAD, np.uint32)))
    h = (codes.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9FB21C651E98DF25)
    h ^= h >> np.uint64(29)
    for width, power in _STEPS:                    # hashes of 2, 4, ... code points
        h = h[:-width] * power + h[width:]
    h = mix(h)
    n = len(h)
    bits = np.uint64(max(1, int(n - 1).bit_length()))
    # sorted by (hash without its low bits, position): equal k-mers stand together in text order
    ranked = np.sort((h >> bits << bits) | np.arange(n, dtype=np.uint64))
    same = (ranked[1:] >> bits) == (ranked[:-1] >> bits)
    if same.any():
        at = np.arange(n)
        start = np.maximum.accumulate(np.where(np.concatenate(([True], ~same)), at, 0))
        occurrence = np.zeros(n, np.uint64)
        occurrence[(ranked & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)] = at - start
        numbered = mix(h + occurrence * np.uint64(0xD6E8FEB86659FD93))
    else:
        numbered = mix(h)
    return h, (numbered >> np.uint64(32)).astype(np.uint32)


def smallest(numbered: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Per hash function the two smallest (value, position) of [lo, hi), packed
    into uint64; a missing one has the value ``NONE``."""
    best = np.full((HASHES, TUPLE), NONE, np.uint64) << np.uint64(32)
    for at in range(lo, hi, CHUNK):
        v = (numbered[None, at:min(at + CHUNK, hi)] ^ _XOR) * _MUL
        found = []
        for _ in range(TUPLE):
            i = v.argmin(axis=1)
            found.append(v[_ROWS, i].astype(np.uint64) << np.uint64(32) | (i + at).astype(np.uint64))
            v[_ROWS, i] = NONE
        best = merged(best, np.stack(found, axis=1))
    return best


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sort(np.concatenate((a, b), axis=1), axis=1)[:, :TUPLE]


def ordered_tuples(best: np.ndarray, kmers: np.ndarray) -> np.ndarray:
    """The fingerprint: uint16 hashes of the picked k-mers in text order."""
    if len(kmers) == 0:
        return np.zeros(HASHES, np.uint16)
    pos = (best & np.uint64(0xFFFFFFFF)).astype(np.int64)
    missing = (best >> np.uint64(32)) == np.uint64(NONE)
    pos[missing] = -1
    pos.sort(axis=1)
    out = _SALT.copy()
    for c in range(TUPLE):
        part = np.where(pos[:, c] < 0, np.uint64(0), mix(kmers[np.maximum(pos[:, c], 0)]))
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + part)
    return (out >> np.uint64(48)).astype(np.uint16)


def fingerprint(text: str) -> np.ndarray:
    kmers, numbered = numbered_kmers(code_points(text))
    return ordered_tuples(smallest(numbered, 0, len(numbered)), kmers)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    return float((a == b).mean())


class Sketched:
    """A text, its fingerprint and the picks of the part that an edit keeps."""

    def __init__(self, text: str | None):
        self.text = text or ""
        self.codes = code_points(self.text)
        self.half = len(self.codes) // 2
        self.kept = len(self.codes) - self.half
        kmers, numbered = numbered_kmers(self.codes)
        self.cut = max(0, self.kept - KMER + 1)
        self.front = smallest(numbered, 0, self.cut)
        self.fp = ordered_tuples(merged(self.front, smallest(numbered, self.cut, len(numbered))), kmers)

    def edited(self, following: "Sketched") -> tuple[str, np.ndarray]:
        text = self.text[:self.kept] + following.text[:self.half]
        kmers, numbered = numbered_kmers(np.concatenate((self.codes[:self.kept], following.codes[:self.half])))
        back = smallest(numbered, self.cut, len(numbered))
        return text, ordered_tuples(merged(self.front, back), kmers)


OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
       "near_edited double, near_next double")


def _row(doc_id: int | None, this: Sketched, following: Sketched) -> tuple:
    text, fp = this.edited(following)
    return (doc_id, len(this.codes), hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
            this.fp.tobytes().hex(), fp.tobytes().hex(), likeness(this.fp, fp), likeness(this.fp, following.fp))


def _compare(batches):
    """Rows come by range, in descending doc_id; rows marked extra stand after
    the range and only serve as its last row's next document."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [c.split()[0] for c in OUT.split(", ")]
    bucket, doc_id, prev, rows = None, None, None, []
    for b in batches:
        for i in range(b.num_rows):
            here, extra, new_id = b.column(0)[i].as_py(), b.column(1)[i].as_py(), b.column(2)[i].as_py()
            if here != bucket:
                bucket, prev = here, None
            if extra and prev is None:
                continue                      # the range's last row has been answered
            new = Sketched(b.column(3)[i].as_py())
            if prev is not None:
                rows.append(_row(doc_id, prev, new))
            doc_id, prev = (None, None) if extra else (new_id, new)
            if len(rows) >= 500:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)
                rows = []
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited form; see ``OUT``."""
    n = tasks_of(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    cuts = np.array(cut_points(rows, "doc_id", 4 * n), np.int64)

    @F.arrow_udf("int")
    def range_of(ids: pa.Array) -> pa.Array:
        at = np.searchsorted(cuts, ids.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        at[ids.is_null().to_numpy(zero_copy_only=False)] = 0
        return pa.array(at, pa.int32())

    # at most one row per range comes to the driver
    heads = {r["b"]: r["head"] for r in rows.groupBy(range_of("doc_id").alias("b")).agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads)
    after = {b: order[(i + 1) % len(order)] for i, b in enumerate(order)}

    @F.arrow_udf("array<int>")
    def ranges(ids: pa.Array) -> pa.Array:
        """The row's range; for a range's first row also the range it follows."""
        out = []
        for d in ids.to_pylist():
            b = 0 if d is None else int(np.searchsorted(cuts, d, side="right"))
            out.append([b, after[b]] if d == heads[b] else [b])
        return pa.array(out, pa.list_(pa.int32()))

    dealt = (rows.select(F.posexplode(ranges("doc_id")).alias("extra", "range"), "doc_id", "text")
             .select("range", (F.col("extra") == 1).alias("extra"), "doc_id", "text")
             .repartition(n, "range")
             .sortWithinPartitions("range", "extra", F.col("doc_id").desc_nulls_last(), F.col("text").asc_nulls_first()))
    return dealt.mapInArrow(_compare, OUT)


def op1_order_minhash(spark, sf_dir: str) -> DataFrame:
    return compare_with_next(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))


# Order MinHash is not SQL; tests hold it against brute force
SQL = None
