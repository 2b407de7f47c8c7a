"""Vectorised text kernels over Arrow string arrays.

Every kernel works on the UTF-8 buffer of a slice of documents (about
``SLICE_BYTES`` of text, or one longer document), so memory is bounded by the
slice and numpy passes stay in cache. A word is a run of bytes outside
``\\x20 \\x09-\\x0D``; as all of these are ASCII, byte runs and code-point runs
are the same.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

SLICE_BYTES = 1 << 20
U64 = np.uint64

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_rng = np.random.default_rng(20240607)
_BYTE_KEY = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15          # odd, hence invertible modulo 2**64
_BASE_INV = pow(_BASE, -1, 1 << 64)
_WORD_BASE = [pow(0xD1342543DE82EF95, i, 1 << 64) for i in range(64)]
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}


def _grow(n: int) -> tuple[np.ndarray, np.ndarray]:
    have = len(_powers["up"])
    if have < n:
        size = max(n, SLICE_BYTES + 1)
        for key, base in (("up", _BASE), ("down", _BASE_INV)):
            out = np.full(size, base, U64)
            out[0] = 1
            np.multiply.accumulate(out, out=out)
            _powers[key] = out
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """Finalising mixer (splitmix64) of a uint64 array."""
    h = (h ^ (h >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U64(27))) * U64(0x94D049BB133111EB)
    return h ^ (h >> U64(31))


@dataclass
class Texts:
    """The UTF-8 bytes of some documents and where each begins."""

    data: np.ndarray        # uint8
    off: np.ndarray         # int64, n + 1

    @property
    def n(self) -> int:
        return len(self.off) - 1

    def lower(self) -> "Texts":
        return Texts(LOWER[self.data], self.off)


def texts_of(arr: pa.Array) -> Texts:
    """Zero-copy view of a string array; null counts as the empty text."""
    if isinstance(arr, pa.ChunkedArray):
        arr = arr.combine_chunks()
    if arr.null_count:
        arr = arr.fill_null("")
    if len(arr) == 0:
        return Texts(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    kind = np.int64 if pa.types.is_large_string(arr.type) else np.int32
    off = np.frombuffer(arr.buffers()[1], kind)[arr.offset:arr.offset + len(arr) + 1].astype(np.int64)
    raw = arr.buffers()[2]
    data = np.frombuffer(raw, np.uint8)[off[0]:off[-1]] if raw is not None else np.zeros(0, np.uint8)
    return Texts(data, off - off[0])


def slices(arr: pa.Array, most: int = SLICE_BYTES) -> Iterator[tuple[int, Texts]]:
    """(first row, Texts) for consecutive runs of rows of at most ``most``
    bytes together; a longer document is a run of its own."""
    t = texts_of(arr)
    lo = 0
    while lo < t.n:
        hi = int(np.searchsorted(t.off, t.off[lo] + most, side="right")) - 1
        hi = min(max(hi, lo + 1), t.n)
        yield lo, Texts(t.data[t.off[lo]:t.off[hi]], t.off[lo:hi + 1] - t.off[lo])
        lo = hi


def runs(t: Texts, breaks: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, document) of every maximal run of bytes where ``breaks`` is
    false; a run never crosses documents."""
    inside = ~breaks
    size = len(inside)
    if size == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    first = np.zeros(size + 1, bool)
    first[t.off[:-1]] = True              # a document begins here
    begin = inside.copy()
    begin[1:] &= ~inside[:-1] | first[1:size]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | first[1:size]
    s = np.flatnonzero(begin)
    e = np.flatnonzero(end) + 1
    return s, e, np.searchsorted(t.off, s, side="right") - 1


def words(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return runs(t, IS_SPACE[t.data])


def lines(t: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Non-empty lines between newline bytes (an empty line has no word)."""
    return runs(t, t.data == 0x0A)


def prefix_hash(t: Texts) -> np.ndarray:
    """Prefix sums of the polynomial hash; ``span_hash`` reads any span."""
    up, _ = _grow(len(t.data) + 1)
    out = np.zeros(len(t.data) + 1, U64)
    np.cumsum(_BYTE_KEY[t.data] * up[:len(t.data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes [start, end), equal for equal bytes."""
    _, down = _grow(len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(U64))


def word_grams(wh: np.ndarray, wdoc: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash, first word) of every run of ``k`` consecutive words of one document."""
    n = len(wh) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = np.zeros(n, U64)
    for j in range(k):
        h += wh[j:j + n] * U64(_WORD_BASE[j])
    at = np.flatnonzero(wdoc[:n] == wdoc[k - 1:])
    return mix(h[at] + U64(k)), at


def shingle_sets(t: Texts, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ``k``-word shingle hashes of each document, ascending, and the
    n + 1 offsets of the documents' sets. A document of 1 to k - 1 words has one
    shingle, its whole word sequence; one without a word has none."""
    t = t.lower()
    s, e, wdoc = words(t)
    if len(s) == 0:
        return np.zeros(0, U64), np.zeros(t.n + 1, np.int64)
    wh = span_hash(prefix_hash(t), s, e)
    h, at = word_grams(wh, wdoc, k)
    doc = wdoc[at]
    count = np.bincount(wdoc, minlength=t.n)
    begin = np.concatenate(([0], np.cumsum(count)))
    short = np.flatnonzero((count > 0) & (count < k))
    if len(short):
        extra = np.zeros(len(short), U64)
        for j in range(k - 1):
            has = count[short] > j
            extra[has] += wh[begin[short][has] + j] * U64(_WORD_BASE[j])
        h = np.concatenate((h, mix(extra + count[short].astype(U64))))
        doc = np.concatenate((doc, short))
        order = np.argsort(doc, kind="stable")
        h, doc = h[order], doc[order]
    off = np.searchsorted(doc, np.arange(t.n + 1))
    sets = [np.unique(h[off[i]:off[i + 1]]) for i in range(t.n)]
    return np.concatenate(sets), np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int64)


def shingle_sets_of(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """``shingle_sets`` of an array of any size, slice by slice."""
    sets, sizes = [np.zeros(0, U64)], [np.zeros(0, np.int64)]
    for _, t in slices(texts):
        h, off = shingle_sets(t, k)
        sets.append(h)
        sizes.append(np.diff(off))
    return np.concatenate(sets), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))).astype(np.int64)


def per_doc_sum(values: np.ndarray, doc: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(doc, weights=values, minlength=n).astype(np.int64)


def per_doc_bytes(t: Texts, flag: np.ndarray) -> np.ndarray:
    """Number of bytes with ``flag`` set in every document."""
    c = np.concatenate(([0], np.cumsum(flag, dtype=np.int64)))
    return c[t.off[1:]] - c[t.off[:-1]]
