"""Operator 8: language identification by cross-parsing.

Texts are read as words of letters: lower case, with every other ASCII character
a blank and runs of blanks one (symbols and digits say nothing about a language).
For every language a suffix automaton holds the learning sample. A text is cut,
from left to right, into the longest phrases that occur in the sample (a
character that it lacks is a phrase of its own). Few phrases mean that the
sample predicts the text; the estimate is ``phrases * log2(sample length) /
characters`` bits, and the language with the least wins.

Learning uses text and non-null ``lang`` of documents whose
``crc32(doc_id as text) mod 3`` is not 1. The sample is bounded: per language
the distinct texts with a letter that have the smallest keyed hash, as many as
fit into ``SAMPLE_ROWS * SAMPLE_CHARS`` characters; texts of at most
``SAMPLE_CHARS`` come first, of a longer one, taken only where those are too
few, the first ``SAMPLE_CHARS``. Copies count once, however many there are. A
task sends no more than such a sample. Every text is then parsed whole.

The samples (bounded by languages * rows * characters) are broadcast; each
Python worker builds its automata once, and of each a table of what a parse does
at every state and letter (up to ``TABLE_CELLS`` cells, ``ALL_CELLS`` in all: other samples,
such as those of large alphabets, are walked state by state). Texts of a slice of ``SLICE_CHARS`` take their steps together, one letter
of each; one that is longer than 1/``TOGETHER`` of its slice is parsed by itself.

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is everything if nothing can be learned; ties go to the language that sorts
first; a null ``doc_id`` is not held out and not learned from; repeated rows
are predicted alike; an empty table gives no rows; other columns are ignored.
The score is ``1 - best / second best`` (1 if one language is learned).
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SAMPLE_ROWS = 48
SAMPLE_CHARS = 2500
FAN_IN = 64
#: four bytes each: of one language's table, and of all tables of a worker
TABLE_CELLS, ALL_CELLS = 1 << 24, 1 << 26
TOGETHER = 64
SLICE_CHARS = 1 << 21
_PLAIN = bytes(b if b > 127 or bytes([b]).isalpha() else 32 for b in range(256))


def letters(text: str) -> str:
    """The text as the models read it."""
    return b" ".join(text.lower().encode("utf-8", "surrogatepass").translate(_PLAIN).split()).decode("utf-8", "surrogatepass")


def suffix_automaton(texts: list[str]) -> dict:
    """The automaton of all texts: a state is a dict from character to state;
    returns the root. Texts stand apart by a character that no phrase crosses."""
    step: list[dict] = [{}]
    link, length, last = [-1], [0], 0
    for text in texts:
        for c in [*text, None]:
            cur = len(step)
            step.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in step[p]:
                step[p][c] = cur
                p = link[p]
            if p >= 0:
                q = step[p][c]
                if length[p] + 1 == length[q]:
                    link[cur] = q
                else:
                    clone = len(step)
                    step.append(dict(step[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and step[p].get(c) == q:
                        step[p][c] = clone
                        p = link[p]
                    link[q] = link[cur] = clone
            last = cur
    for state in step:
        for c in state:
            state[c] = step[state[c]]
    return step[0]


_DEAD: dict = {}


def phrases(root: dict, text: str) -> int:
    """Number of longest-match phrases of ``text``."""
    n, state, begin = 0, _DEAD, root.get
    for c in text:
        state = state.get(c)
        if state is None:
            n += 1
            state = begin(c, _DEAD)
    return n


def code_points(texts: list[str]) -> np.ndarray:
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)


def parse_table(root: dict, alphabet: str, most: int = TABLE_CELLS) -> np.ndarray | None:
    """What a parse does, by state and letter: twice the next state's first cell, plus
    one if the letter begins a phrase. A row holds the letters of ``alphabet``, then
    all others; the last row is that of a parse without a phrase. None beyond ``most`` cells."""
    width = len(alphabet) + 1
    column = {c: i for i, c in enumerate(alphabet)}
    number, states, cell, to = {id(root): 0}, [root], [], []
    for state in states:
        at = number[id(state)] * width
        for c, after in state.items():
            if c is None:
                continue
            if id(after) not in number:
                number[id(after)] = len(states)
                states.append(after)
            cell.append(at + column[c])
            to.append(number[id(after)] * width)
        if (len(states) + 1) * width > most:
            return None
    begins = np.full(width, 2 * len(states) * width + 1, np.int32)
    for c, after in root.items():
        if c is not None:
            begins[column[c]] = 2 * number[id(after)] * width + 1
    table = np.tile(begins, len(states) + 1)
    table[cell] = 2 * np.array(to, np.int32)
    return table


class Tables:
    """The parse tables of several models, one after the other."""

    def __init__(self, tables: list[np.ndarray], alphabets: list[str]):
        first = np.cumsum([0] + [len(t) for t in tables])
        self.cells = np.concatenate([t + np.int32(2 * f) for t, f in zip(tables, first)])
        self.dead = np.array([f - len(a) - 1 for f, a in zip(first[1:], alphabets)], np.int32)
        known = np.unique(np.concatenate([code_points([a]) for a in alphabets]))
        self.known, self.columns = known, np.empty((len(tables), len(known) + 1), np.uint16)
        for row, alphabet in zip(self.columns, alphabets):
            row[:] = len(alphabet)
            row[np.searchsorted(known, code_points([alphabet]))] = np.arange(len(alphabet))

    def phrases(self, texts: list[str]) -> np.ndarray:
        """Number of longest-match phrases by text and model: all texts take a step at a time."""
        models = len(self.dead)
        size = np.array([len(t) for t in texts])
        order = np.argsort(-size, kind="stable")
        points = code_points(texts)
        place = np.searchsorted(self.known, points)
        place[self.known[np.minimum(place, len(self.known) - 1)] != points] = len(self.known)
        codes = self.columns[:, place].ravel()
        begin = (np.cumsum(size) - size)[order]
        at = (begin[:, None] + np.arange(models) * len(points)).ravel()
        state, count = np.tile(self.dead, len(texts)), np.zeros(len(at), np.int64)
        longer = np.searchsorted(-size[order], -np.arange(size.max()), "left") * models
        counting = count
        for k in longer.tolist():
            state, at, counting = state[:k], at[:k], counting[:k]
            step = self.cells.take(np.add(state, codes.take(at), dtype=np.int64))
            counting += step & 1
            state = step >> 1
            at += 1
        out = np.empty((len(texts), models), np.int64)
        out[order] = count.reshape(-1, models)
        return out


class Identifier:
    def __init__(self, samples: dict[str, list[str]], most_cells: int = TABLE_CELLS):
        self.models, tables, alphabets, self.tabled = [], [], [], []
        for i, lang in enumerate(sorted(samples)):
            texts = [letters(t) for t in samples[lang]]
            size = sum(len(t) + 1 for t in texts)
            root, alphabet = suffix_automaton(texts), "".join(sorted(set("".join(texts))))
            self.models.append((lang, root, math.log2(size + 2)))
            table = parse_table(root, alphabet, most_cells)
            if table is not None and alphabet and sum(map(len, tables)) + len(table) <= ALL_CELLS:
                tables.append(table)
                alphabets.append(alphabet)
                self.tabled.append(i)
        self.tables = Tables(tables, alphabets) if tables else None

    def phrases(self, texts: list[str]) -> list[list[int]]:
        """Number of phrases by text and model."""
        total = sum(map(len, texts))
        together = [i for i, t in enumerate(texts) if t and len(t) * TOGETHER <= total] if self.tables else []
        out: list[list] = [[None] * len(self.models) for _ in texts]
        if together:
            for i, found in zip(together, self.tables.phrases([texts[i] for i in together]).tolist()):
                for m, n in zip(self.tabled, found):
                    out[i][m] = n
        return [[phrases(root, t) if n is None else n for n, (_, root, _) in zip(row, self.models)] for row, t in zip(out, texts)]

    def predict(self, text: str | None) -> tuple[str, float]:
        return self.predict_all([text])[0]

    def predict_all(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out = [("und", 0.0)] * len(texts)
        if self.models:
            able = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))]
            for i, found in zip(able, self.phrases([letters(texts[i]) for i in able])):
                out[i] = self._least_bits(found)
        return out

    def _least_bits(self, found: list[int]) -> tuple[str, float]:
        bits = [n * weight for n, (_, _, weight) in zip(found, self.models)]
        best = min(range(len(bits)), key=lambda i: (bits[i], i))
        if len(bits) == 1:
            return self.models[best][0], 1.0
        second = min(b for i, b in enumerate(bits) if i != best)
        return self.models[best][0], 1.0 - bits[best] / second


_built: dict[int, Identifier] = {}


def _identifier(key: int, samples: dict[str, list[str]]) -> Identifier:
    if key not in _built:
        _built.clear()
        _built[key] = Identifier(samples)
    return _built[key]


def _least(t: pa.Table, room: int) -> pa.Table:
    """Per language the distinct texts that come first, up to ``room`` characters."""
    lang = t["lang"].combine_chunks().dictionary_encode().indices.to_numpy()
    long, key, size = (t[c].to_numpy() for c in ("long", "key", "size"))
    at = np.lexsort((key, long, lang))
    lang, key = lang[at], key[at]
    new = np.ones(len(at), bool)
    new[1:] = (lang[1:] != lang[:-1]) | (key[1:] != key[:-1])
    at, lang = at[new], lang[new]
    upto = np.cumsum(size[at])
    start = np.searchsorted(lang, lang)
    return t.take(at[upto - upto[start] + size[at][start] <= room])


def learning_samples(docs: DataFrame, rows: int = SAMPLE_ROWS, chars: int = SAMPLE_CHARS,
                     fan_in: int = FAN_IN) -> dict[str, list[str]]:
    """Distinct texts of at most ``chars`` characters, ``rows * chars`` in all per language."""
    room = rows * chars
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    able = (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (part != 1))
            .select("lang", (F.char_length("text") > chars).alias("long"), F.substring("text", 1, chars).alias("text"))
            .filter(F.col("text").rlike(r"\p{L}"))
            .select("lang", "long", F.xxhash64(F.col("text"), F.lit(8)).alias("key"),
                    F.char_length("text").cast("long").alias("size"), "text"))

    def run(batches):
        held = None
        for b in batches:
            t = pa.Table.from_batches([b])
            held = _least(t if held is None else pa.concat_tables([held, t]), room)
        if held is not None:
            yield from held.combine_chunks().to_batches()

    # a hot language or text ships at most ``room`` characters per task
    kind = "lang string, long boolean, key long, size long, text string"
    least, tasks = able.mapInArrow(run, kind), able.rdd.getNumPartitions()
    while tasks > fan_in:
        tasks = -(-tasks // fan_in)
        least = least.repartitionById(tasks, F.pmod(F.spark_partition_id(), F.lit(tasks))).mapInArrow(run, kind)
    order = Window.partitionBy("lang").orderBy("long", "key").rowsBetween(Window.unboundedPreceding, 0)
    picked = (least.dropDuplicates(["lang", "long", "key"]).withColumn("upto", F.sum("size").over(order))
              .filter(F.col("upto") <= room))
    out: dict[str, list[str]] = {}
    for r in picked.select("lang", "upto", "text").orderBy("lang", "upto").toLocalIterator():
        out.setdefault(r["lang"], []).append(r["text"])
    return out


def _slices(texts: pa.Array):
    """(first, number) of rows with about ``SLICE_CHARS`` characters, or one longer text."""
    upto = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False))
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SLICE_CHARS, "right")))
        yield lo, hi - lo
        lo = hi


def identify(docs: DataFrame, samples: dict[str, list[str]]) -> DataFrame:
    """(doc_id, lang_pred, score) of every document."""
    sent = docs.sparkSession.sparkContext.broadcast(samples)
    key = hash(tuple((k, *v) for k, v in sorted(samples.items())))

    def run(batches):
        model = _identifier(key, sent.value)
        for b in batches:
            for part in (b.slice(lo, n) for lo, n in _slices(b.column(1))):
                found = model.predict_all(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array([f[0] for f in found]), pa.array([f[1] for f in found], pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, lang_pred string, score double"))


def op8_cross_parsing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    part = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    return identify(docs, learning_samples(docs)).select(
        "doc_id", F.coalesce(part == 1, F.lit(False)).alias("held_out"), "lang_pred", "score")


# Learned; tests check phrases by brute force and held-out accuracy
SQL = None
