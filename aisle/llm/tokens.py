"""Operator 10: token ids in bit-plane shuffled files.

Documents are range-partitioned and sorted by ``doc_id``; each task encodes its
texts and writes a file, so the files in partition order hold all ids in
ascending ``doc_id`` order. A manifest row per file (checkpointed) gives its id
and document counts; prefix sums over the manifest give every file's first id.

File layout, little-endian::

    magic (8 bytes)
    chunks of CHUNK_IDS ids (the last may be shorter): for every plane of the
        chunk one zstandard frame, nothing for a plane of zeros
    document table: zstandard frame of doc_id int64[], valid uint8[], n_ids int64[]
    chunk index: zstandard frame of (offset, length of each plane) int64[chunks, 1 + planes]
    tail: planes, documents, chunks, ids, offset of table, of index (int64 each), magic

Byte planes: plane p holds byte p of every id. Bit planes: plane p holds bit p
of every id, eight ids a byte.

Encoding: the vocabulary's pre-tokenizer always ends a token before a blank or
newline that stands between two non-blank characters, and such a newline is a
token of its own. Texts are cut there, so that words repeat: the library encodes
a word once, many new words in one call with newlines between them, and at most
``CACHE_WORDS`` frequent ones stay in memory. A text with other white space is cut
only where the rule holds. The words' ids, joined, equal those of the whole text.
A text that holds the text of an added token (``<|endoftext|>``) goes through the
library as a whole, whose default gives that token's one id; as it has no white
space, no cut elsewhere can make one.

Defined results: a null or empty text gives only the end id; a null ``doc_id``
sorts first; rows with one ``doc_id`` are ordered by their text; an empty table
gives no file and no rows; other columns are ignored.
"""

from __future__ import annotations

import re
import struct
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from aisle.llm.store import kept, new_folder, new_name, open_folder, tasks_of

MAGIC = b"IDPLANE1"
TAIL = struct.Struct("<6q8s")
CHUNK_IDS = 1 << 16
FILE_IDS = 1 << 26                # a task begins a new file beyond this
END_ID = 0
CACHE_WORDS = 800_000
CALL_WORDS = 8192

_CUT = re.compile(r"(?<=\S)(?=[ \n]\S)")


# ---- encoding --------------------------------------------------------------

class Encoder:
    """Whole texts to little-endian uint32 ids.

    A word's key is the word if a blank stands before it, else a newline and the
    word; the first word of a text counts as one after a newline."""

    def __init__(self, path: str):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        self.newline = self._ids("\n")
        if len(self.newline) != 1:
            raise ValueError("the vocabulary has no token for a newline")
        self.cache: dict[str, bytes] = {}

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def keys(self, text: str) -> list[str]:
        if " ".join(text.split()) == text.replace("\n", " "):     # single blanks and newlines only
            return ("\n" + text.replace("\n", " \n")).split(" ")
        first, *rest = _CUT.split(text)
        return ["\n" + first, *[p[1:] if p[0] == " " else p for p in rest]]

    def _learn(self, new: list[str]) -> dict[str, bytes]:
        mark, nl = np.array(self.newline, "<u4").tobytes(), self.newline[0]
        out: dict[str, bytes] = {}
        for spaced in (True, False):
            todo = [k for k in new if (k[:1] != "\n") == spaced]
            plain = [k for k in todo if (k if spaced else k[1:]).split() == [k if spaced else k[1:]]]
            for at in range(0, len(plain), CALL_WORDS):
                group = plain[at:at + CALL_WORDS]
                text = "\n".join([" " + k for k in group]) if spaced else "".join(group)[1:]
                ids = np.array(self._ids(text), "<u4")
                cut = np.flatnonzero(ids == nl)
                if len(cut) != len(group) - 1:
                    raise ValueError("the vocabulary joins newlines with words")
                raw, off = ids.tobytes(), np.concatenate(([-1], cut, [len(ids)]))
                for k, i, j in zip(group, ((off[:-1] + 1) * 4).tolist(), (off[1:] * 4).tolist()):
                    out[k] = raw[i:j] if spaced else mark + raw[i:j]
            for k in todo:
                if k not in out:
                    ids = np.array(self._ids(" " + k if spaced else k[1:]), "<u4").tobytes()
                    out[k] = ids if spaced else mark + ids
        return out

    def encode(self, texts: list[str | None]) -> list[bytes]:
        flat: list[str] = []
        ends, whole = [], {}
        for i, t in enumerate(texts):
            if t and self.added and self.added.search(t):
                whole[i] = np.array(self._ids(t), "<u4").tobytes()
            elif t:
                flat += self.keys(t)
            ends.append(len(flat))
        got = list(map(self.cache.get, flat))
        missing = [i for i, g in enumerate(got) if g is None]
        if missing:
            here = self._learn(list(dict.fromkeys([flat[i] for i in missing])))
            for i in missing:
                got[i] = here[flat[i]]
            room = CACHE_WORDS - len(self.cache)
            if room > 0:
                self.cache.update(here if len(here) <= room else dict(list(here.items())[:room]))
        out = [b"".join(got[i:j])[4:] for i, j in zip([0, *ends], ends)]
        for i, ids in whole.items():
            out[i] = ids
        return out


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


# ---- planes ----------------------------------------------------------------

def to_planes(ids: np.ndarray, kind: str) -> list[bytes]:
    raw = np.ascontiguousarray(ids, "<u4").view(np.uint8).reshape(-1, 4)
    if kind == "bit":
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        planes = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little")
    else:
        planes = np.ascontiguousarray(raw.T)
    return [p.tobytes() if p.any() else b"" for p in planes]


def from_planes(planes: list[bytes], n: int, kind: str) -> np.ndarray:
    width = (n + 7) // 8 if kind == "bit" else n
    grid = np.zeros((len(planes), width), np.uint8)
    for i, p in enumerate(planes):
        if p:
            grid[i] = np.frombuffer(p, np.uint8)
    if kind == "bit":
        bits = np.unpackbits(grid, axis=1, bitorder="little")[:, :n]
        grid = np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").T
    return np.ascontiguousarray(grid.T).reshape(-1).view("<u4")


class PlaneWriter:
    """Streams documents into one file; holds one chunk of ids and the table."""

    def __init__(self, out, kind: str = "byte", chunk: int = CHUNK_IDS):
        self.out, self.kind, self.chunk = out, kind, chunk
        self.z = zstandard.ZstdCompressor(level=3)
        self.pos = out.write(MAGIC) or len(MAGIC)
        self.pending, self.held, self.n_ids = [], 0, 0
        self.docs: list[tuple[int | None, int]] = []
        self.index: list[list[int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((doc_id, len(ids) // 4))
        self.n_ids += len(ids) // 4
        self.pending.append(ids)
        self.held += len(ids)
        if self.held >= 4 * self.chunk:
            data = b"".join(self.pending)
            whole = len(data) // (4 * self.chunk) * 4 * self.chunk
            for at in range(0, whole, 4 * self.chunk):
                self._put(data[at:at + 4 * self.chunk])
            self.pending, self.held = [data[whole:]], len(data) - whole

    def _put(self, data: bytes) -> None:
        entry = [self.pos]
        for plane in to_planes(np.frombuffer(data, "<u4"), self.kind):
            frame = self.z.compress(plane) if plane else b""
            self.out.write(frame)
            self.pos += len(frame)
            entry.append(len(frame))
        self.index.append(entry)

    def close(self) -> None:
        if self.held:
            self._put(b"".join(self.pending))
        planes = 32 if self.kind == "bit" else 4
        table = self.z.compress(
            np.array([d or 0 for d, _ in self.docs], "<i8").tobytes()
            + np.array([d is not None for d, _ in self.docs], np.uint8).tobytes()
            + np.array([n for _, n in self.docs], "<i8").tobytes())
        index = self.z.compress(np.array(self.index, "<i8").reshape(len(self.index), 1 + planes).tobytes())
        self.out.write(table)
        self.out.write(index)
        self.out.write(TAIL.pack(planes, len(self.docs), len(self.index), self.n_ids,
                                 self.pos, self.pos + len(table), MAGIC))


class PlaneReader:
    """Random access by chunk; ``documents`` streams (doc_id, ids as bytes parts)."""

    def __init__(self, src, size: int, chunk: int = CHUNK_IDS):
        self.src, self.chunk = src, chunk
        self.z = zstandard.ZstdDecompressor()
        src.seek(size - TAIL.size)
        self.planes, n_docs, n_chunks, self.n_ids, table, index, magic = TAIL.unpack(src.read(TAIL.size))
        if magic != MAGIC:
            raise ValueError("not a plane file")
        self.kind = "bit" if self.planes == 32 else "byte"
        src.seek(table)
        raw = self.z.decompress(src.read(index - table))
        ids, valid = np.frombuffer(raw, "<i8", n_docs), np.frombuffer(raw, np.uint8, n_docs, 8 * n_docs)
        self.doc_ids = [int(d) if v else None for d, v in zip(ids, valid)]
        self.counts = np.frombuffer(raw[9 * n_docs:], "<i8", n_docs)
        src.seek(index)
        entries = self.z.decompress(src.read(size - TAIL.size - index))
        self.index = np.frombuffer(entries, "<i8").reshape(n_chunks, 1 + self.planes)

    def read_chunk(self, i: int) -> np.ndarray:
        offset, *lengths = (int(x) for x in self.index[i])
        self.src.seek(offset)
        planes = []
        for n in lengths:
            planes.append(self.z.decompress(self.src.read(n)) if n else b"")
        return from_planes(planes, min(self.chunk, self.n_ids - i * self.chunk), self.kind)

    def documents(self):
        """(doc_id, first id's place in the file, ids, running crc32) in order."""
        at, chunk, data = 0, -1, b""
        for doc_id, n in zip(self.doc_ids, self.counts):
            crc, start, left = 0, at, int(n)
            while left:
                if at // self.chunk != chunk:
                    chunk = at // self.chunk
                    data = self.read_chunk(chunk).tobytes()
                inside = at - chunk * self.chunk
                take = min(left, self.chunk - inside)
                crc = zlib.crc32(data[4 * inside:4 * (inside + take)], crc)
                at, left = at + take, left - take
            yield doc_id, start, int(n), crc


# ---- jobs ------------------------------------------------------------------

MANIFEST = "part int, seq int, path string, n_docs long, n_ids long"


def write_ids(docs: DataFrame, folder: str, path: str, kind: str = "byte") -> DataFrame:
    """Encode and write; returns the manifest (checkpointed)."""
    end = np.array([END_ID], "<u4").tobytes()

    def run(batches):
        enc, fsys, base = encoder(path), *open_folder(folder)
        part, seq, rows = TaskContext.get().partitionId(), 0, []
        out = writer = name = None

        def close():
            writer.close()
            out.close()
            rows.append((part, seq, f"{base}/{name}", len(writer.docs), writer.n_ids))

        for b in batches:
            doc_ids = b.column(0).to_pylist()
            for lo in range(0, b.num_rows, 512):
                texts = b.column(1).slice(lo, 512).to_pylist()
                for doc_id, ids in zip(doc_ids[lo:lo + 512], enc.encode(texts)):
                    if writer is None:
                        fsys.create_dir(base, recursive=True)
                        name = new_name(f"ids-{part:06d}-{seq:04d}", ".planes")
                        out = fsys.open_output_stream(f"{base}/{name}")
                        writer = PlaneWriter(out, kind)
                    writer.add(doc_id, ids + end)
                    if writer.n_ids >= FILE_IDS:
                        close()
                        writer, seq = None, seq + 1
        if writer is not None:
            close()
        if rows:
            cols = list(zip(*rows))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int32()), pa.array(cols[1], pa.int32()), pa.array(cols[2]),
                 pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64())],
                names=["part", "seq", "path", "n_docs", "n_ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    ordered = (rows.repartitionByRange(tasks_of(docs.sparkSession), F.col("doc_id").asc_nulls_first())
               .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "text"))
    return kept(ordered.mapInArrow(run, MANIFEST))


def read_ids(manifest: DataFrame, folder: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) from the files of the manifest."""
    # one row per file, so this window reads as many rows as there are tasks
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.withColumn("base", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))

    def run(batches):
        fsys, _ = open_folder(folder)
        for b in batches:
            for path, base in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                with fsys.open_input_file(path) as src:
                    rows = [(d, base + s, n, c) for d, s, n, c in PlaneReader(src, src.size()).documents()]
                cols = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in cols], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    spark = manifest.sparkSession
    dealt = placed.select("path", "base").repartition(tasks_of(spark), "path")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op10_bit_planes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    folder = new_folder(spark, "planes")
    return read_ids(write_ids(docs, folder, vocabulary_path()), folder)


# Tokenizing is not SQL; tests hold the ids against the library on whole texts
SQL = None
