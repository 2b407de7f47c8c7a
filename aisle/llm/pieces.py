"""Operator 7: encoding and decoding with a SentencePiece vocabulary.

A text becomes its pieces' form: one blank mark in front, blanks as marks. An
Aho-Corasick automaton over the pieces walks it once; at every position the
output links give all pieces that end there, and each relaxes the best score of
a segmentation up to that position (Viterbi). A character that no piece covers
is spelled in byte pieces at ``least piece score - UNKNOWN_PENALTY``. Equal
scores go to the longer last piece.

No piece holds a mark after another character, so no piece crosses the place
before a run of blanks; nor a newline if no piece holds one. The best
segmentation is therefore made chunk by chunk, and chunks repeat: at most
``CACHE_CHUNKS`` of them stay in memory. Both facts are read from the
vocabulary; one that lacks them is segmented whole.

Decoding joins the pieces' bytes and drops the mark in front. It gives back any
text exactly: a mark character in the text itself is spelled in bytes.

Defined results: a null text has null ids, an empty text none; both decode to
what they were; repeated rows are encoded alike; an empty table gives no rows;
other columns are ignored by the query and kept by ``encode_documents``.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aisle.llm.store import packed

MARK = "▁"
UNKNOWN_PENALTY = 10.0
CACHE_CHUNKS = 200_000
CACHE_CHARS = 32                 # longer chunks are not kept
ROWS = 500                       # rows of a result batch


class PieceCoder:
    def __init__(self, path: str):
        import ahocorasick
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        self.bytes_of: list[bytes] = []
        self.byte_id = [0] * 256
        self.automaton = ahocorasick.Automaton()
        least, held = 0.0, []
        for i in range(sp.get_piece_size()):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of.append(bytes([int(piece[3:5], 16)]))
            elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
                self.bytes_of.append(b"")
            else:
                score = sp.get_score(i)
                least = min(least, score)
                held.append(piece)
                self.automaton.add_word(piece, (len(piece), score, i))
                self.bytes_of.append(piece.replace(MARK, " ").encode())
        self.automaton.make_automaton()
        self.unknown = least - UNKNOWN_PENALTY
        self.cut_blanks = not any(MARK in p.lstrip(MARK) for p in held)
        self.cut_lines = not any("\n" in p for p in held)
        self.newline = self._pack(self._spell("\n"))
        self.cache: dict[str, bytes] = {}

    @staticmethod
    def _pack(ids: list[int]) -> bytes:
        return np.array(ids, "<i4").tobytes()

    def _spell(self, char: str) -> list[int]:
        return [self.byte_id[b] for b in char.encode("utf-8", "surrogatepass")]

    def segment(self, s: str) -> list[int]:
        """Best pieces of ``s``, a text in its pieces' form."""
        n = len(s)
        best, back, done, unknown = [0.0] * (n + 1), [None] * (n + 1), 0, self.unknown
        for end, found in self.automaton.iter(s):
            end += 1
            while done < end:
                best[done + 1] = best[done] + unknown
                done += 1
            size, score, _ = found
            v = best[end - size] + score
            if v > best[end] or (v == best[end] and (back[end] is None or size > back[end][0])):
                best[end], back[end] = v, found
        out, at = [], n
        while at:
            found = back[at]
            if found is None:
                out.extend(reversed(self._spell(s[at - 1])))
                at -= 1
            else:
                out.append(found[2])
                at -= found[0]
        out.reverse()
        return out

    def _chunk(self, s: str) -> bytes:
        ids = self.cache.get(s)
        if ids is None:
            ids = self._pack(self.segment(s))
            if len(s) <= CACHE_CHARS and len(self.cache) < CACHE_CHUNKS:
                self.cache[s] = ids
        return ids

    def chunks(self, text: str) -> list[str]:
        """The text in its pieces' form, cut where no piece can cross."""
        first, *words = text.split(" ")
        if first and "" not in words:
            return [MARK + first, *[MARK + w for w in words]]
        out, cur = [], MARK + first
        for w in words:
            if cur[-1] != MARK:
                out.append(cur)
                cur = ""
            cur += MARK + w
        return [*out, cur]

    def encode(self, text: str) -> bytes:
        """Little-endian int32 ids."""
        if not text:
            return b""
        if MARK in text:
            return self._encode_marked(text)
        if not self.cut_blanks:
            return self._pack(self.segment(MARK + text.replace(" ", MARK)))
        if not self.cut_lines:
            return b"".join([self._chunk(c) for c in self.chunks(text)])
        cache, parts = self.cache, []
        for i, line in enumerate(text.split("\n")):
            chunks = self.chunks(line)
            if i:
                parts.append(self.newline)
                chunks[0] = chunks[0][1:]            # only the text has a mark in front
                if not chunks[0]:
                    del chunks[0]
            parts += [cache.get(c) or self._chunk(c) for c in chunks]
        return b"".join(parts)

    def _encode_marked(self, text: str) -> bytes:
        """A text that holds mark characters: they are spelled in bytes, and no
        piece crosses them."""
        out = []
        for i, part in enumerate(text.split(MARK)):
            if i:
                out += self._spell(MARK)
            s = (MARK if i == 0 else "") + part.replace(" ", MARK)
            out += self.segment(s) if s else []
        return self._pack(out)

    def decode(self, ids: np.ndarray) -> str:
        table = self.bytes_of
        raw = b"".join([table[i] for i in ids.tolist()])
        return (raw[1:] if raw[:1] == b" " else raw).decode("utf-8", "surrogatepass")


_coders: dict[str, PieceCoder] = {}


def coder(path: str) -> PieceCoder:
    if path not in _coders:
        _coders[path] = PieceCoder(path)
    return _coders[path]


def vocabulary_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def _ids_array(encoded: list[bytes | None]) -> pa.Array:
    sizes = np.array([len(e or b"") // 4 for e in encoded], np.int64)
    off = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
    values = pa.array(np.frombuffer(b"".join(e or b"" for e in encoded), "<i4"))
    if all(e is not None for e in encoded):
        return pa.ListArray.from_arrays(pa.array(off), values)
    return pa.ListArray.from_arrays(pa.array(off), values, mask=pa.array([e is None for e in encoded]))


def encode_texts(rows: DataFrame, path: str, check: bool = False) -> DataFrame:
    """``rows`` without their column ``text``, with ``ids`` and, if ``check``,
    ``exact``: whether decoding the ids gives the text back."""
    keep = [f for f in rows.schema.fields if f.name != "text"]
    more = [T.StructField("ids", T.ArrayType(T.IntegerType()))] + ([T.StructField("exact", T.BooleanType())] if check else [])

    def run(batches):
        c = coder(path)
        for b in batches:
            for lo in range(0, b.num_rows, ROWS):
                part = b.slice(lo, ROWS)
                texts = part.column(part.schema.get_field_index("text")).to_pylist()
                encoded = [None if t is None else c.encode(t) for t in texts]
                cols = [part.column(part.schema.get_field_index(f)) for f in names] + [_ids_array(encoded)]
                if check:
                    cols.append(pa.array([e is None or c.decode(np.frombuffer(e, "<i4")) == t
                                          for e, t in zip(encoded, texts)]))
                yield pa.RecordBatch.from_arrays(cols, names=[*names, *[m.name for m in more]])

    names = [f.name for f in keep]
    return rows.mapInArrow(run, T.StructType([*keep, *more]))


def decode_ids(rows: DataFrame, path: str) -> DataFrame:
    """``rows`` (with a column ``ids``) with ``text``, the decoded ids, instead."""
    keep = [f for f in rows.schema.fields if f.name != "ids"]
    names = [f.name for f in keep]

    def run(batches):
        c = coder(path)
        for b in batches:
            ids = b.column(b.schema.get_field_index("ids"))
            texts = [None if x is None else c.decode(np.array(x, "<i4")) for x in ids.to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*[b.column(b.schema.get_field_index(f)) for f in names], pa.array(texts, pa.string())], names=[*names, "text"])

    return rows.mapInArrow(run, T.StructType([*keep, T.StructField("text", T.StringType())]))


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids) of every row of ``docs``."""
    return encode_texts(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), path)


def op7_piece_viterbi(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = encode_texts(docs, vocabulary_path(), check=True)
    return out.select("doc_id", F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_pieces"), "ids", "exact")


# Viterbi is not SQL; tests hold it against brute force and round trips
SQL = None
