"""Operator 11: phrase collocation mining by set-oriented (SETM) passes.

Texts are lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and
those into words ``[^\\x20\\x09]+``; all counts are per ``lang`` (null: ``und``).

* **Sorted occurrence relation.** A task writes its words as blocks of one
  language: the items in order of (piece, position), with a gap where the next
  item is not adjacent, beside the block's distinct items and their counts. The
  relation of a length stays on the executors' disks until the next one is made.
* **Group-count.** Every phrase belongs to one shard, by a hash. A block sends a shard
  one row: its phrases in order with their counts, as compressed columns. The group of
  a shard adds them up by phrase; those found ``MIN_COUNT`` times stay, with an id. Words
  are keyed by themselves, longer phrases by the ids of their first and last k - 1
  words, so no hash stands for a phrase.
* **Semi-join, then extend.** The ids go back to the blocks that hold the phrase;
  other items become gaps. Merging the sorted relation with itself one position
  on (both neighbours frequent) gives the relation of the next length. A phrase
  found often enough has only such parts, so nothing is lost.

Every candidate carries the counts of its beginnings and ends, from which all
cuts are scored, in decimals: 1000 * a * n and l * r may pass 64 bits, the floored
quotient (at most 10 * n) may not. A candidate lies inside a longer one of the
same count only if it is the beginning or end of one that is a word longer.

Scale: a text is read once and never shuffled; a phrase is counted once per block that
holds it, so a passage in a third of all rows is pre-aggregated, and its entries are
as many as the blocks. Nothing is broadcast by hint. A task holds a few blocks of
about ``BLOCK_WORDS`` words, or one longer document, or a shard: there is one for every
``SHARD_WORDS`` words, and it has at most an entry per occurrence. The ids
go to the shared folder, in a file for ``FILE_SHARDS`` shards: where Spark reaches it as
a local folder, every file of a task starts processes, and each shows the memory of the
executor a second time until it runs. Lost blocks are made again from the text and them.

Defined results: null and empty texts have no words; words are never normalised
beyond A-Z; texts of any length are read whole; repeated rows count as often as
they occur; ``doc_id`` and further columns are not read; an empty table gives no
rows. Ties are ordered by count and by the phrase's UTF-8 bytes, so ranks are unique.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aisle.llm import kernels as K
from aisle.llm.store import kept
from aisle.operators.relational import top_k_per_group

MIN_COUNT = 100
LONGEST = 5
TOP = 2000
BLOCK_WORDS = 1 << 20
SHARD_WORDS = 1 << 21
FILE_SHARDS = 8
#: bits of a block's number within its task
BLOCK_BITS = 14

IS_BREAK = np.zeros(256, bool)
IS_BREAK[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
BETWEEN = IS_BREAK.copy()
BETWEEN[[0x20, 0x09]] = True

#: a block of words; what it sends to a shard; a block of longer phrases is one row with
#: ``seq`` (0 for a gap) and one for each shard, with the items from ``first`` on
WORDS = "block long, lang string, n long, seq binary, word binary, counts binary"
DEALT = "shard int, block long, lang string, word binary, counts binary"
GRAMS = "block long, lang string, seq binary, shard int, first int, counts binary"
#: a block's items that are frequent, with their ids; and a row with count and key of each phrase
FOUND = "block long, items binary, id long, f long, lang string, word string, head long, tail long"


def squeezed(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + pa.compress(data, codec="zstd", asbytes=True)


def opened(data: bytes) -> bytes:
    return pa.decompress(data[8:], int.from_bytes(data[:8], "little"), codec="zstd", asbytes=True)


def packed(*columns: np.ndarray) -> bytes:
    """Columns of 64-bit integers, as compressed planes of their bytes."""
    return squeezed(b"".join(np.asarray(c, "<i8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in columns))


def unpacked(data: bytes, columns: int) -> np.ndarray:
    planes = np.frombuffer(opened(data), np.uint8).reshape(columns, 8, -1)
    return np.ascontiguousarray(planes.transpose(0, 2, 1)).view("<i8")[:, :, 0]


def words(t: K.Texts) -> tuple[pa.Array, np.ndarray]:
    """The words in order, and whether each follows the one before it in its piece."""
    t = t.lower()
    between = BETWEEN[t.data]
    s, e, doc = K.runs(t, between)
    piece = np.cumsum(IS_BREAK[t.data])[s] if len(s) else s
    follows = np.zeros(len(s), bool)
    follows[1:] = (doc[1:] == doc[:-1]) & (piece[1:] == piece[:-1])
    off = np.concatenate(([0], np.cumsum(e - s)))
    found = pa.LargeStringArray.from_buffers(len(s), pa.py_buffer(off.astype(np.int64)), pa.py_buffer(t.data[~between].tobytes()))
    return found, follows


def with_gaps(items: np.ndarray, follows: np.ndarray) -> np.ndarray:
    """The sorted relation: items in order, -1 between items that are not adjacent."""
    out = np.full(len(items) + int((~follows[1:]).sum()), -1, np.int32)
    out[np.arange(len(items)) + np.concatenate(([0], np.cumsum(~follows[1:])))] = items
    return out


def closed_up(seq: np.ndarray) -> np.ndarray:
    """``seq`` with every run of gaps as one gap, and none at the ends."""
    held = seq >= 0
    keep = held.copy()
    keep[1:] |= held[:-1]
    seq = seq[keep]
    return seq[:-1] if len(seq) and seq[-1] < 0 else seq


def shard_of_pairs(head: np.ndarray, tail: np.ndarray, shards: int) -> np.ndarray:
    mixed = head.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + tail.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    mixed = (mixed ^ (mixed >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((mixed >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def hash_of_words(found: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, found), np.int64, len(found))


def extended(seq: np.ndarray, item: np.ndarray, id_: np.ndarray, shards: int) -> tuple[np.ndarray, ...]:
    """Merge the relation with itself one position on, over the items with an id:
    (relation of the next length; its items' shards, first parts, last parts, counts,
    in order of these three)."""
    order = np.argsort(id_)
    known, place = id_[order], np.full(int(seq.max()) + 1, -1, np.int64)
    place[item[order]] = np.arange(len(order))
    at = np.where(seq >= 0, place[np.maximum(seq, 0)], -1)
    head, tail = at[:-1], at[1:]
    pair = (head >= 0) & (tail >= 0)
    keys, inverse, times = np.unique(head[pair] * len(known) + tail[pair], return_inverse=True, return_counts=True)
    out = np.full(len(head), -1, np.int32)
    head, tail = known[keys // len(known)], known[keys % len(known)]
    shard = shard_of_pairs(head, tail, shards)
    order = np.argsort(shard, kind="stable")
    number = np.empty(len(order), np.int32)
    number[order] = np.arange(len(order))
    out[pair] = number[inverse]
    return closed_up(out), shard[order], head[order], tail[order], times[order]


def slices_of(shard: np.ndarray):
    """(shard, first, end) of each run of a sorted array."""
    first = np.flatnonzero(np.diff(shard, prepend=-1)).tolist()
    return zip(shard[first].tolist(), first, [*first[1:], len(shard)])


def _block(number: int, lang: str, parts: list) -> pa.RecordBatch:
    """The row of a block; its most frequent items have the least numbers."""
    found = pa.chunked_array([p[0] for p in parts]).combine_chunks().dictionary_encode()
    distinct = found.dictionary.cast(pa.large_binary()).to_pylist()
    times = np.bincount(found.indices.to_numpy())
    order = np.argsort(-times, kind="stable")
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order))
    item = rank[found.indices.to_numpy()]
    seq = with_gaps(item, np.concatenate([p[1] for p in parts]))
    return pa.RecordBatch.from_pydict({
        "block": pa.array([number], pa.int64()), "lang": pa.array([lang]), "n": pa.array([len(item)], pa.int64()),
        "seq": pa.array([packed(seq + 1)], pa.binary()), "word": pa.array([squeezed(b" ".join([distinct[i] for i in order]))], pa.binary()),
        "counts": pa.array([packed(times[order])], pa.binary())})


def word_blocks(docs: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The occurrences of all words, as blocks of one language each."""
    def run(batches):
        first = TaskContext.get().partitionId() << BLOCK_BITS
        made, held, size = 0, {}, {}

        def flush(langs):
            nonlocal made
            for lang in langs:
                parts = held.pop(lang)
                if size.pop(lang):
                    if made >> BLOCK_BITS:
                        raise ValueError("too many blocks in a task: read the texts in more partitions")
                    yield _block(first + made, lang, parts)
                    made += 1

        for b in batches:
            langs = b.column(1).to_pylist()
            for lang in dict.fromkeys(langs):
                rows = pa.array([x == lang for x in langs])
                for _, t in K.slices(b.column(0).filter(rows)):
                    found, follows = words(t)
                    held.setdefault(lang, []).append((found, follows))
                    size[lang] = size.get(lang, 0) + len(found)
                    if size[lang] >= block_words:
                        yield from flush([lang])
            if sum(size.values()) >= 4 * block_words:
                yield from flush(sorted(held))
        yield from flush(sorted(held))

    return docs.select("text", F.coalesce("lang", F.lit("und")).alias("lang")).mapInArrow(run, WORDS)


def dealt(blocks: DataFrame, shards: int) -> DataFrame:
    """The items of blocks of words, dealt over the shards."""
    def run(batches):
        for b in batches:
            for block, lang, word, counts in zip(*(c.to_pylist() for c in b.columns)):
                found, (times,) = opened(word).split(b" "), unpacked(counts, 1)
                shard = hash_of_words(found) * shards >> 32
                item = np.argsort(shard, kind="stable")
                rows = [(p, block, lang, squeezed(b" ".join([found[i] for i in item[lo:hi]])),
                         packed(np.diff(item[lo:hi], prepend=0), times[item[lo:hi]])) for p, lo, hi in slices_of(shard[item])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.string(), pa.binary(), pa.binary()))],
                    names=["shard", "block", "lang", "word", "counts"])

    return blocks.select("block", "lang", "word", "counts").mapInArrow(run, DEALT)


def next_blocks(blocks: DataFrame, back: DataFrame, shards: int) -> DataFrame:
    """Semi-join of the occurrences with the frequent items (``back``: within (a
    block), items), and their extension by one position."""
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = []
        if left.num_rows and right.num_rows:
            block, lang = left["block"][0].as_py(), left["lang"][0].as_py()
            (seq,) = unpacked(left["seq"][0].as_py(), 1)
            back = [unpacked(x, 2) for x in right["items"].to_pylist()]
            item, id_ = np.concatenate([np.cumsum(x[0]) for x in back]), np.concatenate([x[1] for x in back])
            seq, shard, head, tail, times = extended(seq - 1, item, id_, shards)
            if len(shard):
                rows.append((block, lang, packed(seq + 1), None, None, None))
            rows += [(block, lang, None, p, lo, packed(np.diff(head[lo:hi], prepend=0), tail[lo:hi], times[lo:hi]))
                     for p, lo, hi in slices_of(shard)]
        kinds = (pa.int64(), pa.string(), pa.binary(), pa.int32(), pa.int32(), pa.binary())
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, kinds)],
                                    names=["block", "lang", "seq", "shard", "first", "counts"])

    return blocks.groupBy("block").cogroup(back.groupBy("within")).applyInArrow(run, GRAMS)


def in_files(df: DataFrame, files: int) -> DataFrame:
    """``df``, made in as many tasks as it has, then kept in ``files`` files."""
    df = df.persist(StorageLevel.DISK_ONLY)
    out = kept(df.coalesce(files))
    df.unpersist()
    return out


def frequent(items: DataFrame, least: int, shards: int) -> DataFrame:
    """Group-count: ``id``, count ``f`` and key of the phrases found at least ``least``
    times; and for every block its items that are such phrases, with their ids."""
    words_ = "word" in items.columns

    def run(t: pa.Table) -> pa.Table:
        counts = [unpacked(c, 2 if words_ else 3) for c in t["counts"].to_pylist()]
        size = [c.shape[1] for c in counts]
        times = np.concatenate([c[-1] for c in counts])
        if words_:
            item = np.concatenate([np.cumsum(c[0]) for c in counts])
            # as ids: the language, the word
            langs = t["lang"].combine_chunks().dictionary_encode()
            found = pa.array([w for x in t["word"].to_pylist() for w in opened(x).split(b" ")], pa.large_binary()).dictionary_encode()
            head, tail = np.repeat(langs.indices.to_numpy(), size), found.indices.to_numpy()
        else:
            item = np.concatenate([np.arange(a, a + n) for a, n in zip(t["first"].to_pylist(), size)])
            head, tail = np.concatenate([np.cumsum(c[0]) for c in counts]), np.concatenate([c[1] for c in counts])
        order = np.lexsort((tail, head))
        head, tail = head[order], tail[order]
        new = np.ones(len(order), bool)
        new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
        first = np.flatnonzero(new)
        f = np.add.reduceat(times[order], first)
        # small ids for the most frequent
        id_, often = np.full(len(f), -1, np.int64), np.flatnonzero(f >= least)
        often = often[np.argsort(-f[often], kind="stable")]
        id_[often] = np.arange(len(often)) * shards + t["shard"][0].as_py()
        of = np.empty(len(order), np.int64)
        of[order] = id_[np.cumsum(new) - 1]
        held = np.flatnonzero(of >= 0)
        rows = [(t["block"][i].as_py(), packed(np.diff(item[held[lo:hi]], prepend=0), of[held[lo:hi]]))
                for i, lo, hi in slices_of(np.repeat(np.arange(len(size)), size)[held])]
        first, m = first[often], len(often)
        if words_:
            texts = found.dictionary.take(pa.array(tail[first])).cast(pa.binary()).view(pa.string())
            keys = [langs.dictionary.take(pa.array(head[first])), texts, pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64())]
        else:
            keys = [pa.nulls(m, pa.string()), pa.nulls(m, pa.string()), pa.array(head[first]), pa.array(tail[first])]
        block, places = zip(*rows) if rows else ((), ())
        longs = [pa.array(x, pa.int64()) for x in (id_[often], f[often])]
        return pa.concat_tables([
            pa.table({"block": pa.array(block, pa.int64()), "items": pa.array(places, pa.binary())}),
            pa.Table.from_arrays([*longs, *keys], names=["id", "f", "lang", "word", "head", "tail"])],
            promote_options="default").select(["block", "items", "id", "f", "lang", "word", "head", "tail"]).combine_chunks()

    return items.groupBy("shard").applyInArrow(run, FOUND)


def once(rows: DataFrame) -> DataFrame:
    """The rows of the phrases, one each."""
    return rows.filter("f IS NOT NULL")


def longer_phrases(shorter: DataFrame, found: DataFrame) -> DataFrame:
    """Candidates a word longer, from their two parts: words, the counts ``begins``
    (``ends``) of their first (last) 1, 2, ... words, and the parts' counts."""
    head = shorter.select(F.col("id").alias("head"), "lang", F.col("words").alias("_words"), F.col("begins").alias("_begins"),
                          F.col("f").alias("head_f"))
    tail = shorter.select(F.col("id").alias("tail"), F.element_at("words", -1).alias("_last"), F.col("ends").alias("_ends"),
                          F.col("f").alias("tail_f"))
    own = F.array("f")
    return (found.join(head, "head").join(tail, "tail")
            .select("id", "lang", "f", "head", "tail", "head_f", "tail_f",
                    F.concat("_words", F.array("_last")).alias("words"),
                    F.concat("_begins", own).alias("begins"), F.concat("_ends", own).alias("ends")))


def uncovered(phrases: DataFrame, longer: DataFrame | None) -> DataFrame:
    """Candidates that lie in no longer candidate of the same count."""
    if longer is None:
        return phrases
    inside = (longer.filter(F.col("f") == F.col("head_f")).select(F.col("head").alias("id"))
              .union(longer.filter(F.col("f") == F.col("tail_f")).select(F.col("tail").alias("id"))))
    return phrases.join(inside.distinct(), "id", "left_anti")


def lowest_cut(k: int, n: Column) -> Column:
    """struct(score, cut, l, r) of the lowest-scoring cut of a phrase of ``k`` words."""
    big = lambda c: c.cast("decimal(19,0)")
    top = F.lit(1000).cast("decimal(4,0)") * F.col("f").cast("decimal(15,0)") * n.cast("decimal(17,0)")
    cuts = []
    for j in range(1, k):
        left, right = F.col("begins")[j - 1], F.col("ends")[k - j - 1]
        score = F.call_function("div", top, big(left) * big(right))
        cuts.append(F.struct(score.alias("score"), F.lit(j).alias("cut"), left.alias("l"), right.alias("r")))
    return cuts[0] if len(cuts) == 1 else F.least(*cuts)


def collocations(docs: DataFrame, min_count: int = MIN_COUNT, longest: int = LONGEST, top: int = TOP,
                 block_words: int = BLOCK_WORDS, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Each language's first ``top`` phrases of 2 to ``longest`` words: (lang, rank,
    phrase, a, l, r, n, score)."""
    blocks = word_blocks(docs, block_words).persist(StorageLevel.DISK_ONLY)
    shards = -(-(blocks.agg(F.sum("n")).first()[0] or 1) // shard_words)
    files = -(-shards // FILE_SHARDS)
    sizes = kept(blocks.groupBy("lang").agg(F.sum("n").alias("n")).coalesce(files))
    found = in_files(frequent(dealt(blocks, shards), min_count, shards), files)
    levels = [once(found).select("id", "lang", "f", F.array("word").alias("words"), F.array("f").alias("begins"), F.array("f").alias("ends"))]
    for _ in range(2, longest + 1):
        back = found.filter("items IS NOT NULL").select(F.col("block").alias("within"), "items")
        shorter, blocks = blocks, next_blocks(blocks.filter("seq IS NOT NULL").select("block", "lang", "seq"), back, shards)
        blocks = blocks.persist(StorageLevel.DISK_ONLY)
        items = blocks.filter("shard IS NOT NULL").select("shard", "block", "first", "counts")
        found = in_files(frequent(items, min_count, shards), files)
        levels.append(kept(longer_phrases(levels[-1], once(found).select("head", "tail", "f", "id")).coalesce(files)))
        shorter.unpersist()
    blocks.unpersist()
    rows = None
    for i, phrases in enumerate(levels[1:], 1):
        rest = uncovered(phrases, levels[i + 1] if i + 1 < len(levels) else None)
        best = rest.join(sizes, "lang").withColumn("best", lowest_cut(i + 1, F.col("n")))
        part = best.select("lang", F.array_join("words", " ").alias("phrase"), F.col("f").alias("a"), "best.l", "best.r", "n",
                           F.col("best.score").cast("long").alias("score"))
        rows = part if rows is None else rows.unionByName(part)
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    return (top_k_per_group(rows, "lang", order, top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))


def op11_setm_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("text", "lang"))


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
toks AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM toks GROUP BY lang),
spans AS (
  SELECT lang, w[i:i + k - 1] AS w
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
        FROM toks, (VALUES (1), (2), (3), (4), (5)) AS v(k))),
counts AS (SELECT lang, w, len(w) AS k, count(*) AS f FROM spans GROUP BY lang, w HAVING count(*) >= 100),
inner_spans AS (
  SELECT lang, w[i:i + m - 1] AS w, k, f
  FROM (SELECT lang, w, k, f, m, unnest(range(1, k - m + 2)) AS i
        FROM counts, (VALUES (2), (3), (4)) AS v(m) WHERE m < k)),
covered AS (
  SELECT DISTINCT c.lang, c.w FROM counts AS c JOIN inner_spans AS s ON s.lang = c.lang AND s.w = c.w
  WHERE 100 * s.f >= 100 * c.f),
cuts AS (
  SELECT lang, w, f, j, w[1:j] AS lw, w[j + 1:] AS rw
  FROM (SELECT lang, w, f, unnest(range(1, k)) AS j FROM counts WHERE k >= 2)
  WHERE (lang, w) NOT IN (SELECT (lang, w) FROM covered)),
scored AS (
  SELECT c.lang, c.w, c.f AS a, c.j, l.f AS l, r.f AS r, z.n,
         CAST((CAST(1000 AS HUGEINT) * c.f * z.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts AS c JOIN counts AS l ON l.lang = c.lang AND l.w = c.lw
  JOIN counts AS r ON r.lang = c.lang AND r.w = c.rw JOIN sizes AS z ON z.lang = c.lang),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(w, ' ')) AS rank,
       array_to_string(w, ' ') AS phrase, a, l, r, n, score
FROM lowest
QUALIFY rank <= 2000
"""
