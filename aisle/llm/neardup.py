"""Operator 2: MinHash near-duplicates.

Sets: the distinct 5-word shingles of a text (A-Z lower-cased; with fewer words
the whole sequence is one shingle). Documents link when
``100 * intersection >= 75 * union``.

1. One pass hashes every text once (one-permutation hashing): a shingle's hash
   gives its bin and its value, and each of ``BINS`` bins keeps its least value.
   An empty bin borrows from a bin that a hash of (bin, attempt) names, attempt
   by attempt, until one is filled (optimal densification).
2. Documents with equal sets are one class, named by its smallest ``doc_id``.
3. Signatures are cut into ``BANDS`` bands; classes with an equal band share a
   bucket. At similarity 0.75 a pair shares none with probability
   (1 - 0.75^4)^32, about 5e-6.
4. Every class is compared with the smallest class of its buckets: a star, so
   at most one pair a class. Links are confirmed on the full sets, and the
   components are named.
5. A bucket whose classes are still in different components may hide links
   between its members. Only there, members of different components are compared
   by signature, in blocks. A large component has blocks of its own, and a pair
   of blocks of one component is never made: beside one strange document, a hot
   bucket sends each member about twice. Components that some pair with an
   estimate of at least ``LEAST_ESTIMATE`` (over five standard deviations below
   0.75) joins form a region, and the members of such pairs are marked.
6. Only marked members send their full sets, each hashed once where its text is
   scanned; inside a region, again in blocks, every such pair of members of
   different components is tested until its components are linked. Only the
   links that join components leave the task, so what a group of copies sends
   grows with its rows, not with its pairs.
7. Components of all links, by alternating large and small stars.

Blocks are bounded by rows (``BLOCK``) or by shingles (``BLOCK_SHINGLES``), so a task
holds two blocks or one longer document. Two large components of one bucket
without a link still meet block by block: each member is sent once per block of
the other one.

Nothing but counts reaches the driver, except where ``BROADCAST_IDS`` bounds a
broadcast of ids by a count checked at run time; beyond it the same join is
shuffled.

Defined results: a document without words, or null, has 0 shingles and links
with nothing; one with a null ``doc_id`` is compared with nothing, has component
null and is kept; rows that share a ``doc_id`` are one document, with the links of
all their texts (equal ones are reduced to one before any comparison), of which ``drop_near_duplicates`` keeps one row; an empty table
gives no rows; other columns are ignored or passed through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisle.llm import kernels as K
from aisle.llm.store import kept, packed

SHINGLE = 5
NEED, OF = 75, 100              # OF * intersection >= NEED * union
BINS, BANDS = 128, 32
ROWS = BINS // BANDS
BLOCK = 4096                    # signatures: about 1 MB
BLOCK_SHINGLES = 1 << 20        # full sets: 8 MB
LEAST_ESTIMATE = 0.55
BROADCAST_IDS = 500_000
SALTS = 64


def _lender(attempt: int) -> np.ndarray:
    """The bin that each bin borrows from at this attempt."""
    at = np.arange(BINS, dtype=np.uint64) + np.uint64(0x51ED2701 + attempt * BINS)
    return (K.mix(at) % np.uint64(BINS)).astype(np.int64)


def densified(values: np.ndarray, filled: np.ndarray) -> np.ndarray:
    """Signatures (n, BINS) with the empty bins of every row filled."""
    out, todo = values.copy(), ~filled
    attempt = 0
    while todo.any():
        source = _lender(attempt)
        take = todo & filled[:, source]
        out[take] = values[:, source][take]
        todo &= ~take
        attempt += 1
    return out


def signatures(sets: np.ndarray, off: np.ndarray) -> np.ndarray:
    """uint16 signatures (documents, BINS) of ascending hash sets; rows of empty
    sets are zeros. The top bits of a hash are its bin, so a bin's least value is
    the first of its run."""
    n = len(off) - 1
    values = np.zeros((n, BINS), np.uint64)
    filled = np.zeros((n, BINS), bool)
    if len(sets):
        doc = np.repeat(np.arange(n), np.diff(off))
        bins = (sets >> np.uint64(64 - BINS.bit_length() + 1)).astype(np.int64)
        cell = doc * BINS + bins
        first = np.flatnonzero(np.concatenate(([True], cell[1:] != cell[:-1])))
        values.reshape(-1)[cell[first]] = sets[first]
        filled.reshape(-1)[cell[first]] = True
        some = filled.any(axis=1)
        values[some] = densified(values[some], filled[some])
    return (K.mix(values) >> np.uint64(48)).astype(np.uint16)


def _fold(sets: np.ndarray, off: np.ndarray, salt: int) -> np.ndarray:
    """Order-free 64-bit hash of every set."""
    h = np.concatenate(([np.uint64(0)], np.cumsum(K.mix(sets ^ np.uint64(salt)), dtype=np.uint64)))
    return (h[off[1:]] - h[off[:-1]]).view(np.int64)


def sketched(docs: DataFrame) -> DataFrame:
    """(doc_id, n, s1, s2, sig) of every document."""
    def run(batches):
        for b in batches:
            for lo, t in K.slices(b.column(1)):
                sets, off = K.shingle_sets(t, SHINGLE)
                sig = signatures(sets, off)
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, t.n), pa.array(np.diff(off)), pa.array(_fold(sets, off, 0x1234567)),
                     pa.array(_fold(sets, off, 0x89ABCDEF012)), pa.array([r.tobytes() for r in sig], pa.binary())],
                    names=["doc_id", "n", "s1", "s2", "sig"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
            .mapInArrow(run, "doc_id long, n long, s1 long, s2 long, sig binary"))


def banded(classes: DataFrame) -> DataFrame:
    """(bucket, cid): every class in its ``BANDS`` buckets."""
    salt = np.arange(1, BANDS + 1, dtype=np.uint64)[None, :] * np.uint64(0x9E3779B97F4A7C15)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            sig = np.frombuffer(b"".join(b.column(1).to_pylist()), np.uint64).reshape(-1, BANDS)   # 4 values of 16 bits
            key = K.mix(K.mix(sig) + salt).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(key.reshape(-1)), pa.array(np.repeat(b.column(0).to_numpy(zero_copy_only=False), BANDS))],
                names=["bucket", "cid"])

    return classes.select("cid", "sig").mapInArrow(run, "bucket long, cid long")


def full_sets(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """(doc_id, s1, s2, full): the distinct full sets of the documents ``ids``
    (doc_id); none of texts without words. Equal ones meet in the partial
    aggregate of the scanning task, however often a row is repeated."""
    ids = kept(ids.distinct())
    side = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids

    def run(batches):
        for b in batches:
            for lo, t in K.slices(b.column(1)):
                sets, off = K.shingle_sets(t, SHINGLE)
                some = np.flatnonzero(np.diff(off))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(lo, t.n).take(pa.array(some)), pa.array(_fold(sets, off, 0x1234567)[some]),
                     pa.array(_fold(sets, off, 0x89ABCDEF012)[some]),
                     pa.array([sets[off[i]:off[i + 1]].tobytes() for i in some], pa.binary())],
                    names=["doc_id", "s1", "s2", "full"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(side, "doc_id", "left_semi")
    return kept(texts.mapInArrow(run, "doc_id long, s1 long, s2 long, full binary").dropDuplicates(["doc_id", "s1", "s2"]))


def confirmed(pairs: DataFrame, docs: DataFrame) -> DataFrame:
    """The pairs (a, b) of document ids whose full sets link."""
    sets = full_sets(docs, pairs.select(F.explode(F.array("a", "b")).alias("doc_id"))).select("doc_id", "full")

    def run(batches):
        for b in batches:
            ok = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                ok.append(OF * both >= NEED * (len(x) + len(y) - both))
            yield b.select([0, 1]).filter(pa.array(ok, pa.bool_()))

    both = (pairs.join(sets.toDF("a", "full_a"), "a").join(sets.toDF("b", "full_b"), "b")
            .select("a", "b", "full_a", "full_b"))
    return both.mapInArrow(run, "a long, b long").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp): the smallest node reachable, for every node of an edge
    (a, b), by alternating large-star and small-star steps until nothing moves.
    Each step writes at most one row per edge to the shared folder."""
    def state(e: DataFrame):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    e = kept(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct())
    seen = None
    while (now := state(e)) != seen:
        seen = now
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .filter("u <> v").distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        e = kept(large.join(low, "u")
                 .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")),
                                           F.struct(F.col("u"), F.col("m").alias("v")))).alias("x"))
                 .select("x.u", "x.v").filter("u <> v").distinct())
    return e.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct())


def _beside(rows: DataFrame, small: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` left-joined with ``small``, one row per ``keys``; a hot key of ``rows``
    is dealt out over salts where ``small`` is too long for a broadcast."""
    if small.count() <= BROADCAST_IDS:
        return rows.join(F.broadcast(small), keys, "left")
    salted = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return (rows.withColumn("_salt", F.pmod(F.xxhash64("cid", F.lit(1)), F.lit(SALTS)).cast("int"))
            .join(salted, [*keys, "_salt"], "left").drop("_salt"))


def in_blocks(rows: DataFrame, key: str, weight: Column, most: int) -> DataFrame:
    """``rows`` (key, comp, cid, ...) with ``own``, a block of their ``key``, repeated
    for every pair of blocks (``lo``, ``hi``) that theirs is in and that may hold two
    components. A key of at most ``most`` weight is one block. In others, a
    component of over half of ``most`` has blocks of its own, cut by ``cid``; the
    small ones share blocks, each component whole in one."""
    sizes = kept(rows.groupBy(key, "comp").agg(F.sum(weight).alias("w")))
    over = F.col("w") * 2 > most
    blocks = F.ceil(F.col("w") / most).cast("int")
    hot = kept(sizes.groupBy(key).agg(
        F.sum("w").alias("_all"), F.coalesce(F.ceil(F.sum(F.when(~over, F.col("w"))) / most), F.lit(0)).cast("int").alias("_shared"),
        F.coalesce(F.sum(F.when(over, blocks)), F.lit(0)).cast("int").alias("_alone"))
        .filter(F.col("_all") > most).select(key, "_shared", (F.col("_shared") + F.col("_alone")).alias("_blocks")))
    # at most one row per half of ``most`` weight of a key
    before = Window.partitionBy(key).orderBy("comp").rowsBetween(Window.unboundedPreceding, -1)
    large = kept(sizes.filter(over).join(hot, key).select(
        key, "comp", blocks.alias("_n"), (F.col("_shared") + F.coalesce(F.sum(blocks).over(before), F.lit(0))).cast("int").alias("_from")))
    placed = _beside(_beside(rows, hot, [key]), large, [key, "comp"])
    own = (F.when(F.col("_blocks").isNull(), 0)
           .when(F.col("_n").isNotNull(), F.col("_from") + F.pmod(F.xxhash64("cid"), F.col("_n")))
           .otherwise(F.pmod(F.xxhash64("comp"), F.col("_shared"))).cast("int"))
    others = F.when(F.col("_blocks").isNull(), F.array(F.lit(0))).otherwise(F.expr(
        "filter(sequence(0, _blocks - 1), x -> _n IS NULL OR x < _from OR x >= _from + _n)"))
    return (placed.withColumn("own", own).withColumn("other", F.explode(others))
            .withColumn("lo", F.least("own", "other")).withColumn("hi", F.greatest("own", "other"))
            .drop("_blocks", "_shared", "_n", "_from", "other"))


def _groups(batches):
    """Runs of rows with equal first three columns, as lists of columns."""
    key, group = None, []
    for b in batches:
        for row in zip(*(c.to_pylist() for c in b.columns)):
            if row[:3] != key:
                if len(group) > 1:
                    yield key[1] != key[2], list(zip(*group))
                key, group = row[:3], []
            group.append(row[3:])
    if len(group) > 1:
        yield key[1] != key[2], list(zip(*group))


def _near(i: int, at: np.ndarray, n: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows of ``at`` that may link with row ``i`` by size and signature, and their estimates."""
    at = at[OF * np.minimum(n[at], n[i]) >= NEED * np.maximum(n[at], n[i])]
    like = (sig[at] == sig[i]).mean(axis=1)
    return at[like >= LEAST_ESTIMATE], like[like >= LEAST_ESTIMATE]


def _joins(cross: bool, own, label: np.ndarray, n: np.ndarray, sig: np.ndarray, test):
    """Pairs of rows, of one block or across two, that join labels: candidates by
    size and signature, best first, that pass ``test(row, rows)``. Labels are
    merged on the way, so every pair found joins two of them."""
    own, label = np.array(own), label.copy()
    first, second = own == own.min(), own == own.max()
    for i in np.flatnonzero(first):
        at, like = _near(i, np.flatnonzero((second if cross else np.arange(len(own)) > i) & (label != label[i])), n, sig)
        at = at[np.argsort(-like, kind="stable")]
        while len(at):
            some, at = at[:32], at[32:]
            for j in some[test(i, some)]:
                if label[j] != label[i]:
                    yield i, int(j)
                    label[label == label[j]] = label[i]
            at = at[label[at] != label[i]]


def _marks(cross: bool, own, comp: np.ndarray, n: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, list]:
    """The rows that are near one of another component, of one block or across two,
    and pairs (a, b) of components that join all that such rows join."""
    own, label, marked, edges = np.array(own), comp.copy(), np.zeros(len(comp), bool), []
    first, second = own == own.min(), own == own.max()
    for i in np.flatnonzero(first):
        at = np.flatnonzero((second if cross else np.arange(len(own)) > i) & (comp != comp[i]))
        while len(at):
            if marked[i]:                   # rows that are marked too, of a component joined already, add nothing
                at = at[~marked[at] | (label[at] != label[i])]
            some, at = (at, at[:0]) if marked[i] else (at[:64], at[64:])
            some, _ = _near(i, some, n, sig)
            marked[some] = True
            marked[i] |= len(some) > 0
            for j in some[label[some] != label[i]]:
                if label[j] != label[i]:
                    edges.append((comp[i], comp[j]))
                    label[label == label[j]] = label[i]
    return marked, edges


def plausible(mixed: DataFrame, classes: DataFrame) -> DataFrame:
    """From rows (bucket, cid, comp) of buckets with several components: rows (a, b,
    null) of components that some bucket's members may link, and (null, null, cid)
    of such members."""
    rows = in_blocks(mixed.join(classes.select("cid", "n", "sig"), "cid"), "bucket", F.lit(1), BLOCK)

    def run(batches):
        for cross, (own, comp, cid, n, sig) in _groups(batches):
            comp = np.array(comp, np.int64)
            marked, edges = _marks(cross, own, comp, np.array(n), np.frombuffer(b"".join(sig), np.uint16).reshape(-1, BINS))
            ids = np.unique(np.array(cid, np.int64)[marked])
            none = [None] * len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(min(e)) for e in edges] + none, pa.int64()), pa.array([int(max(e)) for e in edges] + none, pa.int64()),
                 pa.array([None] * len(edges) + ids.tolist(), pa.int64())], names=["a", "b", "cid"])

    dealt = (rows.select("bucket", "lo", "hi", "own", "comp", "cid", "n", "sig").repartition("bucket", "lo", "hi")
             .sortWithinPartitions("bucket", "lo", "hi"))
    return dealt.mapInArrow(run, "a long, b long, cid long").distinct()


def hidden_links(members: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between classes (cid, comp, region) of different
    components of a region; at least one between any two components that have
    one inside the same blocks."""
    members = kept(members)
    sets = full_sets(docs, members.select(F.col("cid").alias("doc_id"))).withColumnRenamed("doc_id", "cid")
    sets = sets.select("cid", (F.octet_length("full") / 8).cast("long").alias("n"), "full")
    full = members.join(classes.select("cid", "n", "sig"), "cid").join(sets, ["cid", "n"])
    rows = in_blocks(full, "region", F.col("n") + BLOCK_SHINGLES // BLOCK, BLOCK_SHINGLES)

    def run(batches):
        for cross, (own, comp, cid, n, sig, full) in _groups(batches):
            size = np.array(n)
            sets, off = np.frombuffer(b"".join(full), np.uint64), np.concatenate(([0], np.cumsum(size)))

            def linked(i, at):
                x = sets[off[i]:off[i + 1]]
                y = np.concatenate([sets[off[j]:off[j + 1]] for j in at])
                hit = x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y
                both = np.add.reduceat(hit.astype(np.int64), np.concatenate(([0], np.cumsum(size[at])[:-1])))
                return OF * both >= NEED * (len(x) + size[at] - both)

            found = list(_joins(cross, own, np.array(comp, np.int64), size,
                                np.frombuffer(b"".join(sig), np.uint16).reshape(-1, BINS), linked))
            a, b = [cid[i] for i, _ in found], [cid[j] for _, j in found]
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = (rows.select("region", "lo", "hi", "own", "comp", "cid", "n", "sig", "full").repartition("region", "lo", "hi")
             .sortWithinPartitions("region", "lo", "hi"))
    return dealt.mapInArrow(run, "a long, b long")


def across_components(shared: DataFrame, classes: DataFrame, links: DataFrame, docs: DataFrame) -> DataFrame:
    """The links (a, b) that the stars of the buckets (bucket, cid) hide."""
    label = components(links).withColumnRenamed("node", "cid")
    rows = shared.select("bucket", "cid").join(label, "cid", "left").withColumn("comp", F.coalesce("comp", "cid"))
    several = (rows.groupBy("bucket").agg(F.min("comp").alias("_lo"), F.max("comp").alias("_hi"))
               .filter("_lo < _hi").select("bucket"))
    mixed = kept(rows.join(several, "bucket"))
    found = kept(plausible(mixed, classes))
    regions = components(found.filter("a IS NOT NULL").select("a", "b")).select(
        F.col("node").alias("comp"), F.col("comp").alias("region"))
    marked = found.filter("cid IS NOT NULL").select("cid")
    members = mixed.select("cid", "comp").join(marked, "cid", "left_semi").distinct().join(regions, "comp")
    return hidden_links(members, classes, docs)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document."""
    sets = kept(sketched(docs))
    some = sets.filter("n > 0 AND doc_id IS NOT NULL")
    classes = kept(some.groupBy("s1", "s2", "n").agg(F.min("doc_id").alias("cid"), F.first("sig").alias("sig")))
    buckets = banded(classes)
    stars = buckets.groupBy("bucket").agg(F.min("cid").alias("rep"), F.max("cid").alias("_hi")).filter("rep < _hi")
    shared = kept(buckets.join(stars.select("bucket", "rep"), "bucket"))
    first = shared.filter("cid <> rep").groupBy(F.col("cid").alias("b")).agg(F.min("rep").alias("a"))
    # one document with several texts is in several classes: they are linked as it is
    same = (some.join(classes.select("s1", "s2", "n", "cid"), ["s1", "s2", "n"]).filter("doc_id <> cid")
            .select(F.col("cid").alias("a"), F.col("doc_id").alias("b")))
    links = kept(confirmed(first.select("a", "b"), docs))
    links = links.unionByName(kept(across_components(shared, classes, links, docs)))
    # members of a class hang on it as leaves, so one labelling names every document
    names = components(links.unionByName(same))
    return (sets.join(names, sets["doc_id"] == names["node"], "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("comp", "doc_id").alias("component_id")))


def drop_near_duplicates(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest ``doc_id``, and
    all documents without words or without ``doc_id``; with all columns."""
    found = near_duplicates(docs)
    stay = found.filter("doc_id = component_id").select("doc_id").distinct()
    rows = packed(docs, doc_id=F.col("doc_id").cast("long"))
    chosen = rows.join(stay, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return chosen.select("_row.*").unionByName(rows.filter("doc_id IS NULL").select("_row.*"))


def op2_minhash_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).select(
        "doc_id", "n_shingles", "component_id",
        F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"))


# all pairs that share a shingle, and components by recursion: for small tables
SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT DISTINCT doc_id, s FROM (
  SELECT doc_id, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= {SHINGLE})
  UNION ALL SELECT doc_id, array_to_string(w, ' ') FROM d WHERE len(w) BETWEEN 1 AND {SHINGLE - 1})),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n_both FROM sets x JOIN sets y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
          WHERE {OF} * n_both >= {NEED} * (p.n + q.n - n_both)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a)
SELECT r.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.other) AS component_id, r.doc_id = min(r.other) AS kept
FROM reach r LEFT JOIN sizes s ON s.doc_id = r.doc_id GROUP BY r.doc_id"""
