"""Operator 13: hard-negative mining with an STR-packed R-tree.

Integer vectors are packed sort-tile-recursively: cut points of the first
coordinates, from a bounded sample, deal the rows into tiles of about
``TILE_ROWS`` (every row is indexed; a tile that holds more, as one of equal
vectors, is split by id), and a tile's rows are sorted by label and tiled again
into leaves of ``LEAF_ROWS`` rows of one label, with nodes of ``FAN`` children
above. A minimum bounding box gives an interval of the inner product with an
anchor, coordinate by coordinate: its ends are sums of the smaller or larger of
anchor * low and anchor * high.

A search wants the first k rows, by score and then smaller id, of a score window
and of the anchor's label, or of another. A best-first queue opens the box of the
highest upper end, skips boxes outside the window or without a fitting label, and
ends where the next box is strictly below the k-th row. It runs over tiles alike:
an anchor first searches its own tile, then those whose box is not below the k-th
score found there, so results are exact whatever the sample was.

Two searches make the result: the first ``POSITIVES`` other rows of the anchor's
label, then for each of them the first ``NEGATIVES`` rows of other labels whose
score is ``LEAST`` to ``MOST`` per cent of the positive's.

Scale: queries meet tiles in blocks of at most ``BLOCK_QUERIES`` queries and one
tile; only blocks with a query that needs the tile are made. Inner products are
computed in doubles where they are exact (below 2**53), else in Python integers.

Defined results: rows with a null id, label or vector, or a null or non-finite
component take no part; a shorter vector is filled up with zeros; equal rows
count once, other rows of one id are rows of their own, and none is paired with
its own id; ties go to the smaller id; a positive below 0 has no window (50 % of
it is more than 95 %); an anchor without positives or a positive without
negatives gives no rows; an empty table gives none; further columns are not read.
A score beyond 64 bits ends the query with an error.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aisle.llm.store import kept, new_folder
from aisle.operators.relational import top_k_per_group

TILE_ROWS = 4096
LEAF_ROWS = 64
FAN = 8
SAMPLE_ROWS = 16384
MOST_TILES = 1 << 16
BLOCK_QUERIES = 4096
BLOCK_BOXES = 1024
BATCH_LEAVES = 16
POSITIVES, NEGATIVES = 5, 3
LEAST, MOST = 50, 95
SEED = 13

QUERY = "anchor_id long, version long, label long, z array<long>, ref long, ref_score long, same boolean, lo long, hi long"
KEYS = ["anchor_id", "version", "ref"]
FOUND = "anchor_id long, version long, ref long, ref_score long, score long, vec_id long"


# ---- the tree of one tile ------------------------------------------------------

def matrix(lists: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Rows of integer lists as an int64 matrix of ``width`` columns, filled up with zeros."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    flat = lists.flatten().to_numpy(zero_copy_only=False)
    if (size == width).all():
        return flat.reshape(len(size), width)
    out = np.zeros((len(size), width), np.int64)
    row = np.repeat(np.arange(len(size)), size)
    out[row, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def exact(a: np.ndarray, b: np.ndarray) -> type:
    """A number type in which the products a @ b.T of integer matrices are exact."""
    most = max(1, a.shape[-1]) * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0))
    return np.float64 if most < 2**53 else object


def tiled(z: np.ndarray, rows: np.ndarray, size: int, dims: list[int]) -> list[np.ndarray]:
    """Sort-tile-recursive packing of ``rows`` into groups of about ``size``."""
    if len(rows) <= size or not dims:
        return [rows[i:i + size] for i in range(0, len(rows), size)]
    slabs = math.ceil(math.ceil(len(rows) / size) ** (1 / len(dims)))
    slab = size * math.ceil(len(rows) / size / slabs)
    rows = rows[np.argsort(z[rows, dims[0]], kind="stable")]
    return [g for i in range(0, len(rows), slab) for g in tiled(z, rows[i:i + slab], size, dims[1:])]


def widest(z: np.ndarray, n: int) -> list[int]:
    """The ``n`` coordinates of greatest variance."""
    return np.argsort(-z.astype(np.float64).var(axis=0), kind="stable")[:n].tolist() if len(z) else []


def pack(ids: np.ndarray, labels: np.ndarray, z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order of the rows, first row of every leaf): leaves of one label each."""
    by_label = np.lexsort((ids, labels))
    edges = np.flatnonzero(np.diff(labels[by_label])) + 1
    leaves = []
    for rows in np.split(by_label, edges):
        dims = widest(z[rows], max(1, min(3, z.shape[1], int(math.log2(max(2, len(rows) / LEAF_ROWS))))))
        leaves += tiled(z, rows, LEAF_ROWS, dims)
    sizes = [len(g) for g in leaves]
    return np.concatenate(leaves), np.concatenate(([0], np.cumsum(sizes)[:-1])).astype(np.int64)


class Tree:
    """Packed rows; nodes from the leaves up, with their boxes and label intervals."""

    def __init__(self, ids, labels, z, starts):
        self.ids, self.labels, self.z = ids, labels, z
        self.ends = np.append(starts[1:], len(ids))
        self.starts = starts
        low, high = np.minimum.reduceat(z, starts), np.maximum.reduceat(z, starts)
        first, last = labels[starts], labels[starts]
        lows, highs, firsts, lasts = [low], [high], [first], [last]
        self.children = [None] * len(starts)
        base, n = 0, len(starts)
        while n > 1:
            at = np.arange(0, n, FAN)
            self.children += [range(base + i, base + min(i + FAN, n)) for i in at]
            low, high = np.minimum.reduceat(low, at), np.maximum.reduceat(high, at)
            first, last = np.minimum.reduceat(first, at), np.maximum.reduceat(last, at)
            for seq, part in ((lows, low), (highs, high), (firsts, first), (lasts, last)):
                seq.append(part)
            base, n = base + n, len(at)
        self.low, self.high = np.concatenate(lows), np.concatenate(highs)
        self.first, self.last = np.concatenate(firsts), np.concatenate(lasts)

    def search(self, a, upper, lower, label, same, own, lo, hi, k) -> list[tuple[int, int]]:
        """Best-first: the first k (-score, id) of the window [lo, hi]."""
        fits = ((self.first <= label) & (label <= self.last)) if same else ((self.first != label) | (self.last != label))
        fits &= (lower <= hi) & (upper >= lo)
        root = len(self.children) - 1
        queue = [(-upper[root], root)] if fits[root] else []
        best: list[tuple[int, int]] = []
        least = lo
        while queue and -queue[0][0] >= least:
            leaves = []
            while queue and len(leaves) < BATCH_LEAVES and -queue[0][0] >= least:
                node = heapq.heappop(queue)[1]
                if self.children[node] is None:
                    leaves.append(node)
                    continue
                for c in self.children[node]:
                    if fits[c] and upper[c] >= least:
                        heapq.heappush(queue, (-upper[c], c))
            if not leaves:
                continue
            rows = np.concatenate([np.arange(self.starts[i], self.ends[i]) for i in leaves])
            score = self.z[rows] @ a
            hit = (score >= least) & (score <= hi) & (self.ids[rows] != own)
            rows, score = rows[hit], score[hit]
            if len(rows) > k:
                kth = np.partition(score, len(score) - k)[len(score) - k] if score.dtype != object else sorted(score)[-k]
                rows, score = rows[score >= kth], score[score >= kth]
            if len(rows):
                best = sorted(best + [(-int(s), int(i)) for s, i in zip(score, self.ids[rows])])[:k]
                if len(best) == k:
                    least = max(lo, -best[-1][0])
        return best


def interval(a: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the inner products of every row of ``a`` with any point of every box."""
    plus, minus = np.maximum(a, 0), np.minimum(a, 0)
    return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


# ---- the index -------------------------------------------------------------------

def cut_tree(sample: np.ndarray, tiles: int) -> tuple[list[int], int, dict]:
    """Coordinates, cuts per coordinate and, by the path of earlier slabs, the cut
    points that deal rows into about ``tiles`` tiles."""
    if tiles < 2 or not len(sample) or not sample.shape[1]:
        return [], 1, {}
    dims = widest(sample, min(sample.shape[1], 1 if tiles <= 4 else 2 if tiles <= 64 else 3))
    slabs = math.ceil(tiles ** (1 / len(dims)))
    cuts: dict = {}

    def cut(rows, depth, path):
        if depth == len(dims):
            return
        values = np.sort(sample[rows, dims[depth]])
        points = np.unique(values[[len(values) * i // slabs for i in range(1, slabs)]]) if len(values) else values
        cuts[path] = points
        at = np.searchsorted(points, sample[rows, dims[depth]], side="right")
        for s in range(len(points) + 1):
            cut(rows[at == s], depth + 1, path * slabs + s)

    # a path starts with 1, so that paths of different depths differ
    cut(np.arange(len(sample)), 0, 1)
    return dims, slabs, cuts


def tile_of(z: np.ndarray, dims: list[int], slabs: int, cuts: dict) -> np.ndarray:
    path = np.ones(len(z), np.int64)
    for d in dims:
        at = np.zeros(len(z), np.int64)
        for p in np.unique(path):
            here = path == p
            at[here] = np.searchsorted(cuts[int(p)], z[here, d], side="right")
        path = path * slabs + at
    return path


def vectors(rows: DataFrame, vector: str) -> DataFrame:
    """Rows that take part: (vec_id, label, z) with integer components."""
    c = F.col(vector)
    sound = F.forall(c, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < F.lit(float("inf"))))
    return (rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & c.isNotNull()).filter(sound)
            .select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                    F.transform(c, lambda x: F.floor(x.cast("double") * 256).cast("long")).alias("z")))


class Index:
    """Tiles as a table in the shared folder, one packed tree a row, and the rows' tiles."""

    def __init__(self, points: DataFrame, tile_rows: int = TILE_ROWS):
        spark = points.sparkSession
        points = kept(points)
        size = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("z")).alias("d")).first()
        self.width = width = size["d"] or 0
        sample = (points.orderBy(F.xxhash64("vec_id", F.lit(SEED)), "vec_id").limit(SAMPLE_ROWS).select("z").toArrow()["z"])
        cuts = cut_tree(matrix(sample, width), min(MOST_TILES, math.ceil(size["n"] / tile_rows)))
        sent = spark.sparkContext.broadcast(cuts)

        def assign(batches):
            for b in batches:
                t = tile_of(matrix(b.column(2), width), *sent.value)
                yield pa.RecordBatch.from_arrays([*b.columns, pa.array(t)], names=["vec_id", "label", "z", "tile"])

        dealt = points.mapInArrow(assign, "vec_id long, label long, z array<long>, tile long")
        # one row per tile of the cut tree: at most a few times MOST_TILES
        parts = dealt.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / (2 * tile_rows)).alias("parts")).filter("parts > 1")
        part = F.pmod(F.xxhash64("vec_id", F.lit(SEED)), F.coalesce("parts", F.lit(1)))
        # the place of a part: its tile and number in one column
        self.rows = kept(dealt.join(F.broadcast(parts), "tile", "left")
                         .select("vec_id", "label", "z", F.concat_ws("-", "tile", part).alias("tile")))

        def build(rows: pa.Table) -> pa.Table:
            ids, labels, z = rows["vec_id"].to_numpy(), rows["label"].to_numpy(), matrix(rows["z"], width)
            one = np.unique(np.column_stack((ids, labels, z)), axis=0)          # equal rows count once
            ids, labels, z = one[:, 0], one[:, 1], one[:, 2:]
            order, starts = pack(ids, labels, z)
            blob = lambda x: pa.array([np.ascontiguousarray(x).tobytes()], pa.binary())
            small = np.abs(z).max(initial=0) < 2**31
            listed = lambda x: pa.array([x], pa.list_(pa.int64()))
            return pa.Table.from_arrays(
                [rows["tile"].slice(0, 1), blob(ids[order]), blob(labels[order]), blob(z[order].astype(np.int32 if small else np.int64)),
                 blob(starts), pa.array([bool(small)]), listed(z.min(0)), listed(z.max(0)),
                 pa.array([labels.min()], pa.int64()), pa.array([labels.max()], pa.int64())],
                names=["tile", "ids", "labels", "z", "starts", "small", "low", "high", "first", "last"])

        folder = new_folder(spark, "rtree")
        (self.rows.groupBy("tile").applyInArrow(build, "tile string, ids binary, labels binary, z binary, starts binary, small boolean, "
                                                       "low array<long>, high array<long>, first long, last long")
         .write.parquet(folder))
        self.tiles = spark.read.parquet(folder)
        self.count = self.tiles.count()

    def tree(self, row: pa.Table) -> Tree:
        got = {c: row[c][0].as_py() for c in ("ids", "labels", "z", "starts", "small")}
        ids, labels, starts = (np.frombuffer(got[c], np.int64) for c in ("ids", "labels", "starts"))
        z = np.frombuffer(got["z"], np.int32 if got["small"] else np.int64).reshape(len(ids), self.width).astype(np.int64)
        return Tree(ids, labels, z, starts)


def needed(queries: DataFrame, index: Index, blocks: int) -> DataFrame:
    """Queries beside every tile but their own whose box they need, block by block."""
    across = math.ceil(max(1, index.count) / BLOCK_BOXES)
    left = queries.withColumn("_b", F.explode(F.sequence(F.lit(0), F.lit(across - 1))))
    right = (index.tiles.select(F.col("tile").alias("box"), "low", "high", "first", "last")
             .withColumn("_over", F.pmod(F.xxhash64("box"), F.lit(across)).cast("int"))
             .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))))
    width = index.width

    def run(q: pa.Table, boxes: pa.Table) -> pa.Table:
        q = q.drop_columns(["_b"])
        names = np.array(boxes["box"].to_pylist(), dtype=object)
        a, low, high = (matrix(c, width) for c in (q["z"], boxes["low"], boxes["high"]))
        kind = exact(a, np.concatenate((low, high)))
        lower, upper = interval(a.astype(kind), low.astype(kind), high.astype(kind))
        label, same, lo, hi = (q[c].to_numpy()[:, None] for c in ("label", "same", "lo", "hi"))
        first, last = boxes["first"].to_numpy()[None], boxes["last"].to_numpy()[None]
        fits = np.where(same, (first <= label) & (label <= last), (first != label) | (last != label))
        home = np.array(q["home"].to_pylist(), dtype=object)[:, None] == names[None]
        at, to = np.nonzero((fits & (upper >= lo) & (lower <= hi) & ~home).astype(bool))
        return q.take(pa.array(at)).append_column("tile", pa.array(names[to].tolist(), pa.string()))

    schema = f"{QUERY}, home string, block int, tile string"
    return left.groupBy("block", "_b").cogroup(right.groupBy("_block", "_over")).applyInArrow(run, schema)


def visited(visits: DataFrame, index: Index, k: int) -> DataFrame:
    """The first k rows of every (query, tile)."""
    wanted = visits.select(F.col("tile").alias("_tile"), F.col("block").alias("_block")).distinct()
    trees = index.tiles.join(wanted, index.tiles["tile"] == wanted["_tile"]).drop("tile")

    def run(q: pa.Table, tile: pa.Table) -> pa.Table:
        tree = index_tree(tile)
        a = matrix(q["z"], width)
        kind = exact(a, tree.z)
        a, tree.z, tree.low, tree.high = (x.astype(kind) for x in (a, tree.z, tree.low, tree.high))
        lower, upper = interval(a, tree.low, tree.high)
        cols = [q[c].to_pylist() for c in ("anchor_id", "version", "ref", "ref_score", "label", "same", "lo", "hi")]
        out = []
        for i, (anchor, version, ref, ref_score, label, same, lo, hi) in enumerate(zip(*cols)):
            out += [(anchor, version, ref, ref_score, -s, v)
                    for s, v in tree.search(a[i], upper[i], lower[i], label, same, anchor, lo, hi, k)]
        flat = list(zip(*out)) if out else [[]] * 6
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("anchor_id", "version", "ref", "ref_score", "score", "vec_id"), flat)})

    width, index_tree = index.width, _Tree(index.width)
    return visits.groupBy("tile", "block").cogroup(trees.groupBy("_tile", "_block")).applyInArrow(run, FOUND)


class _Tree:
    """Reads a stored tile; carries no table into the tasks."""

    def __init__(self, width: int):
        self.width = width

    tree = Index.tree

    def __call__(self, row: pa.Table) -> Tree:
        return self.tree(row)


def first_rows(queries: DataFrame, index: Index, k: int) -> DataFrame:
    """The first k rows of every query over all tiles, with ``rank``."""
    n = queries.count()
    blocks = max(1, math.ceil(n / BLOCK_QUERIES))
    queries = queries.withColumn("block", F.pmod(F.xxhash64("anchor_id", "ref", F.lit(SEED)), F.lit(blocks)).cast("int"))
    home = kept(visited(queries.withColumn("tile", F.col("home")), index, k))
    # the k-th score of the own tile bounds what other tiles can add
    bound = (home.groupBy(*[F.col(c).alias(f"_{c}") for c in KEYS])
             .agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).alias("_kth")))
    same = [queries[c] == bound[f"_{c}"] for c in KEYS]
    rest = queries.join(bound, same, "left").withColumn("lo", F.greatest("lo", F.col("_kth"))).select(*queries.columns)
    found = home.unionByName(visited(kept(needed(rest, index, blocks)), index, k))
    return top_k_per_group(found, KEYS, [F.col("score").desc(), F.col("vec_id")], k)


def hard_negatives(points: DataFrame, anchors, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Per anchor (rows of ``points`` for which the column ``anchors`` holds) and
    positive the first negatives of its window."""
    index = Index(points, tile_rows)
    version = F.xxhash64("label", "z")
    every = F.lit(2**62)
    asked = kept(index.rows.filter(anchors).distinct()
                 .select(F.col("vec_id").alias("anchor_id"), version.alias("version"), "label", "z", F.lit(0).cast("long").alias("ref"),
                         F.lit(0).cast("long").alias("ref_score"), F.lit(True).alias("same"), (-every).alias("lo"), every.alias("hi"),
                         F.col("tile").alias("home")))
    positives = first_rows(asked, index, POSITIVES).select(
        *[F.col(c).alias(f"_{c}") for c in ("anchor_id", "version")], F.col("vec_id").alias("_ref"), F.col("score").alias("_score"))
    windows = kept(asked.join(positives, (asked["anchor_id"] == positives["_anchor_id"]) & (asked["version"] == positives["_version"]))
                   .filter("_score >= 0")
                   .select("anchor_id", "version", "label", "z", F.col("_ref").alias("ref"), F.col("_score").alias("ref_score"),
                           F.lit(False).alias("same"),
                           # scores are whole: the ends of 50 % to 95 % of the positive's, rounded inwards
                           F.expr(f"cast(ceil(cast(_score as decimal(19,0)) * {LEAST} / 100) as bigint)").alias("lo"),
                           F.expr(f"cast(floor(cast(_score as decimal(19,0)) * {MOST} / 100) as bigint)").alias("hi"), "home")
                   .filter("lo <= hi"))
    return first_rows(windows, index, NEGATIVES).select(
        "anchor_id", F.col("ref").alias("positive_id"), "rank", F.col("vec_id").alias("negative_id"),
        F.col("ref_score").alias("positive_score"), F.col("score").alias("negative_score"))


def op13_rtree_negatives(spark, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors(rows.withColumn("label", moved), "embedding"), F.col("vec_id") % 50 == 0)


SQL = """
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS z
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.z, b.z) AS BIGINT) AS score
  FROM r AS a JOIN r AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.vec_id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3
"""
