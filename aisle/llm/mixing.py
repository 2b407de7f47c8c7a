"""Operator 5: a time-varying curriculum over sources.

1. Targets. Sources (by code point, null last) weigh 5, 2, 1, repeating, and
   share the words of the whole corpus. A target stops at three times its
   source's words; the excess is reshared by weight until none is above. That
   fixed point is ``min(3 * size, level * weight)`` with one common level, which
   the sources' ratios of cap to weight give in closed form.
2. Takes. Inside a source, documents stand in the order of md5(doc_id). The mix
   runs over that order again and again until the target is used up, so a
   document is taken ``floor(target / size)`` times, or once more if the middle of its words
   lies before the rest. Taken words miss the target by at most half a document.
3. Positions. A source's weight at training time t is a piecewise linear
   schedule, scaled so that its integral over [0, 1] is the target. The words
   that the source has given before a copy are its cumulative demand; inverting
   the integral there gives the copy's training position.
4. The mix is range-sorted by position; a copy's place in it is its training rank
   (prefix sums of the counts of ``RANK_BUCKETS`` ranges of positions).
   ``in_written_order`` gives the ranks back when a sorted mix is read from its
   files, which Spark deals out by size and not by name.

The windows over sources run in one task and read one row per source.

Native throughout. A hot source is spread over buckets of the hashed order (its
first hex digits); bucket totals give each bucket's offset, so no task holds a
source.

Defined results: a null or empty text, or one without words, has size 0, is
taken 0 times and has no position; a null source is a source of its own, last;
repeated rows are separate documents; a null ``doc_id`` comes first in its
source; a corpus without words has targets 0; an empty table gives no rows; further input columns pass through ``mix`` unchanged
and never clash with the operator's own.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisle.llm.sharding import prefix_sums
from aisle.llm.store import kept, packed

WORD = r"[^\x20\x09-\x0D]+"
KEY_DIGITS = 3                  # 4096 buckets of the hashed order in a source
RANK_BUCKETS = 4096             # ranges of the positions
BROADCAST_FILES = 200_000
WEIGHTS = (5, 2, 1)
MOST = 3
Knots = Sequence[tuple[float, float]]
#: weight over training time, by the source's rank: rising, even, falling
SCHEDULES: tuple[Knots, ...] = (((0.0, 0.5), (1.0, 1.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 1.5), (1.0, 0.5)))


def source_targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(source, source_size, rank, target), one row per source, from rows
    (source, source_size). Its windows read one row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = (sizes.withColumn("rank", (F.row_number().over(by_name) - 1).cast("int"))
              .withColumn("weight", weight)
              .withColumn("cap", F.col("source_size") * F.lit(float(most)))
              .withColumn("ratio", F.col("cap") / F.col("weight")))
    by_ratio = Window.orderBy("ratio", "rank")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(0, Window.unboundedFollowing)
    everything = by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    level = (F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) \
        / F.sum("weight").over(after)
    # the first source, by ratio, whose cap the level does not reach sets the level
    found = ranked.withColumn("_level", level).withColumn(
        "_level", F.min(F.when(F.col("_level") <= F.col("ratio"), F.struct("ratio", "rank", "_level"))).over(everything))
    return found.select("source", "source_size", "rank",
                        F.least(F.col("cap"), F.coalesce(F.col("_level._level"), F.lit(float("inf"))) * F.col("weight"))
                        .alias("target"))


def invert_schedule(share: Column, knots: Knots) -> Column:
    """The time in [0, 1] by which ``share`` of the schedule's integral is used."""
    parts = [((t1 - t0) * (w0 + w1) / 2, t0, t1, w0, w1) for (t0, w0), (t1, w1) in zip(knots, knots[1:])]
    total = sum(p[0] for p in parts)
    need, done, out = share * F.lit(total), 0.0, None
    for area, t0, t1, w0, w1 in reversed(parts):
        start = sum(p[0] for p in parts if p[1] < t0)
        v = F.greatest(need - F.lit(start), F.lit(0.0))
        slope = (w1 - w0) / (t1 - t0)
        root = F.sqrt(F.greatest(F.lit(w0 * w0) + v * F.lit(2 * slope), F.lit(0.0)))
        here = F.lit(t0) + F.coalesce(F.try_divide(v * 2, F.lit(w0) + root), F.lit(0.0))
        out = here if out is None else F.when(need < F.lit(start + area), here).otherwise(out)
    return F.least(F.greatest(out, F.lit(0.0)), F.lit(1.0))


def sized(docs: DataFrame) -> DataFrame:
    """(doc_id, source, size, _key) of every document, with the whole row as ``_row``."""
    return packed(docs, doc_id=F.col("doc_id"), source=F.col("source"),
                  size=F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long"),
                  _key=F.md5(F.col("doc_id").cast("string").cast("binary")))


def planned(rows: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """``rows`` of ``sized`` with source_size, target, copies, _before, rank."""
    rows = rows.withColumn("_bucket", F.coalesce(F.substring("_key", 1, KEY_DIGITS), F.lit("")))
    summed = prefix_sums(rows, ["source"], "_bucket", [F.col("_key"), F.col("size")], {"_before": F.col("size")})
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goals = source_targets(sizes, weights, most).withColumnRenamed("source", "_source")
    joined = summed.join(goals, summed["source"].eqNullSafe(goals["_source"]), "left")
    passes = F.coalesce(F.floor(F.try_divide(F.col("target"), F.col("source_size"))), F.lit(0))
    rest = F.col("target") - passes * F.col("source_size")
    copies = F.when(F.col("size") > 0, passes + F.when(F.col("_before") + F.col("size") / 2 < rest, 1).otherwise(0)).otherwise(0)
    return joined.withColumn("copies", F.least(copies, F.lit(int(most))).cast("int")).drop("_source", "_bucket", "_key", "_before_total")


def taken(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, _before, rank) of every document."""
    return planned(sized(docs).drop("_row"), weights, most)


def _position(copy: Column, schedules: Sequence[Knots]) -> Column:
    share = F.try_divide(copy * F.col("source_size") + F.col("_before") + F.col("size") / 2, F.col("target"))
    out = None
    for i, knots in reversed(list(enumerate(schedules))):
        here = invert_schedule(share, knots)
        out = here if out is None else F.when(F.col("rank") % len(schedules) == i, here).otherwise(out)
    return out


def training_order() -> list[Column]:
    """The total order of the mix."""
    return [F.col("_position"), F.col("doc_id").asc_nulls_first(), F.col("_copy"), F.col("source").asc_nulls_last()]


def each_copy(plan: DataFrame, schedules: Sequence[Knots] = SCHEDULES) -> DataFrame:
    """A row for every copy that the mix takes, with ``_copy`` and ``_position``."""
    copies = plan.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    return copies.withColumn("_position", _position(F.col("_copy"), schedules))


def mix(docs: DataFrame, weights: Sequence[float] = WEIGHTS, most: float = MOST,
        schedules: Sequence[Knots] = SCHEDULES) -> DataFrame:
    """The training sequence: the rows of ``docs``, as often as they are taken,
    range-sorted by training position."""
    return (each_copy(planned(sized(docs), weights, most), schedules)
            .orderBy(*training_order()).select("_row.*"))


def training_ranks(copies: DataFrame) -> DataFrame:
    """Rows of ``each_copy`` with ``training_rank``, their place (from 0) in the mix."""
    placed = copies.withColumn("_range", F.least(F.floor(F.col("_position") * RANK_BUCKETS), F.lit(RANK_BUCKETS - 1)).cast("int"))
    return prefix_sums(placed, [], "_range", training_order(), {"training_rank": F.lit(1)}).drop("_range", "training_rank_total")


def in_written_order(docs: DataFrame) -> DataFrame:
    """(doc_id, text, training_rank): the place of every row in the Parquet files
    of a sorted write, part by part; null if ``docs`` is not read from files."""
    found = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    name = F.col("_metadata.file_name")
    try:
        rows = docs.select(*found, F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long").alias("_part"),
                           F.regexp_extract(name, r"-c(\d+)[.]", 1).try_cast("long").alias("_chunk"),
                           F.col("_metadata.row_index").alias("_row"))
    except AnalysisException:                       # no file behind the rows, so no order either
        return docs.select(*found, F.lit(None).cast("long").alias("training_rank"))
    before = Window.orderBy("_part", "_chunk").rowsBetween(Window.unboundedPreceding, -1)       # one row per file
    files = kept(rows.groupBy("_part", "_chunk").agg(F.count(F.lit(1)).alias("_n"))
                 .select("_part", "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first")))
    side = F.broadcast(files) if files.count() <= BROADCAST_FILES else files
    on = rows["_part"].eqNullSafe(side["_part"]) & rows["_chunk"].eqNullSafe(side["_chunk"])
    return rows.join(side, on).select("doc_id", "text", (F.col("_first") + F.col("_row")).alias("training_rank"))


def op5_curriculum_mix(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    # texts are read once; whatever follows reads their sizes
    plan = kept(planned(kept(sized(docs).drop("_row"))))
    row = ["doc_id", "source", "size", "source_size", "target", "copies", "_before"]
    # where a document is taken it has words, so (source, _before) names it
    copies = F.array_sort(F.collect_list(F.struct("_copy", "training_rank", "_position")))      # at most MOST
    used = (training_ranks(each_copy(plan)).groupBy(*row).agg(copies.alias("_copies"))
            .withColumn("first_position", F.col("_copies")[0]["_position"])
            .withColumn("training_ranks", F.array_join(F.transform("_copies", lambda x: x["training_rank"].cast("string")), ",")))
    rest = plan.filter("copies = 0").select(*row, F.lit(None).cast("double").alias("first_position"),
                                            F.lit(None).cast("string").alias("training_ranks"))
    return used.drop("_copies").unionByName(rest).select(
        "doc_id", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("size") * F.col("copies")).alias("taken"), "first_position", "training_ranks")


def _position_sql() -> str:
    """The position of a copy by its ``share`` under one-piece schedules."""
    parts = []
    for i, ((_, w0), (_, w1)) in enumerate(SCHEDULES):
        area, slope = (w0 + w1) / 2, w1 - w0
        v = f"greatest(share * {area}::DOUBLE, 0.0)"
        root = f"sqrt(greatest({w0 * w0}::DOUBLE + {v} * {2 * slope}::DOUBLE, 0.0))"
        parts.append(f"WHEN rank % {len(SCHEDULES)} = {i} THEN least(greatest({v} * 2 / ({w0}::DOUBLE + {root}), 0.0), 1.0)")
    return "CASE " + " ".join(parts) + " END"


SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
                  md5(CAST(doc_id AS VARCHAR)) AS k FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM s),
w AS (SELECT *, [5.0, 2.0, 1.0][rank % 3 + 1]::DOUBLE AS weight, source_size * 3.0::DOUBLE AS cap FROM r),
-- the level at which each source, by its ratio of cap to weight, would stop the water
l AS (SELECT *, ((SELECT sum(source_size) FROM w) - coalesce(sum(cap) OVER before, 0.0)) / sum(weight) OVER after AS level
      FROM w WINDOW before AS (ORDER BY cap / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
                    after AS (ORDER BY cap / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
t AS (SELECT source, source_size, rank, least(cap, coalesce(
        (SELECT arg_min(level, rn) FROM (SELECT level, row_number() OVER (ORDER BY cap / weight, rank) AS rn,
                                                level <= cap / weight AS holds FROM l) WHERE holds), 'inf'::DOUBLE) * weight) AS target
      FROM w),
b AS (SELECT d.*, t.source_size, t.rank, t.target,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
c AS (SELECT *, row_number() OVER () AS rid, CAST(least(3, CASE WHEN size > 0 THEN floor(target / source_size)
                       + CASE WHEN before + size / 2 < target - floor(target / source_size) * source_size THEN 1 ELSE 0 END
                     ELSE 0 END) AS BIGINT) AS copies FROM b),
e AS (SELECT *, (copy * source_size + before + size / 2) / target AS share FROM (SELECT *, unnest(range(copies)) AS copy FROM c)),
p AS (SELECT *, {_position_sql()} AS position FROM e),
n AS (SELECT *, row_number() OVER (ORDER BY position, doc_id NULLS FIRST, copy, source NULLS LAST) - 1 AS training_rank FROM p),
m AS (SELECT rid, min(position) AS first_position, string_agg(training_rank, ',' ORDER BY copy) AS training_ranks FROM n GROUP BY rid)
SELECT doc_id, size, source_size, target, CAST(size * copies AS BIGINT) AS taken, first_position, training_ranks
FROM c LEFT JOIN m USING (rid)"""
