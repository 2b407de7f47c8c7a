"""Operator 3: contiguous, byte-balanced shards (law ``bytes``).

Documents are laid out in ascending ``doc_id``. Bucket totals of the sizes are
summed up to a global byte offset for every document, and the line of offsets
is cut at equal targets: a document goes to shard ``offset * shards / total``.
Shards are contiguous in ``doc_id`` and differ from the target by less than the
largest document. All steps are native; only (doc_id, size, checksum) is
shuffled, never a text, and no task holds more than one bucket of the order.

Defined results: a null or empty text has size 1; a null ``doc_id`` sorts first;
repeated rows are separate rows with slots of their own, ordered by checksum and
size; an empty table gives no rows; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aisle.llm.store import kept, tasks_of
from aisle.operators.prefix import bucket_by, cut_points

MOST_BUCKETS = 512


def prefix_sums(rows: DataFrame, group: Sequence[str], bucket: str, order: Sequence[Column],
                values: dict[str, Column]) -> DataFrame:
    """``rows`` and, for every entry of ``values``, its sum over the earlier rows of
    the group, and over all of them as ``<name>_total``. Rows stand in the order of
    (bucket, order); a bucket is one task's share of a group. The totals have one
    row per group and bucket, and windows over whole groups read only those."""
    cells = rows.withColumn("_cell", F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], F.col(bucket).alias("b")))
    of_group = Window.partitionBy(*[f"_cell.g{i}" for i in range(len(group))])
    earlier = of_group.orderBy("_cell.b").rowsBetween(Window.unboundedPreceding, -1)
    totals = cells.groupBy("_cell").agg(*[F.sum(v).alias(n) for n, v in values.items()])
    starts = totals.select(F.col("_cell").alias("_start_of"),
                           *[F.coalesce(F.sum(n).over(earlier), F.lit(0)).alias(f"_start_{n}") for n in values],
                           *[F.sum(n).over(of_group).alias(f"{n}_total") for n in values])
    inside = Window.partitionBy("_cell").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    summed = cells.join(starts, cells["_cell"] == starts["_start_of"], "left").withColumns(
        {n: F.col(f"_start_{n}") + F.coalesce(F.sum(v).over(inside), F.lit(0)) for n, v in values.items()})
    return summed.drop("_cell", "_start_of", *[f"_start_{n}" for n in values])


def byte_shards(docs: DataFrame, shards: int = 16) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) of every document."""
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    light = kept(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw).cast("long") + 1).alias("size"),
        F.crc32(raw).alias("text_crc32")))
    cuts = cut_points(light, "doc_id", min(MOST_BUCKETS, tasks_of(docs.sparkSession)))
    placed = light.withColumn("_bucket", bucket_by(F.col("doc_id"), cuts))
    order = [F.col("doc_id").asc_nulls_first(), F.col("text_crc32"), F.col("size")]
    summed = prefix_sums(placed, [], "_bucket", order, {"_bytes": F.col("size"), "_rows": F.lit(1)})
    share = F.expr(f"cast(_bytes as decimal(30,0)) * {shards} div _bytes_total")
    cut = summed.withColumn("shard", F.least(share.cast("int"), F.lit(shards - 1)))
    # one row per shard: a bound given by the parameter
    first = cut.groupBy("shard").agg(F.min("_rows").alias("_first"))
    return (cut.join(F.broadcast(first), "shard")
            .select("doc_id", "size", "text_crc32", "shard", (F.col("_rows") - F.col("_first")).alias("slot")))


def op3_byte_shards(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return byte_shards(docs).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


# DuckDB has no crc32: its table of 256 values, then a fold over the bytes
SQL = """
WITH RECURSIVE steps AS (
  SELECT n, n AS c, 0 AS k FROM range(256) AS t(n)
  UNION ALL SELECT n, CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
tbl AS (SELECT list(c ORDER BY n) AS t FROM steps WHERE k = 8),
d AS (SELECT doc_id, CAST(strlen(coalesce(text, '')) + 1 AS BIGINT) AS size,
             xor(list_reduce([('0x' || x)::BIGINT for x in regexp_extract_all(hex(encode(coalesce(text, ''))), '..')],
                             lambda a, b: xor(a >> 8, tbl.t[(xor(a, b) & 255) + 1]), 4294967295), 4294967295) AS text_crc32
      FROM documents, tbl),
o AS (SELECT *, coalesce(sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size
                                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
             (SELECT sum(size) FROM d) AS total FROM d),
c AS (SELECT *, CAST(least(before * 16 // total, 15) AS INTEGER) AS shard FROM o)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM c"""
