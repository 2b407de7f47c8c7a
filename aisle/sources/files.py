"""Readers and writers (A1-A5).

* ``read_csv``      CSV with header and an explicit schema (A1); ``inferSchema``
                    only when no schema is known.
* ``scan_csv``      CSV without a schema: one pass finds each column's narrowest type,
                    a second one reads, and records that do not fit go to quarantine
                    with a reason (A1).
* ``read_table``    parquet table by path (A4).
* ``write_table``   full-refresh (overwrite) materialisation (A2, A6).
* ``table_counts``  row count per table as one DataFrame (A3).
* ``list_tables``   names of the session's tables and views (A3).
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    r = spark.read.option("header", True).option("mode", "PERMISSIVE")
    if schema is None:
        return r.option("inferSchema", True).csv(path)
    return r.schema(schema).csv(path)


BAD = "_bad_record"
# from narrow to wide; a column gets the first type that enough of its values have
TYPES = ["boolean", "bigint", "double", "date", "timestamp_ntz"]


def _typed(column: str, kind: str) -> Column:
    return F.expr(f"try_cast(trim(`{column}`) AS {kind})")


def infer_types(raw: DataFrame, columns: Sequence[str], tolerance: float = 0.05) -> dict[str, str]:
    """The narrowest type of every string column that all but ``tolerance`` of its
    values have, else string. One aggregate over all rows, of mergeable counts."""
    counts = [F.count(F.when(F.trim(F.col(f"`{c}`")) != "", 1)).alias(f"{i}_n") for i, c in enumerate(columns)]
    counts += [F.count(_typed(c, t)).alias(f"{i}_{t}") for i, c in enumerate(columns) for t in TYPES]
    row = raw.agg(*counts).first()
    return {c: next((t for t in TYPES if row[f"{i}_n"] and row[f"{i}_{t}"] >= (1 - tolerance) * row[f"{i}_n"]), "string")
            for i, c in enumerate(columns)}


def scan_csv(spark: SparkSession, path: str, tolerance: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """(rows, rejected) of a CSV file or folder with header. Types are inferred from
    all rows; empty fields are null. A record with too few or too many fields, or with
    a field that is not of its column's type, is no row but stands in ``rejected`` as
    its text fields beside ``reason``, which names the first such field."""
    names = spark.read.option("header", True).option("escape", '"').csv(path).columns
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*names, BAD)])
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", BAD).option("columnPruning", False).option("escape", '"').csv(path))
    kinds = infer_types(raw, names, tolerance)
    # always true, but it reads every field: a reader of the marker alone would be refused
    parsed = F.length(F.concat_ws("", *[F.col(f"`{c}`") for c in names])) >= 0
    why = F.when(F.col(BAD).isNotNull() & parsed, F.lit("wrong number of fields"))
    for c, t in kinds.items():
        if t != "string":
            bad = (F.trim(F.col(f"`{c}`")) != "") & _typed(c, t).isNull()
            why = why.when(bad, F.concat(F.lit(f"{c}: '"), F.col(f"`{c}`"), F.lit(f"' is no {t}")))
    marked = raw.withColumn("reason", why)
    rows = marked.filter(F.col("reason").isNull()).select(
        *[(F.col(f"`{c}`") if t == "string" else _typed(c, t)).alias(c) for c, t in kinds.items()])
    return rows, marked.filter(F.col("reason").isNotNull()).select(*[F.col(f"`{c}`") for c in names], "reason")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def register_views(frames: Mapping[str, DataFrame]) -> None:
    """Expose relations by name for SQL users (A5)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def query_views(spark: SparkSession, text: str, views: Mapping[str, DataFrame], **values) -> DataFrame:
    """SQL over relations with bound parameters (A5, A9): ``:name`` in the text is a value
    or an array, never pasted text; ``{view}`` is the name under which a relation is
    registered, fresh for every call, so that sessions with many callers do not clash."""
    names = {v: f"{v}_{uuid.uuid4().hex}" for v in views}
    register_views({names[v]: df for v, df in views.items()})
    return spark.sql(text.format(**names), args=values)


def table_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """One row per table: (table_name, row_count). Each count is a partial
    aggregate over its own scan; the union carries one row per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in frames.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def list_tables(spark: SparkSession) -> DataFrame:
    names = [(t.name, t.tableType) for t in spark.catalog.listTables()]
    return spark.createDataFrame(names, "table_name string, table_type string")
