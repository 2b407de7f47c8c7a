"""Stored tables: crash-safe refresh and keyed lookup.

* ``TableStore.refresh``  builds a table under a fresh name, checks that what can be
  read back has as many rows as were written, and only then appends a pointer row.
  Readers resolve the newest pointer, so a write that fails half-way, or a reader
  that started before, leaves the earlier table as it was.
* ``store_by_key``        a table bucketed and sorted by its key, with Parquet bloom
  filters: a lookup opens the key's buckets alone, and in them the row groups that
  may hold it.

Everything goes through Spark's readers and writers, so a folder may lie in any
store that Spark reaches.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINTER = "name string, version long, path string, row_count long, table_schema string"


class TableStore:
    """Tables below one folder, by name."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    @property
    def _pointers(self) -> str:
        return f"{self.folder}/_pointers"

    def pointers(self) -> DataFrame:
        """Every version that was ever swapped in (none: an empty relation)."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._pointers)
        if not path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path):
            return self.spark.createDataFrame([], POINTER)
        return self.spark.read.schema(POINTER).json(self._pointers)

    def _newest(self, name: str):
        return self.pointers().filter(F.col("name") == name).orderBy(F.col("version").desc()).limit(1).collect()

    def current(self) -> DataFrame:
        """One row per table: its newest version."""
        newest = F.max_by(F.struct("version", "path", "row_count"), "version").alias("p")
        return self.pointers().groupBy("name").agg(newest).select("name", "p.version", "p.path", "p.row_count")

    def refresh(self, name: str, df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
        """Replace the table ``name`` by ``df`` and return it as readers see it. One
        writer per table at a time, as of any full refresh."""
        path = f"{self.folder}/{name}/v-{uuid.uuid4().hex}"
        seen = Observation()
        w = df.observe(seen, F.count(F.lit(1)).alias("n")).write
        (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
        written, stored = seen.get["n"], self.spark.read.schema(df.schema).parquet(path).count()
        if written != stored:
            raise IOError(f"table {name}: {written} rows were written, {stored} can be read; the earlier table stays")
        last = self._newest(name)
        row = (name, last[0]["version"] + 1 if last else 1, path, stored, df.schema.json())
        # one row in one file: it is there as a whole or not at all
        self.spark.createDataFrame([row], POINTER).coalesce(1).write.mode("append").json(self._pointers)
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        """The newest version of the table ``name``."""
        last = self._newest(name)
        if not last:
            raise KeyError(f"no table {name} in {self.folder}")
        schema = T.StructType.fromJson(json.loads(last[0]["table_schema"]))
        return self.spark.read.schema(schema).parquet(last[0]["path"])


def drop_folder(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def store_by_key(df: DataFrame, key: str, folder: str, name: str, buckets: int = 32) -> DataFrame:
    """``df`` as the catalogue table ``name`` in ``folder``, for lookups by ``key``. Rows
    are dealt by the key's bucket first, so that a bucket is one sorted file."""
    (df.repartition(buckets, key).write.format("parquet").bucketBy(buckets, key).sortBy(key)
     .option("path", folder)
     .option(f"parquet.bloom.filter.enabled#{key}", "true")
     .saveAsTable(name))
    return df.sparkSession.table(name)


def lookup(stored: DataFrame, key: str, values: Sequence) -> DataFrame:
    """Rows of the keys ``values``: bucket pruning and the pushed IN list do the work.
    For many keys join a relation of keys instead."""
    return stored.filter(F.col(key).isin(list(values)))
