"""Files in the cluster's shared folder (``spark.checkpoint.dir``).

Tasks write under a name of their own (a fresh id per attempt) and return it in
a manifest row, which the caller checkpoints. A retried or speculative attempt
therefore never touches a file that a manifest names, and a file left by a lost
attempt is named by none.
"""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aisle.session import shared_dir


def new_folder(spark: SparkSession, kind: str) -> str:
    """A new folder name below the shared folder, as a URI or a path."""
    return shared_dir(spark, f"{kind}-{uuid.uuid4().hex}")


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and path of a URI such as file:, hdfs: or s3:, or of a path."""
    if "://" in uri or uri.startswith("file:"):
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


def new_name(prefix: str, suffix: str) -> str:
    return f"{prefix}-{uuid.uuid4().hex}{suffix}"


def kept(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder once and read it from there: every
    later reader sees the same rows, also after an executor is lost."""
    shared_dir(df.sparkSession, "")
    return df.checkpoint(eager=True)


def tasks_of(spark: SparkSession) -> int:
    """Partitions for a shuffle of whole texts: the session's setting, which the
    operator of the cluster sizes to the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def packed(docs: DataFrame, **more) -> DataFrame:
    """All columns of ``docs`` as one struct ``_row`` beside the columns that an
    operator needs, so that no column of the input can clash with them."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[c.alias(n) for n, c in more.items()])
