"""The corpus pipeline: raw documents to encoded training text.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet and read again as the next stage's ``docs``. All stages but
the last return the columns of ``docs``; the last returns (doc_id,
training_rank, ids): the place of a row in the training order that the source
mix wrote, as Spark reads files back in another order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from aisle.llm import importance, mixing, neardup, pieces, rules
from aisle.llm.queries import share_code
from aisle.llm.store import new_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the adaptive quality rules reject go."""
    share_code(spark)
    return rules.filter_documents(docs)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: documents that the importance resampling does not draw go."""
    share_code(spark)
    return importance.resample_documents(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: one document of each group of near-duplicates stays."""
    share_code(spark)
    return neardup.drop_near_duplicates(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents as often as the mix takes them, in training order."""
    return mixing.mix(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: the piece ids of every document, and its place in training."""
    share_code(spark)
    return pieces.encode_texts(mixing.in_written_order(docs), pieces.vocabulary_path())


STAGES = [("quality_rules", quality_rules), ("quality_classifier", quality_classifier), ("near_dedup", near_dedup),
          ("source_mix", source_mix), ("encode_pieces", encode_pieces)]

# the stages are not SQL; tests hold them against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = new_folder(spark, "pipeline")
    for name, stage in STAGES:
        out = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
