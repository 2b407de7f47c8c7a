"""Registry of the training-data queries: one ``opN_<name>`` per operator, over
the whole of its table with production parameters."""

from __future__ import annotations

import importlib
import os
from collections.abc import Callable
from functools import partial

from pyspark.sql import DataFrame, SparkSession

#: query -> module; the function has the query's name
MODULES = {
    "op1_order_minhash": "fingerprints",
    "op2_minhash_dedup": "neardup",
    "op3_byte_shards": "sharding",
    "op4_warc_history": "warc",
    "op5_curriculum_mix": "mixing",
    "op6_importance_resampling": "importance",
    "op7_piece_viterbi": "pieces",
    "op8_cross_parsing": "language",
    "op9_adaptive_rules": "rules",
    "op10_bit_planes": "tokens",
    "op11_setm_collocations": "collocations",
    "op12_factorization_machine": "toxicity",
    "op13_rtree_negatives": "hard_negatives",
}


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver has it; on
    a cluster that installs the package the extra path does nothing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def _run(name: str, spark: SparkSession, sf_dir: str) -> DataFrame:
    share_code(spark)
    return getattr(importlib.import_module(f"aisle.llm.{MODULES[name]}"), name)(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {n: partial(_run, n) for n in MODULES}


def all_sql() -> dict[str, str]:
    found = {n: importlib.import_module(f"aisle.llm.{m}").SQL for n, m in MODULES.items()}
    return {n: q for n, q in found.items() if q}
