"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

import os
from collections.abc import Callable
from importlib import import_module

from pyspark.sql import DataFrame, SparkSession

_MODULES = {
    "op1_quality_qda": ("quality_qda", "op1"),
    "op2_decontaminate": ("decontaminate", "op2"),
    "op3_lpf_dedup": ("lpf_dedup", "op3"),
    "op4_tag_paths": ("tag_paths", "op4"),
    "op5_chunk_dedup": ("chunk_dedup", "op5"),
    "op6_perplexity": ("perplexity", "op6"),
    "op7_token_scan": ("token_scan", "op7"),
    "op8_bpe_codec": ("bpe_codec", "op8"),
    "op9_feistel_shards": ("shards", "op9"),
    "op10_jaccard_join": ("jaccard_join", "op10"),
    "op11_hard_negatives": ("hard_negatives", "op11"),
    "op12_merkle_manifest": ("merkle", "op12"),
    "op13_chat_format": ("chat_format", "op13"),
}


#: rows and bytes that Spark hands a Python worker at a time, where the session has Spark's own defaults (10,000 rows, 64 MB)
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16777216b")}


def prepare(spark: SparkSession) -> None:
    """Small batches for Python workers, which hold texts, and the package on their path (a no-op where it is installed)."""
    for key, (default, value) in BATCHES.items():
        if spark.conf.get(key) == default:
            spark.conf.set(key, value)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])


def _query(module: str, name: str) -> Callable[[SparkSession, str], DataFrame]:
    fn = getattr(import_module(f"ptloom.llm.{module}"), name)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir.rstrip("/"))

    return run


QUERIES = {k: _query(*v) for k, v in _MODULES.items()}
ORACLE = {k: sql for k, (module, _) in _MODULES.items() if (sql := getattr(import_module(f"ptloom.llm.{module}"), "ORACLE", None))}
