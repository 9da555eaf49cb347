"""The corpus pipeline: quality rules, near duplicates, repeated strings, benchmark leaks, pieces."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillwork.llm import decontaminate, minhash, pieces, quality, repeats
from quillwork.llm.common import scratch

STAGES = [
    ("quality_rules", quality.stage),
    ("minhash_near_dedup", minhash.stage),
    ("suffix_array_dedup", repeats.stage),
    ("benchmark_decontamination", decontaminate.stage),
    ("sentencepiece", pieces.stage),
]

#: Sketches, suffix sorting and pieces have no SQL form; tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each stage's rows are written to the shared folder and read back by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = scratch(spark)
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        out.write.parquet(f"{base}/{k}-{name}")
        docs = spark.read.parquet(f"{base}/{k}-{name}")
    return docs
