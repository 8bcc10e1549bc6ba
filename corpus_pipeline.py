"""A training corpus from the documents table, in stages that each read what the one before has written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pressgauge.llm import decontaminate, jaccard_join, mixing, pii, toxicity
from pressgauge.llm.graph import written

STAGES = [
    ("toxicity", toxicity.stage),
    ("jaccard_join", jaccard_join.stage),
    ("decontamination", decontaminate.stage),
    ("pii", pii.stage),
    ("mixing", mixing.stage),
]

#: The stages' models and hashes have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
