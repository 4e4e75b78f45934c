"""Corpus pipeline: toxicity, line dedup, n-gram Jaccard join, benchmark decontamination and
byte-level BPE, each stage on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parlance.llm.common import stash, table
from parlance.llm.stages import STAGES  # noqa: F401

#: Learned and iterative stages have no SQL form; tests compare each stage with a brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; each stage's result is written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
