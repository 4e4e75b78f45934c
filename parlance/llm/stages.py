"""Stages of the corpus pipeline: (spark, docs, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import bpe, decontam, jaccard, lines, toxicity
from parlance.llm.common import stash, table
from parlance.llm.queries import tokenizer_file


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Toxic documents go."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeated runs of lines go; every document stays."""
    return lines.dedup(docs)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component stays, the one with the smallest id (then the smallest hash of
    id and text; a null id comes last). Rows are told apart by id and text: rows equal in both are
    one document, rows equal in the id only are not. Documents without words stay."""
    named = stash(jaccard.join(docs, keys=True).where("n_shingles > 0"), "joined")
    row = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_key")
    first = stash(named.groupBy("class_key").agg(F.min(row).alias("first")), "first")
    gone = named.join(first, "class_key").where(row != F.col("first")).select("doc_id", "row_key").distinct()
    same = (F.xxhash64(docs["doc_id"], docs["text"]) == gone["row_key"]) & docs["doc_id"].eqNullSafe(gone["doc_id"])
    return docs.join(gone, same, "left_anti")


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, digests, ids) of every document: the last stage returns these columns only."""
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(docs, ranks, decoded=True), extra=["ids"])


STAGES = [("toxicity", toxicity_stage), ("line dedup", line_dedup_stage), ("n-gram Jaccard join", jaccard_stage),
          ("benchmark decontamination", decontamination_stage), ("byte-level BPE", bpe_stage)]
