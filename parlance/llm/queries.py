"""Registered queries of the numbered operators and the pipeline's stages: whole tables, production
parameters, the contract's columns."""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.llm import (
    bpe, chat, decontam, jaccard, langid, lines, periodic, pii, quality, simhash, tokens, toxicity, trie)
from parlance.llm.common import fold_of, stash, table


@lru_cache(maxsize=4)
def tokenizer_file(name: str) -> bytes:
    """Content of a public tokenizer file, read on the driver."""
    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json").decode())


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.report(rows.unionByName(extra))


def op3_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = tokenizer_file("byte_bpe_50k.tiktoken")
    return bpe.digests(bpe.encode(table(spark, sf_dir, "documents"), ranks, decoded=True))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    dicts = langid.dictionaries(docs.where(fold_of("doc_id", 4) != 2))
    out = langid.predict(docs, dicts, extra={"held_out": fold_of("doc_id", 4) == 2})
    return out.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lines.dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)
    return out.select("doc_id", "n_words", "n_removed", "n_runs", "text")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    out = toxicity.score(docs, model, extra={"held_out": fold_of("doc_id", toxicity.FOLDS) == 0})
    return out.select("doc_id", "held_out", "score", "predicted")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_trie(trie.with_planted_heads(stash(trie.paths(table(spark, sf_dir, "conversations")), "turns")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.report(periodic.detect(periodic.with_planted_runs(table(spark, sf_dir, "documents"))))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_chat_format, op3_bpe_codec, op4_decontamination, op5_language_id, op6_quality_rules,
    op7_line_dedup, op8_jaccard_join, op9_toxicity, op10_pii, op11_simhash, op12_prefix_trie, op13_periodic_runs)}
