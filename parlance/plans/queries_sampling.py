"""Sampling, splits, specs and dataset-combination queries."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from parlance.functions import text as TX
from parlance.functions.random import sql_uniform
from parlance.operators import sampling as SM
from parlance.plans.catalog import register, sql_hebrew_norm, sql_words
from parlance.session import scratch_path
from parlance.sources import specs as SP
from parlance.sources.tables import table

LANGS = ["de", "en", "es", "fr"]  # the given tables' language datasets, in source-index order (oracles only)
PROBS = [0.4, 0.3, 0.2, 0.1]


# ---- LIM1/LIM3: seeded shuffle then first n ----------------------------------------------
@register("shuffled_head_documents", f"""
SELECT doc_id, lang FROM documents ORDER BY {sql_uniform(745, 'doc_id')}, doc_id LIMIT 100
""")
def shuffled_head_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SM.shuffled_head(d, "doc_id", 100, seed=745)


# ---- SRC4 + LIM2: dataset spec with absolute slicing --------------------------------------
@register("spec_slice_documents", """
SELECT doc_id, lang FROM documents WHERE lang = 'en' ORDER BY doc_id LIMIT 250 OFFSET 100
""")
def spec_slice_documents(spark, sf_dir):
    resolve = lambda name: table(spark, sf_dir, name).select("doc_id", "lang")
    return SP.load_spec(spark, resolve, "documents:en[100:350]", key="doc_id", split_col="lang")


# ---- LIM4: exact train/eval split ------------------------------------------------------------
@register("train_eval_split_documents", f"""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY {sql_uniform(745, 'doc_id')}, doc_id) - 1 AS p,
                  count(*) OVER () AS n FROM documents)
SELECT doc_id, CASE WHEN p < ceil(0.1::DOUBLE * n) THEN 'eval' ELSE 'train' END AS split FROM r
""")
def train_eval_split_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id")
    return SM.train_eval_split(d, "doc_id", 0.1, seed=745)


# ---- LIM5 + LIM6: attribute draws and Beta(2,3) shift -----------------------------------------
_BETA_SQL = "list_sort([" + ", ".join(sql_uniform(998, "doc_id", f"'shift{i}'") for i in range(4)) + "])[2]"


@register("attribute_draws_documents", f"""
SELECT doc_id,
  {sql_uniform(998, 'doc_id', "'has_timestamps'")} < 0.5::DOUBLE AS use_timestamps,
  {sql_uniform(998, 'doc_id', "'has_prev'")} < 0.5::DOUBLE AS use_prev,
  round(CASE WHEN 29.6::DOUBLE - CAST(n_chars AS DOUBLE) / 1000 > 0
        THEN round_even({_BETA_SQL} * (29.6::DOUBLE - CAST(n_chars AS DOUBLE) / 1000) * 100, 0) / 100
        ELSE 0.0 END, 6) AS shift
FROM documents
""")
def attribute_draws_documents(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    key = F.col("doc_id")
    draws = SM.attribute_draws(key, {"has_timestamps": 0.5, "has_prev": 0.5})
    dur = F.col("n_chars").cast("double") / 1000
    return d.select("doc_id", draws["has_timestamps"].alias("use_timestamps"), draws["has_prev"].alias("use_prev"),
                    F.round(SM.shift_seconds(dur, key), 6).alias("shift"))


# ---- AGG7 + AGG8 + WIN5: adaptive attribute ratios on labels ---------------------------------
# The stop row depends on Beta interval widths, which SQL engines here lack; tests check
# the interval against closed forms and the scan against a sequential replay.
@register("adaptive_ratios_labels")
def adaptive_ratios_labels(spark, sf_dir):
    lab = table(spark, sf_dir, "labels")
    est = SM.estimate_ratios(lab, "doc_id", {"quality": F.col("quality") == 1, "toxic": F.col("toxic") == 1})
    return est.withColumn("sampling_ratio", F.round(SM.relative_ratio(0.5, F.col("estimated_ratio")), 6))


# ---- SET1: concatenation -------------------------------------------------------------------------
@register("concat_documents_benchmark", """
SELECT doc_id AS id, 'documents' AS origin, CAST(length(text) AS BIGINT) AS n_chars FROM documents
UNION ALL
SELECT item_id AS id, 'benchmark' AS origin, CAST(length(text) AS BIGINT) AS n_chars FROM benchmark
""")
def concat_documents_benchmark(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit("documents").alias("origin"),
                                                 F.length("text").cast("bigint").alias("n_chars"))
    b = table(spark, sf_dir, "benchmark").select(F.col("item_id").alias("id"), F.lit("benchmark").alias("origin"),
                                                 F.length("text").cast("bigint").alias("n_chars"))
    return SM.concatenate([d, b])


# ---- SET2: interleave four language datasets until all are exhausted --------------------------
def _interleave_sql(probs: list[float] | None) -> str:
    src_case = "CASE lang " + " ".join(f"WHEN '{l}' THEN {i}" for i, l in enumerate(LANGS)) + " END"
    if probs is None:
        k = len(LANGS)
        steps = f"(SELECT max((len - 1) * {k} + src + 1) FROM sz)"
        pick = f"step % {k}"
    else:
        tot = sum(probs)
        ps = [p / tot for p in probs]
        p_case = "CASE src " + " ".join(f"WHEN {i} THEN {p!r}::DOUBLE" for i, p in enumerate(ps)) + " END"
        steps = f"(SELECT CAST(ceil(2 * max(len / {p_case})) AS BIGINT) + 100 FROM sz)"
        cum, acc = [], 0.0
        for p in ps[:-1]:
            acc += p
            cum.append(acc)
        u = sql_uniform(745, "step", "'interleave'")
        pick = "CASE " + " ".join(f"WHEN {u} < {c!r}::DOUBLE THEN {i}" for i, c in enumerate(cum)) + f" ELSE {len(ps) - 1} END"
    return f"""
WITH d AS (SELECT doc_id, lang, {src_case} AS src FROM documents WHERE lang IN ({', '.join(repr(l) for l in LANGS)})),
sz AS (SELECT src, count(*) AS len FROM d GROUP BY src),
steps AS (SELECT range AS step FROM range(0, {steps})),
sch AS (SELECT step, {pick} AS src FROM steps),
sch2 AS (SELECT s.step, s.src, row_number() OVER (PARTITION BY s.src ORDER BY s.step) - 1 AS draw, z.len
         FROM sch s JOIN sz z USING (src)),
stop AS (SELECT max(f) AS stop FROM (SELECT src, min(step) AS f FROM sch2 WHERE draw = len - 1 GROUP BY src)),
rw AS (SELECT doc_id, lang, src, row_number() OVER (PARTITION BY src ORDER BY doc_id) - 1 AS r FROM d)
SELECT s.step, rw.lang AS source, rw.doc_id
FROM sch2 s JOIN rw ON rw.src = s.src AND rw.r = s.draw % s.len
WHERE s.step <= (SELECT stop FROM stop)
"""


def _interleave(spark, sf_dir, weigh=None):
    """One dataset per language of the table, in name order, then the rows without a language."""
    d = table(spark, sf_dir, "documents").select("doc_id", "lang")
    return SM.interleave_groups(d, "lang", "doc_id", weigh, seed=745).select("step", "source", "doc_id")


def falling_weights(k: int) -> list[float]:
    """k, k - 1, ..., 1 over their sum: ``PROBS`` for the four languages of the given tables."""
    return [(k - i) / (k * (k + 1) // 2) for i in range(k)]


@register("interleave_round_robin", _interleave_sql(None))
def interleave_round_robin(spark, sf_dir):
    return _interleave(spark, sf_dir)


@register("interleave_weighted", _interleave_sql(PROBS))
def interleave_weighted(spark, sf_dir):
    return _interleave(spark, sf_dir, falling_weights)


# ---- SRC6 + SET3: sweep over evaluation specs, failing ones skipped ---------------------------
SWEEP_SPECS = ["conversations:user:text", "conversations:assistant:text", "conversations:system:text",
               "no_such_table:test:text", "conversations:user:no_such_column"]


@register("eval_sweep_conversations", f"""
SELECT 'conversations:' || role AS dataset, count(*) AS n_rows,
       CAST(sum(len({sql_words(sql_hebrew_norm('text'))})) AS BIGINT) AS n_words
FROM conversations WHERE role IN ('user', 'assistant', 'system') GROUP BY role
""")
def eval_sweep_conversations(spark, sf_dir):
    def run_one(es):
        t = table(spark, sf_dir, es.name).filter(F.col("role") == es.split)
        words = F.size(TX.split_words(TX.hebrew_normalize(F.col(es.text_column))))
        return t.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(words).cast("bigint").alias("n_words"))
    out = SP.sweep(SWEEP_SPECS, run_one)
    return out.filter(F.col("n_rows") > 0).select("dataset", "n_rows", "n_words")


STATUS_SPECS = ["events:click:value", "events:view:event_id", "events:click:props", "no_such_table:all:value",
                "events:view:no_such_column"]


@register("sweep_status", """
SELECT 'events:click:value' AS spec, 'finished' AS status, count(*) AS n_numbers, false AS has_reason,
       round(sum(value), 4) AS total FROM events WHERE event_type = 'click'
UNION ALL SELECT 'events:view:event_id', 'finished', count(*), false, round(CAST(sum(event_id) AS DOUBLE), 4) FROM events WHERE event_type = 'view'
UNION ALL SELECT x, 'failed', NULL, true, NULL
FROM (VALUES ('events:click:props'), ('no_such_table:all:value'), ('events:view:no_such_column')) v(x)
""")
def sweep_status(spark, sf_dir):
    """SET3: the sum of a numeric column over each set. One set names a column that holds no numbers
    and fails while it runs, two fail before; the others finish."""
    def run_one(es):
        t = table(spark, sf_dir, es.name).filter(F.col("event_type") == es.split)
        x = F.col(es.text_column).cast("string")
        number = F.when(x.rlike(r"^-?[0-9.]+(E-?[0-9]+)?$"), x.cast("double")).otherwise(
            F.raise_error(F.lit("not a number")).cast("double"))
        return t.agg(F.count(F.lit(1)).alias("n_numbers"), F.round(F.sum(number), 4).alias("total")).withColumn("spec", F.lit(":".join(
            (es.name, es.split, es.text_column))))
    out = SP.run_sweep(spark, STATUS_SPECS, run_one, scratch_path(spark, "sweep"))
    return out.status.join(out.results.drop("dataset"), "spec", "left").select(
        "spec", "status", "n_numbers", F.col("reason").isNotNull().alias("has_reason"), "total")
