"""Evaluation-side queries: normalisation, alignment, corpus metrics, latency."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.functions import text as TX
from parlance.operators import scoring as SC
from parlance.operators.balance import spread_for_cpu
from parlance.operators.transcribe import example_scorer_factory
from parlance.plans import fixtures as FX
from parlance.plans.catalog import register, sql_degrade, sql_hebrew_norm, sql_words, SQL_BASIC_NORM
from parlance.sources.tables import table


# ---- TXT10 + AGG1: corpus WER/WIL per language over whole documents -------------------
# No SQL oracle: an exact word alignment over texts of up to 20k words is far beyond
# DuckDB list lambdas; tests/test_align.py checks it against a brute-force DP.
@register("corpus_wer_by_lang")
def corpus_wer_by_lang(spark, sf_dir):
    scored = SC.score_pairs(FX.doc_pairs(spark, sf_dir))
    return SC.corpus_metrics(scored, ["lang"])


_B = 1 << 32
_CANON_SQL = ("regexp_replace(replace(regexp_replace({t}, '[!\"#$%&''()*+,./:;<=>?@\\[\\\\\\]^_`{{|}}~]', '', 'g'), "
              "'-', ' '), '\\s+', ' ', 'g')")
# Word-level DP in list lambdas (cost * B - hits, minimised), feasible for whole
# conversation turns (a few hundred words); far too slow for whole documents.
_ROLE_WER_SQL = f"""
WITH p AS (SELECT role, text AS ref, {sql_degrade(sql_words('text'))} AS hyp FROM conversations),
w AS (SELECT role, {sql_words(_CANON_SQL.format(t='ref'))} AS r, {sql_words(_CANON_SQL.format(t='hyp'))} AS h FROM p),
z AS (SELECT role, len(r) AS n, len(h) AS m,
  CASE WHEN len(r) = 0 OR len(h) = 0 THEN NULL ELSE
  list_reduce(list_transform(range(1, len(r) + 1), lambda i: [i::BIGINT]),
    lambda row, iw: list_reduce(
      list_transform(range(1, len(h) + 1), lambda j: [least(row[j + 1] + {_B}, row[j] + CASE WHEN r[iw[1]] = h[j] THEN -1 ELSE {_B} END)]),
      lambda acc, x: list_append(acc, least(x[1], acc[len(acc)] + {_B})),
      [row[1] + {_B}]),
    list_transform(range(0, len(h) + 1), lambda j: j::BIGINT * {_B})) END AS zz
  FROM w),
c AS (SELECT role, n, m,
        CASE WHEN zz IS NULL THEN greatest(n, m) ELSE CAST(ceil(zz[len(zz)] / {float(_B)!r}) AS BIGINT) END AS cost,
        CASE WHEN zz IS NULL THEN 0 ELSE CAST(ceil(zz[len(zz)] / {float(_B)!r}) AS BIGINT) * {_B} - zz[len(zz)] END AS hits
      FROM z),
t AS (SELECT role, CAST(sum(n + m - 2 * hits - cost) AS BIGINT) AS substitutions,
             CAST(sum(cost + hits - m) AS BIGINT) AS deletions, CAST(sum(cost + hits - n) AS BIGINT) AS insertions,
             CAST(sum(hits) AS BIGINT) AS hits, count(*) AS n_pairs FROM c GROUP BY role)
SELECT *, round(CASE WHEN hits + substitutions + deletions > 0
                     THEN (substitutions + deletions + insertions) / (hits + substitutions + deletions) END, 6) AS wer,
          round(CASE WHEN hits + substitutions + deletions = 0 THEN NULL WHEN hits + substitutions + insertions = 0 THEN 1.0
                     ELSE 1 - (hits / (hits + substitutions + deletions)) * (hits / (hits + substitutions + insertions)) END, 6) AS wil
FROM t
"""


@register("corpus_wer_by_role", _ROLE_WER_SQL)
def corpus_wer_by_role(spark, sf_dir):
    """Conversation turns as utterances, canonicalised as in the text-compare tool (TXT6)."""
    scored = SC.score_pairs(FX.conversation_pairs(spark, sf_dir), normalizer=TX.canonicalize)
    return SC.corpus_metrics(scored, ["role"])


# AGG11 + FLT5 on conversation turns: short enough for the alignment in SQL
def _sql_counts(cte: str, ref: str, hyp: str) -> str:
    """Per row of ``cte``: n and m (words), cost and hits of the best alignment."""
    return f"""
SELECT role, n, m, CASE WHEN zz IS NULL THEN greatest(n, m) ELSE CAST(ceil(zz[len(zz)] / {float(_B)!r}) AS BIGINT) END AS cost,
       CASE WHEN zz IS NULL THEN 0 ELSE CAST(ceil(zz[len(zz)] / {float(_B)!r}) AS BIGINT) * {_B} - zz[len(zz)] END AS hits
FROM (SELECT role, len(r) AS n, len(h) AS m, CASE WHEN len(r) = 0 OR len(h) = 0 THEN NULL ELSE
  list_reduce(list_transform(range(1, len(r) + 1), lambda i: [i::BIGINT]),
    lambda row, iw: list_reduce(
      list_transform(range(1, len(h) + 1), lambda j: [least(row[j + 1] + {_B}, row[j] + CASE WHEN r[iw[1]] = h[j] THEN -1 ELSE {_B} END)]),
      lambda acc, x: list_append(acc, least(x[1], acc[len(acc)] + {_B})),
      [row[1] + {_B}]),
    list_transform(range(0, len(h) + 1), lambda j: j::BIGINT * {_B})) END AS zz
  FROM (SELECT role, {sql_words(ref)} AS r, {sql_words(hyp)} AS h FROM {cte}))"""


_SQL_WER = "CASE WHEN sum(n) > 0 THEN sum(cost) / sum(n) END"


@register("wer_ortho_vs_norm_by_role", f"""
WITH p AS (SELECT role, text AS ref, {sql_degrade(sql_words('text'))} AS hyp FROM conversations),
q AS (SELECT role, {SQL_BASIC_NORM.format(t='ref')} AS ref, {SQL_BASIC_NORM.format(t='hyp')} AS hyp FROM p),
s AS (SELECT * FROM q WHERE length(trim(ref)) > 0),
o AS (SELECT role, {_SQL_WER} AS w FROM ({_sql_counts('p', 'ref', 'hyp')}) GROUP BY role),
z AS (SELECT role, {_SQL_WER} AS w FROM ({_sql_counts('s', 'ref', 'hyp')}) GROUP BY role)
SELECT o.role, round(o.w, 6) AS wer_ortho, round(z.w, 6) AS wer_norm FROM o LEFT JOIN z ON z.role = o.role
""")
def wer_ortho_vs_norm_by_role(spark, sf_dir):
    """AGG11 + FLT5 per speaker role."""
    return SC.orthographic_and_normalized_wer(FX.conversation_pairs(spark, sf_dir), ["role"],
                                              "reference_text", "predicted_text")


@register("wer_ortho_vs_norm_by_source")
def wer_ortho_vs_norm_by_source(spark, sf_dir):
    """AGG11 + FLT5 per document source."""
    return SC.orthographic_and_normalized_wer(FX.doc_pairs(spark, sf_dir), ["source"],
                                              "reference_text", "predicted_text")


# ---- TXT1-TXT5: normaliser, per document ----------------------------------------------
@register("normalized_text_digest", f"""
SELECT doc_id, md5(n) AS norm_md5, CAST(length(n) AS BIGINT) AS norm_chars,
       CAST(len({sql_words('n')}) AS BIGINT) AS norm_words
FROM (SELECT doc_id, {sql_hebrew_norm('text')} AS n FROM documents)
""")
def normalized_text_digest(spark, sf_dir):
    d = spread_for_cpu(table(spark, sf_dir, "documents")).select("doc_id", TX.hebrew_normalize(F.col("text")).alias("n"))
    return d.select("doc_id", F.md5("n").alias("norm_md5"), F.length("n").cast("bigint").alias("norm_chars"),
                    F.size(TX.split_words(F.col("n"))).cast("bigint").alias("norm_words"))


# ---- TXT6: canonicalisation, per conversation turn --------------------------------------
@register("canonical_text_digest", """
SELECT conv_id, turn, md5(c) AS canon_md5, CAST(length(c) AS BIGINT) AS canon_chars
FROM (SELECT conv_id, turn,
        regexp_replace(replace(regexp_replace(text, '[!"#$%&''()*+,./:;<=>?@\\[\\\\\\]^_`{|}~]', '', 'g'), '-', ' '),
                       '\\s+', ' ', 'g') AS c
      FROM conversations)
""")
def canonical_text_digest(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", TX.canonicalize(F.col("text")).alias("c"))
    return c.select("conv_id", "turn", F.md5("c").alias("canon_md5"), F.length("c").cast("bigint").alias("canon_chars"))


# ---- F2 hypothesis construction (whole texts) -------------------------------------------
@register("hypothesis_digest", f"""
SELECT doc_id, md5({sql_degrade('w')}) AS hyp_md5
FROM (SELECT doc_id, {sql_words('text')} AS w FROM documents)
""")
def hypothesis_digest(spark, sf_dir):
    p = FX.doc_pairs(spark, sf_dir)
    return p.select(F.col("id").alias("doc_id"), F.md5("predicted_text").alias("hyp_md5"))


# ---- AGG2/AGG3 + FLT6 + TXT9 + MTH2: latency families -----------------------------------
_LAT_SQL = """
WITH base AS (
  SELECT event_type, value AS audio_duration, CAST(event_id % 97 AS DOUBLE) / 10 AS t,
         repeat(event_type, CAST(event_id % 4 AS INTEGER)) AS predicted_text
  FROM events),
f AS (SELECT * FROM base WHERE audio_duration >= 5.0),
s AS (
  SELECT event_type, 'raw_time' AS metric, t AS x FROM f
  UNION ALL SELECT event_type, 'time_per_second', CASE WHEN audio_duration > 0 THEN t / audio_duration ELSE 0 END FROM f
  UNION ALL SELECT event_type, 'time_per_char',
         CASE WHEN coalesce(length(predicted_text), 0) > 0 THEN t / length(predicted_text) ELSE 0 END FROM f),
p AS (SELECT event_type, metric, x,
             row_number() OVER (PARTITION BY event_type, metric ORDER BY x) AS rk,
             count(*) OVER (PARTITION BY event_type, metric) AS n
      FROM s WHERE x > 0),
st AS (
  SELECT event_type, metric, max(n) AS n, avg(x) AS mean,
    (max(CASE WHEN rk = CASE WHEN n % 2 = 1 THEN n // 2 + 1 ELSE n // 2 END THEN x END)
     + max(CASE WHEN rk = n // 2 + 1 THEN x END)) / 2 AS median,
    max(CASE WHEN rk = CAST(floor(0.9::DOUBLE * n) AS BIGINT) + 1 THEN x END) AS p90,
    max(CASE WHEN rk = CAST(floor(0.99::DOUBLE * n) AS BIGINT) + 1 THEN x END) AS p99
  FROM p GROUP BY event_type, metric),
fr AS (SELECT g.event_type, m.metric FROM (SELECT DISTINCT event_type FROM events) g,
       (VALUES ('raw_time'), ('time_per_second'), ('time_per_char')) m(metric))
SELECT fr.event_type, fr.metric, CAST(coalesce(st.n, 0) AS BIGINT) AS n,
       round(coalesce(st.mean, 0), 6) AS mean, round(coalesce(st.median, 0), 6) AS median,
       round(coalesce(st.p90, 0), 6) AS p90, round(coalesce(st.p99, 0), 6) AS p99
FROM fr LEFT JOIN st USING (event_type, metric)
"""


@register("latency_by_event_type", _LAT_SQL)
def latency_by_event_type(spark, sf_dir):
    return SC.latency_stats(FX.latency_rows(spark, sf_dir), ["event_type"])


# ---- SNK5 + JOIN5 + FLT7 + UDF1: an evaluation that an earlier run has begun --------------------
@register("resumed_evaluation_conversations", f"""
SELECT conv_id || '-' || turn AS id, CAST(CASE WHEN conv_id % 3 = 0 THEN 0 ELSE 1 END AS BIGINT) AS batch,
  md5(CASE WHEN length(text) / 50.0::DOUBLE < 0.5 THEN '' ELSE array_to_string(list_filter(list_transform({sql_words('text')},
        lambda x, i: CASE WHEN (i - 1) % 3 = 0 THEN reverse(x) ELSE x END), lambda x, i: (i - 1) % 5 != 2), ' ') END) AS predicted_md5,
  round(CASE WHEN length(text) / 50.0::DOUBLE < 0.5 THEN 0.0::DOUBLE ELSE 0.001::DOUBLE * length(text) END, 6) AS transcription_time,
  role AS metadata_role, 'example' AS engine
FROM conversations
""")
def resumed_evaluation_conversations(spark, sf_dir):
    """Every turn is scored once: those of an interrupted run (batch 0) are not scored again."""
    from parlance.plans.flows import evaluate_to
    from parlance.session import scratch_path
    turns = table(spark, sf_dir, "conversations").select(
        F.concat_ws("-", "conv_id", "turn").alias("id"), "conv_id", "text", "role",
        (F.length("text") / 50.0).alias("audio_duration"))
    path = scratch_path(spark, "evaluation")

    def run(part):
        return evaluate_to(spark, path, part.drop("conv_id"), "text", lambda **kw: example_scorer_factory(**kw),
                           model="m", dataset="conversations", engine="example")
    run(turns.where("conv_id % 3 = 0"))
    return run(turns).select("id", "batch", F.md5("predicted_text").alias("predicted_md5"),
                             F.round("transcription_time", 6).alias("transcription_time"), "metadata_role", "engine")
