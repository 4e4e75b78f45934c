"""Stream-shaped queries (batch execution of the streaming operators) and the scorer."""

from __future__ import annotations

from pyspark.sql import functions as F

from parlance.operators.transcribe import example_scorer_factory, transcribe
from parlance.plans import fixtures as FX
from parlance.plans.catalog import register, sql_words
from parlance.sources.tables import table
from parlance.streaming import operators as ST

_F6 = """f6 AS (
  SELECT conv_id AS stream_id, turn AS seq,
         TIMESTAMP '2024-01-01 00:00:00' + to_minutes(CAST(conv_id AS INTEGER)) + to_seconds(CAST(turn AS INTEGER)) AS ts,
         role, text, turn % 3 = 1 AS is_partial,
         turn = max(turn) OVER (PARTITION BY conv_id) AS is_last
  FROM conversations)"""


# STR3 / FLT8: final results only
@register("final_results_stream", f"""
WITH {_F6}
SELECT stream_id, seq, md5(text) AS text_md5 FROM f6 WHERE NOT coalesce(is_partial, false)
""")
def final_results_stream(spark, sf_dir):
    s = ST.keep_final(FX.chunk_stream(spark, sf_dir))
    return s.select("stream_id", "seq", F.md5("text").alias("text_md5"))


# STR1 (batch meaning) + TXT8: chunk texts joined in order per finished stream
@register("assembled_sessions", f"""
WITH {_F6}
SELECT stream_id, CAST(count(*) AS BIGINT) AS n_chunks,
       md5(string_agg(coalesce(text, ''), ' ' ORDER BY seq)) AS text_md5
FROM f6 GROUP BY stream_id HAVING bool_or(is_last)
""")
def assembled_sessions(spark, sf_dir):
    s = ST.assemble_sessions_batch(FX.chunk_stream(spark, sf_dir))
    return s.select("stream_id", "n_chunks", F.md5("text").alias("text_md5"))


# STR2: 15-second tumbling chunks of the events stream
@register("stream_chunks_events", """
SELECT CAST(epoch_us(time_bucket(INTERVAL 15 SECOND, ts)) AS BIGINT) AS chunk_start_us,
       CAST(count(*) AS BIGINT) AS n, round(sum(value), 6) AS value_sum
FROM events GROUP BY 1
""")
def stream_chunks_events(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    c = ST.fixed_chunks(e, "ts", 15.0)
    return c.select(F.unix_micros(F.col("chunk.start")).alias("chunk_start_us"), F.col("n").cast("bigint").alias("n"),
                    F.round("value_sum", 6).alias("value_sum"))


# STR5: gap merge of per-user events, each lasting `value` seconds, threshold 60 s
@register("gap_sessions_events", """
WITH e AS (SELECT user_id, ts, value, ts + to_microseconds(CAST(value * 1000000 AS BIGINT)) AS e_end FROM events),
r AS (SELECT *, max(e_end + INTERVAL 60 SECOND) OVER (PARTITION BY user_id ORDER BY ts, e_end
                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM e),
f AS (SELECT *, CASE WHEN reach IS NULL OR ts >= reach THEN 1 ELSE 0 END AS brk FROM r),
g AS (SELECT *, sum(brk) OVER (PARTITION BY user_id ORDER BY ts, e_end ROWS UNBOUNDED PRECEDING) AS sid FROM f)
SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS first_start_us, CAST(count(*) AS BIGINT) AS n_items,
       CAST(epoch_us(max(e_end)) AS BIGINT) AS last_end_us
FROM g GROUP BY user_id, sid
""")
def gap_sessions_events(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("user_id", "ts", "value")
    s = ST.gap_sessions(e, "user_id", "ts", "value", 60.0)
    return s.select("user_id", F.unix_micros("first_start").alias("first_start_us"),
                    F.col("n_items").cast("bigint").alias("n_items"), F.unix_micros("last_end").alias("last_end_us"))


# UDF1: pluggable scorer called once per partition (factory) and per row
@register("scorer_predictions", f"""
WITH w AS (SELECT conv_id, turn, text, {sql_words('text')} AS ws FROM conversations)
SELECT conv_id, turn,
  md5(array_to_string(list_filter(list_transform(ws, lambda x, i: CASE WHEN (i - 1) % 3 = 0 THEN reverse(x) ELSE x END),
                                  lambda x, i: (i - 1) % 5 != 2), ' ')) AS predicted_md5,
  round(0.001::DOUBLE * length(text), 6) AS transcription_time
FROM w
""")
def scorer_predictions(spark, sf_dir):
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    p = transcribe(c, lambda **kw: example_scorer_factory(**kw), input_cols=["text"])
    return p.select("conv_id", "turn", F.md5("predicted_text").alias("predicted_md5"),
                    F.round("transcription_time", 6).alias("transcription_time"))


# JOIN2 + PRJ8 + SRT1: references paired with separately produced predictions by id
@register("paired_by_id", f"""
WITH refs AS (SELECT conv_id, turn, text FROM conversations),
ids AS (SELECT conv_id, turn, row_number() OVER (ORDER BY conv_id, turn) - 1 AS id FROM conversations),
preds AS (SELECT conv_id, turn, array_to_string(list_filter(list_transform({sql_words('text')},
            lambda x, i: CASE WHEN (i - 1) % 3 = 0 THEN reverse(x) ELSE x END), lambda x, i: (i - 1) % 5 != 2), ' ') AS p
          FROM conversations)
SELECT CAST(ids.id AS BIGINT) AS id, md5(refs.text) AS ref_md5, md5(preds.p) AS pred_md5
FROM refs JOIN preds USING (conv_id, turn) JOIN ids USING (conv_id, turn)
""")
def paired_by_id(spark, sf_dir):
    from parlance.operators.shaping import ordered_by_id, pair_by_id, with_row_id
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    refs = with_row_id(c, ["conv_id", "turn"])
    preds = transcribe(c.select("conv_id", "turn", "text"), lambda **kw: example_scorer_factory(**kw),
                       input_cols=["text"]).select("conv_id", "turn", "predicted_text")
    p = pair_by_id(refs, preds, ["conv_id", "turn"])
    return ordered_by_id(p.select(F.col("id").cast("bigint").alias("id"), F.md5("text").alias("ref_md5"),
                                  F.md5("predicted_text").alias("pred_md5")))
