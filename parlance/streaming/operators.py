"""Structured Streaming forms of the stream-shaped operators (STR1-STR6).

Every function takes a DataFrame that may be streaming or static, so the same plan is
checked in batch against SQL and run incrementally with ``readStream``.

Late data: rows older than the watermark are dropped by Spark; each operator states
its watermark column. ``events.ts`` arrives as TIMESTAMP_NTZ and is cast to TIMESTAMP
by the table reader (session time zone UTC).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from parlance.operators import scoring as SC
from parlance.operators.filters import final_results


def fixed_chunks(df: DataFrame, ts_col: str, seconds: float = 15.0, watermark: str | None = None) -> DataFrame:
    """STR2: tumbling windows of ``seconds`` (the streaming engine's fixed chunking);
    per window: count and summed value."""
    src = df.withWatermark(ts_col, watermark) if watermark else df
    w = F.window(F.col(ts_col), f"{seconds} seconds")
    return src.groupBy(w.alias("chunk")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("value_sum"))


def keep_final(df: DataFrame, partial_col: str = "is_partial") -> DataFrame:
    """STR3: stateless filter dropping partial results as they arrive."""
    return final_results(df, partial_col)


def gap_sessions(df: DataFrame, key_col: str, ts_col: str, duration_col: str, threshold_s: float,
                 watermark: str | None = None) -> DataFrame:
    """STR5: gap merge over a time-ordered stream with session windows.

    Each item covers ``[ts, ts + duration)``; an item joins the open session when it
    starts less than ``threshold`` after the session's furthest end, expressed as a
    dynamic session gap of ``duration + threshold - 1 microsecond`` (session windows
    merge at exactly one gap). Per session: first start, furthest end, item count.
    """
    gap_us = (F.col(duration_col) * 1_000_000).cast("long") + int(threshold_s * 1_000_000) - 1
    gap = F.concat(gap_us.cast("string"), F.lit(" microseconds"))
    src = df.withWatermark(ts_col, watermark) if watermark else df
    s = src.groupBy(F.col(key_col), F.session_window(F.col(ts_col), gap).alias("session"))
    return s.agg(F.min(ts_col).alias("first_start"), F.count(F.lit(1)).alias("n_items"),
                 F.max(F.col(ts_col) + F.make_dt_interval(secs=F.col(duration_col))).alias("last_end"))


def running_metrics(scored: DataFrame, group_cols: list[str]) -> DataFrame:
    """STR6: running corpus counts and WER/WIL per group (update output mode)."""
    return SC.corpus_metrics(scored, group_cols)


# ---- STR1: per-key ordered chunk accumulation ---------------------------------------------

SESSION_OUT = T.StructType([
    T.StructField("stream_id", T.LongType()),
    T.StructField("n_chunks", T.LongType()),
    T.StructField("text", T.StringType()),
])
SESSION_STATE = T.StructType([
    T.StructField("seqs", T.ArrayType(T.LongType())),
    T.StructField("texts", T.ArrayType(T.StringType())),
    T.StructField("last_ts", T.TimestampType()),
    T.StructField("last_seq", T.LongType()),
    T.StructField("finished", T.BooleanType()),
])
_IDLE_MS = 60_000


def _emit(key, chunks: dict[int, str]) -> pd.DataFrame:
    return pd.DataFrame({"stream_id": [key[0]], "n_chunks": [len(chunks)],
                         "text": [" ".join(chunks[i] for i in sorted(chunks))]})


def _session_fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Keep chunks by their number; emit the full text once the last chunk and every earlier sequence
    number have arrived (chunks may arrive out of order), or on event-time timeout. A finished
    stream leaves a mark until its timeout, so chunks that are sent again are not a new stream."""
    if state.hasTimedOut:
        seqs, texts, _, _, finished = state.get
        state.remove()
        if not finished:
            yield _emit(key, dict(zip(seqs, texts, strict=True)))
        return
    chunks, last_ts, last_seq, finished = {}, None, -1, False
    if state.exists:
        seqs, texts, last_ts, last_seq, finished = state.get
        chunks = dict(zip(seqs, texts, strict=True))
    for pdf in pdfs:
        if not finished:
            for i, t in zip(pdf["seq"], pdf["text"], strict=True):
                t = "" if t is None else str(t)
                chunks[int(i)] = min(chunks.get(int(i), t), t)
            ends = pdf.loc[pdf["is_last"].fillna(False).astype(bool), "seq"]
            if len(ends):
                last_seq = max(last_seq, int(ends.max()))
        m = pd.to_datetime(pdf["ts"]).max()
        last_ts = m if last_ts is None else max(pd.Timestamp(last_ts), m)
    if not finished and last_seq >= 0 and len(chunks) == last_seq + 1:
        yield _emit(key, chunks)
        chunks, finished = {}, True
    state.update((list(chunks), list(chunks.values()), pd.Timestamp(last_ts).to_pydatetime(), last_seq, finished))
    # expire one minute of event time after the newest chunk (needs a watermark)
    state.setTimeoutTimestamp(int(pd.Timestamp(last_ts).timestamp() * 1000) + _IDLE_MS)


def assemble_sessions(df: DataFrame, watermark: str = "1 minute") -> DataFrame:
    """STR1: ``(stream_id, seq, ts, text, is_last)`` chunks -> one row per finished stream
    with the chunk texts joined by a space in ``seq`` order. A chunk that is sent again counts once; of
    different texts of one number the smallest stays. State lives per stream until the event-time
    watermark passes one minute after its newest chunk (an unfinished stream's partial text is emitted
    then); once a stream is finished it holds no text. Chunks older than the watermark are
    dropped by Spark."""
    src = df.withWatermark("ts", watermark) if df.isStreaming else df
    return (src.select("stream_id", "seq", "ts", "text", "is_last")
               .groupBy("stream_id")
               .applyInPandasWithState(_session_fn, SESSION_OUT, SESSION_STATE, "append",
                                       GroupStateTimeout.EventTimeTimeout))


def assemble_sessions_batch(df: DataFrame) -> DataFrame:
    """The batch meaning of STR1, as plain DataFrame code (used as its check): finished streams only."""
    chunks = df.groupBy("stream_id", "seq").agg(F.min(F.coalesce("text", F.lit(""))).alias("text"),
                                                F.max(F.coalesce("is_last", F.lit(False))).alias("_last"))
    g = chunks.groupBy("stream_id").agg(F.array_sort(F.collect_list(F.struct("seq", "text"))).alias("_c"), F.max("_last").alias("_end"))
    return g.filter("_end").select(
        "stream_id", F.size("_c").cast("long").alias("n_chunks"),
        F.array_join(F.col("_c.text"), " ").alias("text"))
