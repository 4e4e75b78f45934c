"""Evaluation and preparation inputs derived from the test tables (FIXTURES.md part B).

Each builder reads whole tables and is written twice: as DataFrame code here and as a
SQL CTE in ``catalog.py`` for the DuckDB oracle. Texts are always used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.functions import text as TX
from parlance.operators.balance import spread_for_cpu
from parlance.sources.tables import table


def degrade_words(words: Column) -> Column:
    """Deterministic hypothesis from reference words (0-based index i): drop i%7=3;
    otherwise reverse the word when i%11=5 and say it twice when i%13=6."""
    def one(w, i):
        w2 = F.when(i % 11 == 5, F.reverse(w)).otherwise(w)
        return (F.when(i % 7 == 3, F.array().cast("array<string>"))
                 .when(i % 13 == 6, F.array(w2, w2))
                 .otherwise(F.array(w2)))
    return F.flatten(F.transform(words, one))


def doc_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 on whole documents: id, lang, source, reference_text, predicted_text."""
    d = spread_for_cpu(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "text"))
    return d.select(
        F.col("doc_id").alias("id"), "lang", "source",
        F.col("text").alias("reference_text"),
        F.array_join(degrade_words(TX.split_words(F.col("text"))), " ").alias("predicted_text"))


def conversation_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F2 on whole conversation turns: conv_id, turn, role, reference_text, predicted_text."""
    c = spread_for_cpu(table(spark, sf_dir, "conversations"))
    return c.select(
        "conv_id", "turn", "role", F.col("text").alias("reference_text"),
        F.array_join(degrade_words(TX.split_words(F.col("text"))), " ").alias("predicted_text"))


def latency_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F4 from events: event_type, audio_duration, transcription_time, predicted_text."""
    e = table(spark, sf_dir, "events")
    return e.select(
        "event_id", "event_type",
        F.col("value").alias("audio_duration"),
        ((F.col("event_id") % 97).cast("double") / 10).alias("transcription_time"),
        F.expr("repeat(event_type, cast(event_id % 4 as int))").alias("predicted_text"))


def segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 segments from conversations, one row per segment.

    entry_id = conv_id, seg_idx = turn, d = length(text) % 40,
    gap = ((length(text) * 7) % 8) * 0.25, start = running sum of (d + gap) over
    earlier turns, end = start + d, word_scores[k] = ((length(word_k)*37 + k*11) % 100)/100,
    audio_duration = max(end) + conv_id % 5 per entry.

    The running sums are per-entry windows; entries are short conversations here, and
    the slicer that consumes them is itself keyed by entry.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "text")
    L = F.length("text")
    d = (L % 40).cast("double")
    gap = ((L * 7) % 8).cast("double") * 0.25
    w = Window.partitionBy("entry_id").orderBy("seg_idx")
    words = TX.split_words(F.col("text"))
    seg = (c.select(
        F.col("conv_id").alias("entry_id"), F.col("turn").alias("seg_idx"), "text",
        d.alias("_d"), gap.alias("_gap"),
        F.transform(words, lambda x, k: ((F.length(x) * 37 + k * 11) % 100).cast("double") / 100)
         .alias("word_scores"))
        .withColumn("start", F.coalesce(
            F.sum(F.col("_d") + F.col("_gap")).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)))
        .withColumn("end", F.col("start") + F.col("_d"))
        .withColumn("audio_duration",
                    F.max("end").over(Window.partitionBy("entry_id")) + (F.col("entry_id") % 5).cast("double")))
    return seg.select("entry_id", "seg_idx", "start", "end", "text", "word_scores", "audio_duration")


def broken_segment_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F1 segments of which some lack their start: where (length(text) * 13 + turn) % 61 is 7."""
    seg = segment_rows(spark, sf_dir)
    return seg.withColumn("start", F.when((F.length("text") * 13 + F.col("seg_idx")) % 61 != 7, F.col("start")))


def fixed_hop_slices(spark: SparkSession, sf_dir: str, slice_length: float = 30, segments: DataFrame | None = None) -> DataFrame:
    """Prepared slices of F1 (or of ``segments``) with a fixed hop (no greedy packing), SQL-expressible.

    slice_idx = floor(start / L); a segment whose end passes the slice end is open;
    every slice index from 0 to ceil(duration / L) - 1 exists, empty ones included.
    Output: entry_id, slice_idx, seek, segments (ordered by seg_idx).
    """
    L = float(slice_length)
    seg = segment_rows(spark, sf_dir) if segments is None else segments
    seg = seg.withColumn("slice_idx", F.floor(F.col("start") / L).cast("bigint"))
    seek = F.col("slice_idx").cast("double") * L
    closed = (F.col("end") - seek) <= L
    item = F.struct(
        F.col("seg_idx"),
        (F.col("start") - seek).alias("start"),
        F.when(closed, F.col("end") - seek).alias("end"),
        F.when(closed, F.col("text")).alias("text"),
        F.when(closed, F.col("word_scores")).alias("word_scores"))
    groups = (seg.groupBy("entry_id", "slice_idx")
                 .agg(F.array_sort(F.collect_list(item)).alias("_items"))
                 .select("entry_id", "slice_idx",
                         F.transform("_items", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"),
                                                                  s["text"].alias("text"),
                                                                  s["word_scores"].alias("word_scores")))
                          .alias("segments")))
    n_slices = F.ceil(F.max("audio_duration") / L).cast("bigint")
    frame = (seg.groupBy("entry_id").agg(n_slices.alias("_n"))
                .filter(F.col("_n") > 0)
                .select("entry_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_n") - 1)).alias("slice_idx")))
    empty = F.array().cast(groups.schema["segments"].dataType)
    return (frame.join(groups, ["entry_id", "slice_idx"], "left")
                 .select("entry_id", F.col("slice_idx").cast("int").alias("slice_idx"),
                         (F.col("slice_idx").cast("double") * L).alias("seek"),
                         F.coalesce("segments", empty).alias("segments")))


def chunk_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 from conversations: stream_id = conv_id, seq = turn, ts = 2024-01-01 + conv_id
    minutes + turn seconds, is_partial = turn % 3 = 1, is_last on the highest turn."""
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    last = F.max("turn").over(Window.partitionBy("conv_id"))
    ts = (F.lit("2024-01-01 00:00:00").cast("timestamp")
          + F.make_dt_interval(mins=F.col("conv_id").cast("int"), secs=F.col("turn").cast("int")))
    return c.select(F.col("conv_id").alias("stream_id"), F.col("turn").alias("seq"), ts.alias("ts"), "role", "text",
                    (F.col("turn") % 3 == 1).alias("is_partial"), (F.col("turn") == last).alias("is_last"))
