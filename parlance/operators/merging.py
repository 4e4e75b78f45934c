"""Slice post-processing and example assembly, all as native Column expressions.

WIN2 gap merge, WIN6 transcript assembly, AGG4-AGG6 quality scores, WIN3 previous
transcript, WIN4/PRJ1/PRJ2 example records, FLT9 entries without any segment.

A slice row carries ``segments ARRAY<STRUCT<start, end, text, word_scores>>`` with an
open segment encoded as ``end IS NULL AND text IS NULL``. WIN2/WIN6/AGG6 work inside
one row (higher-order functions, no shuffle); WIN3 and FLT9 need the entry's slices
in order and share one exchange on ``entry_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parlance.functions import text as TX


def array_median(xs: Column) -> Column:
    """AGG4: median with the middle pair averaged ((a+b)/2); 0.0 when empty or null."""
    s = F.array_sort(F.coalesce(xs, F.array().cast("array<double>")))
    n = F.size(s)
    mid_hi = F.element_at(s, (F.floor(n / 2) + 1).cast("int"))
    mid_lo = F.element_at(s, F.greatest((n / 2).cast("int"), F.lit(1)))
    return (F.when(n == 0, F.lit(0.0))
             .when(n % 2 == 1, mid_hi)
             .otherwise((mid_lo + mid_hi) / 2))


def pooled_scores(segments: Column) -> Column:
    """AGG5: all word scores of the segments, open segments contributing none."""
    return F.flatten(F.transform(segments, lambda s: F.coalesce(s["word_scores"], F.array().cast("array<double>"))))


def quality_score(segments: Column) -> Column:
    """AGG6: pooled median of the (post-merge) segments' word scores."""
    return array_median(pooled_scores(segments))


def merge_gaps(segments: Column, threshold: float = 0.3) -> Column:
    """WIN2: merge a closed segment into its predecessor when
    ``start[k] - end[k-1] < threshold`` (gaps-and-islands inside the array).

    The merged segment keeps the first start, the last end, the plain concatenation
    of texts and the first segment's word scores. Open segments never merge.
    """
    n = F.size(segments)
    thr = F.lit(float(threshold))

    def starts_island(k):
        cur = F.element_at(segments, k)
        prev = F.element_at(segments, F.greatest(k - 1, F.lit(1)))
        mergeable = ((k > 1) & cur["end"].isNotNull() & cur["text"].isNotNull()
                     & ((cur["start"] - prev["end"]) < thr))
        return ~F.coalesce(mergeable, F.lit(False))

    heads = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda k: (n > 0) & starts_island(k))

    def island(p, j):
        q = F.coalesce(F.try_element_at(heads, (j + 2).cast("int")) - 1, n)
        first = F.element_at(segments, p)
        last = F.element_at(segments, q)
        part = F.slice(segments, p, q - p + 1)
        text = F.when(q == p, first["text"]).otherwise(F.array_join(F.transform(part, lambda s: s["text"]), ""))
        return F.struct(first["start"].alias("start"), last["end"].alias("end"), text.alias("text"),
                        first["word_scores"].alias("word_scores"))

    return F.when(n <= 1, segments).otherwise(F.transform(heads, island))


def transcript(segments: Column) -> Column:
    """WIN6: ``<|start|>text<|end|>`` per segment, open segments contribute only their
    start marker. Null when a marker is outside [0, 30] (the error case)."""
    parts = F.transform(segments, lambda s: F.when(
        s["text"].isNull(), TX.timestamp_token(s["start"])).otherwise(
        F.concat(TX.timestamp_token(s["start"]), s["text"], TX.timestamp_token(s["end"]))))
    ok = F.forall(parts, lambda x: x.isNotNull())
    return F.when(ok, F.array_join(parts, ""))


def build_examples(slices: DataFrame, slice_length: float = 30, merge_threshold: float = 0.3,
                   source_col: Column | None = None, entry_col: Column | None = None,
                   copy_fields: dict[str, Column] | None = None) -> DataFrame:
    """WIN2 -> WIN6 -> AGG6 -> WIN3 -> PRJ1 over the slicer's output.

    Output: entry_id, slice_idx, transcript, has_prev, has_timestamps, prev_transcript,
    metadata STRUCT<seek, duration, source, entry_id, quality_score, copied...>, plus
    ``error`` for slices whose transcript could not be built (kept out of the chain).
    """
    merged = slices.withColumn("segments", merge_gaps(F.col("segments"), merge_threshold))
    x = (merged
         .withColumn("_nseg", F.size("segments"))
         .withColumn("transcript", transcript(F.col("segments")))
         .withColumn("quality_score", quality_score(F.col("segments"))))
    by_entry = Window.partitionBy("entry_id")
    # FLT9: an entry whose slices are all empty yields nothing
    x = x.withColumn("_entry_has_seg", F.max("_nseg").over(by_entry) > 0).filter("_entry_has_seg")
    x = x.withColumn("error", F.when((F.col("_nseg") > 0) & F.col("transcript").isNull(),
                                     F.lit("timestamp token out of range")))
    # WIN3: failed slices leave the chain untouched; empty slices reset it
    chain = x.filter(F.col("error").isNull())
    w = by_entry.orderBy("slice_idx")
    chain = (chain
             .withColumn("_prev_n", F.lag("_nseg").over(w))
             .withColumn("_prev_t", F.lag("transcript").over(w))
             .withColumn("has_prev", F.coalesce(F.col("_prev_n") > 0, F.lit(False)))
             .withColumn("prev_transcript", F.when(F.col("has_prev"), F.col("_prev_t")).otherwise(F.lit(""))))
    good = chain.filter(F.col("_nseg") > 0)
    src = source_col if source_col is not None else F.lit("unknown")
    eid = entry_col if entry_col is not None else F.col("entry_id").cast("string")
    meta = [F.col("seek").cast("float").alias("seek"), F.lit(float(slice_length)).cast("float").alias("duration"),
            src.alias("source"), eid.alias("entry_id"), F.col("quality_score").cast("float").alias("quality_score")]
    for name, c in (copy_fields or {}).items():
        meta.append(c.cast("string").alias(name))
    return good.select(
        "entry_id", "slice_idx", "transcript", "has_prev", F.lit(True).alias("has_timestamps"),
        "prev_transcript", F.struct(*meta).alias("metadata"))


def rejected_slices(slices: DataFrame, merge_threshold: float = 0.3) -> DataFrame:
    """FLT10: slices whose example could not be built, with the reason."""
    x = slices.withColumn("segments", merge_gaps(F.col("segments"), merge_threshold))
    return (x.filter((F.size("segments") > 0) & transcript(F.col("segments")).isNull())
             .select("entry_id", "slice_idx", "seek", F.lit("timestamp token out of range").alias("error")))


def sample_range(samples: Column, seek: Column, slice_length: float, rate: int = 16000) -> Column:
    """WIN7: samples of one slice, ``[int(seek*rate), int(seek*rate) + int(L*rate))``."""
    first = F.floor(seek * F.lit(rate)).cast("int")
    return F.slice(samples, first + 1, F.lit(int(slice_length * rate)))
