"""FLT10: what cannot be processed is set aside with a reason, the rest goes on.

Three levels, as errors spread: a bad segment costs its whole entry (the slicer's decisions
depend on all of them), a slice whose transcript cannot be built costs that slice (the
previous-text chain goes on without it), a label row that cannot be assembled or is too long
costs that row. Everything is judged by expressions before or after the slicer, so one bad
row never fails a task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from parlance.operators.filters import MAX_TARGET_POSITIONS
from parlance.operators.merging import rejected_slices

#: (level, entry_id, slice_idx, reason, n): n counts the bad rows behind the reason.
COLUMNS = ["level", "entry_id", "slice_idx", "reason", "n"]


def _unusable(c: Column) -> Column:
    d = c.cast("double")
    return d.isNull() | F.isnan(d)


def segment_reason(start: Column, end: Column, duration: Column) -> Column:
    """Why a segment cannot be sliced, null if it can."""
    return (F.when(_unusable(start), F.lit("segment without a start"))
             .when(_unusable(end), F.lit("segment without an end"))
             .when(_unusable(duration), F.lit("no audio duration")))


def _reason() -> Column:
    return segment_reason(F.col("start"), F.col("end"), F.col("audio_duration"))


def without_bad_entries(segments: DataFrame, key: str = "entry_id") -> DataFrame:
    """Segments of the entries that have no bad one. The window needs the rows of an entry together,
    like the slicer: after a partitioning by the entry it adds no shuffle."""
    bad = F.max(_reason().isNotNull()).over(Window.partitionBy(key))
    return segments.withColumn("_bad_entry", bad).where("NOT _bad_entry").drop("_bad_entry")


def entry_rejects(segments: DataFrame, key: str = "entry_id") -> DataFrame:
    """One row per entry with a bad segment: the reason of the first one in file order."""
    bad = segments.withColumn("reason", _reason()).where("reason IS NOT NULL")
    return (bad.groupBy(F.col(key).alias("entry_id"))
               .agg(F.min(F.struct("seg_idx", "reason")).alias("first"), F.count("*").alias("n"))
               .select(F.lit("entry").alias("level"), "entry_id", F.lit(None).cast("int").alias("slice_idx"),
                       F.col("first.reason").alias("reason"), "n"))


def unreadable(entries: DataFrame, readable: Column, reason: str, key: str = "entry_id") -> DataFrame:
    """One row per entry whose file could not be read."""
    return entries.where(~F.coalesce(readable, F.lit(False))).select(
        F.lit("entry").alias("level"), F.col(key).alias("entry_id"), F.lit(None).cast("int").alias("slice_idx"),
        F.lit(reason).alias("reason"), F.lit(1).cast("long").alias("n"))


def slice_rejects(slices: DataFrame, merge_threshold: float = 0.3) -> DataFrame:
    """One row per slice whose transcript could not be built."""
    return rejected_slices(slices, merge_threshold).select(
        F.lit("slice").alias("level"), "entry_id", F.col("slice_idx").cast("int").alias("slice_idx"),
        F.col("error").alias("reason"), F.lit(1).cast("long").alias("n"))


def label_reason(labels: Column, limit: int = MAX_TARGET_POSITIONS) -> Column:
    """Why a label row is not used, null if it is."""
    return (F.when(labels.isNull(), F.lit("labels could not be assembled"))
             .when(F.exists(labels, lambda x: x.isNull()), F.lit("label without an id"))
             .when(F.size(labels) > limit, F.lit("labels too long")))


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """The rows, and an observation of their number that the action which reads them fills."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen
