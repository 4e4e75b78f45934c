"""Transcript scoring: per-pair alignment, corpus metrics and latency statistics.

TXT10 per pair, AGG1 corpus WER/WIL (micro-average of counts), AGG11 orthographic and
normalised WER side by side, AGG2/AGG3 latency families, FLT5-FLT7, MTH2, PRJ3, PRJ4.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parlance.functions import align as A
from parlance.functions import text as TX
from parlance.operators.ranks import order_stats

COUNT_COLS = ["substitutions", "deletions", "insertions", "hits"]


def score_pairs(df: DataFrame, ref_col: str = "reference_text", hyp_col: str = "predicted_text",
                normalizer: Callable[[Column], Column] = TX.hebrew_normalize) -> DataFrame:
    """Add normalised texts, per-row counts, WER and WIL (TXT5 -> TXT10).

    The normaliser is pluggable (UDF2): any Column -> Column function.
    """
    out = (df.withColumn("norm_reference_text", normalizer(F.coalesce(F.col(ref_col), F.lit(""))))
             .withColumn("norm_predicted_text", normalizer(F.coalesce(F.col(hyp_col), F.lit(""))))
             .withColumn("_al", A.align(F.col("norm_reference_text"), F.col("norm_predicted_text"))))
    s, d, i, h = (F.col(f"_al.{c}") for c in COUNT_COLS)
    return (out.select("*", *[F.col(f"_al.{c}").alias(c) for c in COUNT_COLS])
               .drop("_al")
               .withColumn("wer", A.wer(s=F.col("substitutions"), d=F.col("deletions"),
                                         i=F.col("insertions"), h=F.col("hits")))
               .withColumn("wil", A.wil(s=F.col("substitutions"), d=F.col("deletions"),
                                         i=F.col("insertions"), h=F.col("hits"))))


def corpus_metrics(scored: DataFrame, group_cols: list[str]) -> DataFrame:
    """AGG1: sum S, D, I, H per group, then WER and WIL from the sums (micro-average).

    Partial aggregation runs map-side, so a hot group costs one small partial row
    per task.
    """
    agg = scored.groupBy(*group_cols).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in COUNT_COLS],
        F.count(F.lit(1)).alias("n_pairs"))
    s, d, i, h = (F.col(c) for c in COUNT_COLS)
    return (agg.withColumn("wer", F.round(A.wer(s, d, i, h), 6))
               .withColumn("wil", F.round(A.wil(s, d, i, h), 6)))


def orthographic_and_normalized_wer(pairs: DataFrame, group_cols: list[str], ref_col: str, hyp_col: str,
                                    normalizer: Callable[[Column], Column] = TX.basic_normalize) -> DataFrame:
    """AGG11: WER on raw text and on normalised text with empty references dropped (FLT5).

    One pass and one aggregate: both alignments are columns of a row, and an empty normalised
    reference leaves its row out of the second sums only. A null group is a group; one whose
    normalised references are all empty has a null ``wer_norm``."""
    r, h = normalizer(F.col(ref_col)), normalizer(F.col(hyp_col))
    normed = pairs.select(*group_cols, F.col(ref_col).alias("_r0"), F.col(hyp_col).alias("_h0"), r.alias("_r"), h.alias("_h"))
    both = normed.select(*group_cols, A.align(F.col("_r0"), F.col("_h0")).alias("_o"),
                         (F.length(F.trim(F.col("_r"))) > 0).alias("_said"), A.align(F.col("_r"), F.col("_h")).alias("_n"))
    sums = both.groupBy(*group_cols).agg(
        *[F.sum(f"_o.{c}").alias(f"o_{c}") for c in COUNT_COLS],
        *[F.sum(F.when(F.col("_said"), F.col(f"_n.{c}"))).alias(f"n_{c}") for c in COUNT_COLS])

    def w(p):
        return F.round(A.wer(F.col(f"{p}_substitutions"), F.col(f"{p}_deletions"),
                             F.col(f"{p}_insertions"), F.col(f"{p}_hits")), 6)
    return sums.select(*group_cols, w("o").alias("wer_ortho"), w("n").alias("wer_norm"))


def guarded_ratio(num: Column, den: Column) -> Column:
    """MTH2: num / den when den > 0, else 0."""
    return F.when(den > 0, num.cast("double") / den).otherwise(F.lit(0.0))


LATENCY_METRICS = ["raw_time", "time_per_second", "time_per_char"]


def latency_stats(df: DataFrame, group_cols: list[str], duration_col: str = "audio_duration",
                  time_col: str = "transcription_time", text_col: str = "predicted_text",
                  min_duration: float = 5.0) -> DataFrame:
    """AGG3 (with FLT6 and AGG2): three latency families per group.

    Recordings shorter than ``min_duration`` are ignored; each family keeps values > 0;
    an empty family reports zeros. Output: group_cols, metric, n, mean, median, p90, p99.
    """
    f = df.filter(F.col(duration_col) >= F.lit(min_duration))
    t = F.col(time_col).cast("double")
    fam = F.array(
        F.struct(F.lit("raw_time").alias("metric"), t.alias("x")),
        F.struct(F.lit("time_per_second").alias("metric"), guarded_ratio(t, F.col(duration_col)).alias("x")),
        F.struct(F.lit("time_per_char").alias("metric"), guarded_ratio(t, TX.char_length(F.col(text_col))).alias("x")),
    )
    long = (f.select(*group_cols, F.explode(fam).alias("_m"))
             .select(*group_cols, "_m.metric", "_m.x")
             .filter(F.col("x") > 0))
    stats = order_stats(long, group_cols + ["metric"], "x")
    frame = (df.select(*group_cols).distinct()
               .withColumn("metric", F.explode(F.array(*[F.lit(m) for m in LATENCY_METRICS]))))
    out = frame.join(stats, on=group_cols + ["metric"], how="left")
    return out.select(
        *group_cols, "metric",
        F.coalesce(F.col("n"), F.lit(0)).cast("bigint").alias("n"),
        *[F.round(F.coalesce(F.col(c), F.lit(0.0)), 6).alias(c) for c in ["mean", "median", "p90", "p99"]])


def short_input_gate(df: DataFrame, duration_col: str = "audio_duration", min_seconds: float = 0.5) -> tuple[DataFrame, DataFrame]:
    """FLT7: inputs shorter than ``min_seconds`` get ("", 0.0) without scoring.

    Returns (to_score, short_results): only the first goes to a scorer.
    """
    short = F.col(duration_col) < F.lit(min_seconds)
    to_score = df.filter(~short | F.col(duration_col).isNull())
    skipped = (df.filter(short)
                 .withColumn("predicted_text", F.lit(""))
                 .withColumn("transcription_time", F.lit(0.0)))
    return to_score, skipped


def metadata_passthrough(df: DataFrame, text_col: str, exclude: tuple[str, ...] = ("audio",)) -> list[Column]:
    """PRJ3: every other input column under a ``metadata_`` prefix."""
    return [F.col(c).alias(f"metadata_{c}") for c in df.columns if c not in (*exclude, text_col)]


def provenance(model: str, dataset: str, split: str, engine: str) -> list[Column]:
    """PRJ4: constant provenance columns."""
    return [F.lit(model).alias("model"), F.lit(dataset).alias("dataset"),
            F.lit(split).alias("split"), F.lit(engine).alias("engine")]
