"""The three end-to-end flows, composed from the operators.

build_dataset   manifest -> exclusion / quality gates -> captions -> slicer -> gap merge
                -> transcripts -> previous text -> examples [-> train/eval split]
evaluate        dataset -> skip finished -> short-input gate -> scorer -> normalise ->
                align -> rows with provenance; summarize -> corpus WER/WIL + latency
prepare_labels  examples -> adaptive ratios (bounded scan) -> label assembly -> limit
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parlance.functions import text as TX
from parlance.functions.random import uniform
from parlance.operators import filters as FL
from parlance.operators import labels as LB
from parlance.operators import merging as MG
from parlance.operators import rejects as RJ
from parlance.operators import sampling as SM
from parlance.operators import scoring as SC
from parlance.operators.slicing import generate_slices
from parlance.operators.transcribe import transcribe
from parlance.session import delete_path
from parlance.sources import files as FS
from parlance.sources.sinks import latest, pending, write_batch


class Build(NamedTuple):
    """Examples of a build and what it could not use: rows of ``operators.rejects.COLUMNS``."""

    examples: DataFrame
    rejects: DataFrame


def build_dataset(spark: SparkSession, root: str, *args, **options) -> DataFrame:
    """The examples of ``build_with_rejects``."""
    return build_with_rejects(spark, root, *args, **options).examples


def build_with_rejects(spark: SparkSession, root: str, audio_glob: str = "audio.*", segments_glob: str = "transcript.*.json",
                       metadata_glob: str = "metadata.json", slice_length: float = 30, quality_threshold: float = 0.0,
                       per_segment_quality_threshold: float = 0.0, exclude_filters: list[str] | None = None,
                       copy_metadata_fields: list[str] | None = None, max_source_entries: int | None = None,
                       seed: int = 745, eval_fraction: float = 0.0) -> Build:
    """Pipeline 3.1. Entries are gated on metadata before any caption is parsed.

    An entry is a folder: two folders that name the same source ids are never mixed. ``entry_id``
    of the examples is the one that the metadata gives, ``entry_dir`` the folder. Entries with
    unreadable metadata or captions or a bad segment, and slices without a transcript, are in
    ``rejects`` (by folder); excluded and gated entries are not, as nothing was wrong with them.

    Audio is not decoded here: the entry duration comes from the metadata field
    ``duration`` when present, else from the last caption end.
    """
    man = FS.manifest(spark, root, audio_glob, segments_glob, metadata_glob)
    meta = FS.read_metadata(spark, man, root, metadata_glob)
    parsed = F.try_parse_json("metadata_json").isNotNull()
    rejects = RJ.unreadable(meta, parsed, "metadata is not JSON", "entry_dir")
    meta = FL.exclude_by_metadata(meta.where(F.coalesce(parsed, F.lit(False))), "metadata_json", exclude_filters or [])
    score = F.get_json_object("metadata_json", "$.quality_score").cast("double")
    meta = FL.quality_gate(meta, score, quality_threshold)
    meta = (meta.withColumn("source", F.coalesce(F.get_json_object("metadata_json", "$.source_id"), F.lit("unknown")))
                .withColumn("named_id", F.coalesce(F.get_json_object("metadata_json", "$.source_entry_id"),
                                                   F.sha2(F.col("entry_dir"), 256))))
    if max_source_entries:
        meta = SM.shuffled_head(meta, "entry_dir", max_source_entries, seed)
    caps = FS.read_captions(spark, meta, root, segments_glob)
    readable = FS.readable_captions(F.col("segments_json"))
    rejects = rejects.unionByName(RJ.unreadable(caps, readable, "captions are not JSON", "entry_dir"))
    segs = FS.read_segments(spark, caps.where(readable)).withColumn("entry_id", F.col("entry_dir"))
    dur = F.coalesce(F.get_json_object("metadata_json", "$.duration").cast("double"),
                     F.max("end").over(Window.partitionBy("entry_id")))
    segs = segs.withColumn("audio_duration", dur).select("entry_id", "seg_idx", "start", "end", "text", "word_scores", "audio_duration")
    slices = generate_slices(segs, slice_length=slice_length, threshold=per_segment_quality_threshold)
    rejects = rejects.unionByName(RJ.entry_rejects(segs)).unionByName(RJ.slice_rejects(slices))
    # the join and the example windows share one partitioning on entry_id
    info = meta.select(F.col("entry_dir").alias("entry_id"), "named_id", "source", "metadata_json")
    copied = {f: FL.json_field(F.col("metadata_json"), f) for f in (copy_metadata_fields or [])}
    ex = MG.build_examples(slices.join(info, "entry_id"), slice_length=slice_length,
                           source_col=F.col("source"), entry_col=F.col("named_id"), copy_fields=copied)
    if eval_fraction:
        ex = SM.train_eval_split(ex.withColumn("_k", F.concat_ws(":", "entry_id", "slice_idx")), "_k",
                                 eval_fraction, seed).drop("_k")
    ex = ex.withColumnRenamed("entry_id", "entry_dir").withColumn("entry_id", F.col("metadata.entry_id"))
    return Build(ex.select("entry_id", *[c for c in ex.columns if c != "entry_id"]), rejects)


def evaluate(df: DataFrame, text_col: str, scorer_factory: Callable, factory_kwargs: dict | None = None,
             model: str = "", dataset: str = "", split: str = "test", engine: str = "",
             id_col: str = "id", duration_col: str = "audio_duration", done: DataFrame | None = None,
             normalizer: Callable[[Column], Column] = TX.hebrew_normalize, num_tasks: int | None = None) -> DataFrame:
    """Pipeline 3.2: one row per input with counts, WER, WIL, latency inputs, the other
    input columns under ``metadata_`` and constant provenance columns."""
    todo = pending(df, done, [id_col])
    to_score, short = SC.short_input_gate(todo, duration_col)
    predicted = transcribe(to_score, scorer_factory, factory_kwargs, num_tasks=num_tasks).unionByName(short)
    meta_cols = SC.metadata_passthrough(df, text_col, exclude=("audio", id_col, duration_col))
    scored = SC.score_pairs(predicted.withColumn("reference_text", F.col(text_col)), "reference_text",
                            "predicted_text", normalizer)
    return scored.select(
        F.col(id_col).alias("id"), "reference_text", "predicted_text", "norm_reference_text",
        "norm_predicted_text", "wer", "wil", *SC.COUNT_COLS, F.col(duration_col).alias("audio_duration"),
        "transcription_time", *meta_cols, *SC.provenance(model, dataset, split, engine))


def evaluate_to(spark: SparkSession, path: str, df: DataFrame, text_col: str, scorer_factory: Callable,
                factory_kwargs: dict | None = None, blocks: int = 1, overwrite: bool = False,
                id_col: str = "id", **options) -> DataFrame:
    """Pipeline 3.2 with its results kept (SNK5, JOIN5): ``evaluate`` the rows whose id is not yet in
    the results at ``path``, write them and return all results, read back. The scorer runs once per
    row, whatever is read from the results afterwards.

    The rows are taken in ``blocks`` by the hash of their id, each written as a batch of its own: after
    an interruption only the blocks that were not written are scored again. ``overwrite`` starts anew.
    Options are those of ``evaluate``. Ids are to be unique and not null.
    """
    if overwrite:
        delete_path(spark, path)
    done = latest(spark, path, ["id"])
    first = 0 if done is None else done.agg(F.max("batch")).first()[0] + 1
    if done is not None:
        done = done.select(F.col("id").alias(id_col))
    for k in range(blocks):
        part = df if blocks == 1 else df.where(F.pmod(F.xxhash64(id_col), F.lit(blocks)) == k)
        rows = evaluate(part, text_col, scorer_factory, factory_kwargs, id_col=id_col, done=done, **options)
        write_batch(rows, path, first + k)
    return latest(spark, path, ["id"])


def summarize(rows: DataFrame, group_cols: list[str] = ("model", "dataset")) -> tuple[DataFrame, DataFrame]:
    """Corpus WER/WIL (AGG1) and the three latency families (AGG3) per group."""
    g = list(group_cols)
    return SC.corpus_metrics(rows, g), SC.latency_stats(rows, g)


def prepare_labels(examples: DataFrame, key_cols: list[str], timestamp_prob: float = 0.5,
                   prev_prob: float = 0.5, seed: int = 998, shared_ratio: bool = True,
                   inject_synthetic: bool = False, duration_col: str | None = None,
                   shift_augmentation: bool = False, rejects: bool = False) -> DataFrame:
    """Pipeline 3.3 on the text side (audio features are out of scope).

    When either probability is below 1, the exact attribute shares of all rows are turned
    into relative sampling ratios (AGG8); the timestamp probability drives both ratios unless ``shared_ratio`` is
    False. Output: keys + ``labels``, legal rows only (FLT4); with ``rejects`` the keys of the
    others and their reason (FLT10).
    """
    ex = examples.withColumn("_key", F.concat_ws(":", *key_cols))
    both = F.array_join(F.array_compact(F.array("transcript", "prev_transcript")), " ") if "prev_transcript" in ex.columns else F.col("transcript")
    vocab = LB.build_vocabulary(ex.select(both.alias("words_of")), "words_of")
    if "prev_transcript" in ex.columns:
        t = LB.tokenize_columns(ex, ["_key"], {"ids": "transcript", "prev_ids": "prev_transcript"}, vocab)
    else:
        t = LB.tokenize(ex, ["_key"], "transcript", vocab, "ids").withColumn("prev_ids", F.array().cast("array<int>"))
    has_ts = F.coalesce(F.col("has_timestamps"), F.lit(False)) if "has_timestamps" in ex.columns else F.lit(False)
    has_prev = F.coalesce(F.col("has_prev"), F.lit(False)) if "has_prev" in ex.columns else F.lit(False)
    t = t.withColumn("_has_ts", has_ts).withColumn("_has_prev", has_prev)
    p_ts, p_prev = F.lit(float(timestamp_prob)), F.lit(float(prev_prob))
    if timestamp_prob < 1.0 or prev_prob < 1.0:
        # exact shares over all rows: one map-side aggregate, two scalars
        shares = {"has_removable_timestamps": F.col("_has_ts") & LB.strippable(F.col("ids")), "has_prev": F.col("_has_prev")}
        ratios = t.agg(*[F.avg(c.cast("double")).alias(k) for k, c in shares.items()]).first().asDict()
        def rel(prob, r):
            return min(1.0, prob / r) if r and r > 0 else 1.0
        p_ts = F.lit(rel(timestamp_prob, ratios.get("has_removable_timestamps")))
        p_prev = F.lit(rel(timestamp_prob if shared_ratio else prev_prob, ratios.get("has_prev")))
    train_ts = uniform(seed, F.col("_key"), F.lit("train_ts")) < p_ts
    cond_prev = uniform(seed, F.col("_key"), F.lit("cond_prev")) < p_prev
    shift = SM.shift_seconds(F.col(duration_col), F.col("_key"), seed) if (shift_augmentation and duration_col) else F.lit(0.0)
    labels = LB.assemble_labels(F.col("ids"), F.col("prev_ids"), F.col("_has_ts"), F.col("_has_prev"),
                                train_ts, cond_prev, inject_synthetic, shift,
                                F.col(duration_col) if duration_col else F.lit(0.0))
    out = t.withColumn("labels", labels).withColumn("reason", RJ.label_reason(F.col("labels")))
    if rejects:
        return out.where("reason IS NOT NULL").select(*key_cols, "reason")
    return out.where("reason IS NULL").select(*key_cols, "labels")
