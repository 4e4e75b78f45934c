"""File sources: recursive manifest scan (SRC1 + JOIN1), metadata JSON (SRC2), caption
JSON (SRC3) and plain text pairs (SRC7)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

WORD = T.StructType([
    T.StructField("word", T.StringType()), T.StructField("start", T.DoubleType()),
    T.StructField("end", T.DoubleType()), T.StructField("probability", T.DoubleType())])
SEGMENT = T.StructType([
    T.StructField("start", T.DoubleType()), T.StructField("end", T.DoubleType()),
    T.StructField("text", T.StringType()), T.StructField("words", T.ArrayType(WORD))])
CAPTIONS = T.ArrayType(SEGMENT)


def _paths(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """Files under ``root`` (recursively) whose name matches ``glob``; only path and
    length are read (the binary content column is pruned)."""
    df = (spark.read.format("binaryFile")
          .option("recursiveFileLookup", "true")
          .option("pathGlobFilter", glob)
          .load(root))
    return df.select(F.col("path"), F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("entry_dir"))


def manifest(spark: SparkSession, root: str, audio_glob: str, segments_glob: str, metadata_glob: str) -> DataFrame:
    """SRC1 + JOIN1: one row per folder holding exactly one segments, one audio and one
    metadata file: ``(entry_dir, audio_path, segments_path, metadata_path)``.

    Any folder with a segments file but not exactly one of each is an error for the
    whole run, as in the reference.
    """
    seg = _paths(spark, root, segments_glob.split("/")[-1])
    aud = _paths(spark, root, audio_glob.split("/")[-1])
    meta = _paths(spark, root, metadata_glob.split("/")[-1])
    counts = (seg.groupBy("entry_dir").agg(F.count(F.lit(1)).alias("n_seg"))
                 .join(aud.groupBy("entry_dir").agg(F.count(F.lit(1)).alias("n_aud")), "entry_dir", "left")
                 .join(meta.groupBy("entry_dir").agg(F.count(F.lit(1)).alias("n_meta")), "entry_dir", "left"))
    bad = counts.filter((F.col("n_seg") != 1) | (F.coalesce("n_aud", F.lit(0)) != 1)
                        | (F.coalesce("n_meta", F.lit(0)) != 1))
    first_bad = bad.select("entry_dir").limit(1).collect()
    if first_bad:
        raise ValueError(f"Expected exactly one audio, segments and metadata file in {first_bad[0][0]}")
    return (seg.withColumnRenamed("path", "segments_path")
               .join(aud.withColumnRenamed("path", "audio_path"), "entry_dir")
               .join(meta.withColumnRenamed("path", "metadata_path"), "entry_dir")
               .select("entry_dir", "audio_path", "segments_path", "metadata_path"))


def read_whole_files(spark: SparkSession, root: str, glob: str, out_col: str, path_col: str) -> DataFrame:
    """Whole-file text of every file under ``root`` matching ``glob``: ``(path_col, out_col)``.

    Read by glob (no path list through the driver); join to a manifest on the path.
    """
    df = (spark.read.format("text").option("wholetext", "true")
          .option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(root))
    # input_file_name() is URL-encoded (a plus sign is not), the binaryFile path is not
    name = F.url_decode(F.replace(F.input_file_name(), F.lit("+"), F.lit("%2B")))
    return df.select(name.alias(path_col), F.col("value").alias(out_col))


def _same_path(a, b):
    return F.regexp_replace(a, "^file:(//)?", "") == F.regexp_replace(b, "^file:(//)?", "")


def read_metadata(spark: SparkSession, man: DataFrame, root: str, glob: str) -> DataFrame:
    """SRC2: the metadata JSON text of each manifest entry (kept as a JSON string and read
    with ``get_json_object`` / the predicates of ``operators.filters``)."""
    texts = read_whole_files(spark, root, glob.split("/")[-1], "metadata_json", "_mp")
    return man.join(texts, _same_path(man["metadata_path"], texts["_mp"]), "left").drop("_mp")


def read_captions(spark: SparkSession, man: DataFrame, root: str, glob: str) -> DataFrame:
    """The captions JSON text of each manifest entry (input of SRC3)."""
    texts = read_whole_files(spark, root, glob.split("/")[-1], "segments_json", "_sp")
    return man.join(texts, _same_path(man["segments_path"], texts["_sp"]), "left").drop("_sp")


def readable_captions(json_col: Column) -> Column:
    """Whether a captions text is a JSON array of segments."""
    return F.coalesce(F.from_json(json_col, CAPTIONS, {"mode": "PERMISSIVE"}).isNotNull() & json_col.rlike(r"^\s*\["), F.lit(False))


def read_segments(spark: SparkSession, entries: DataFrame, json_col: str = "segments_json") -> DataFrame:
    """SRC3: captions JSON array -> one row per segment in file order, with word scores.

    A segment given only by words takes start = first word start, end = last word end
    and text = the words concatenated.
    """
    parsed = entries.withColumn("_segs", F.from_json(F.col(json_col), CAPTIONS))
    seg = parsed.select("*", F.posexplode("_segs").alias("seg_idx", "_s")).drop("_segs", json_col)
    words = F.col("_s.words")
    has_words = F.coalesce(F.size(words), F.lit(0)) > 0
    return (seg.withColumn("start", F.coalesce(F.col("_s.start"), F.when(has_words, F.element_at(words, 1)["start"])))
               .withColumn("end", F.coalesce(F.col("_s.end"), F.when(has_words, F.element_at(words, -1)["end"])))
               .withColumn("text", F.coalesce(F.col("_s.text"),
                                              F.array_join(F.transform(words, lambda w: w["word"]), "")))
               .withColumn("word_scores", F.when(has_words, F.transform(F.filter(words, lambda w: w["probability"].isNotNull()),
                                                                        lambda w: w["probability"]))
                           .otherwise(F.array().cast("array<double>")))
               .drop("_s"))


def read_text_pair(spark: SparkSession, reference_path: str, test_path: str) -> DataFrame:
    """SRC7: two plain text files as one ``(reference_text, predicted_text)`` row."""
    ref, test = os.path.abspath(reference_path), os.path.abspath(test_path)
    both = (spark.read.option("wholetext", "true").text([ref, test])
                 .select(F.regexp_replace(F.input_file_name(), "^file:(//)?", "").alias("p"), "value"))
    return both.agg(F.max(F.when(F.col("p") == ref, F.col("value"))).alias("reference_text"),
                    F.max(F.when(F.col("p") == test, F.col("value"))).alias("predicted_text"))
