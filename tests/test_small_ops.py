"""Small operators: error split (FLT10), leading-space rule (TXT12), prepared-set reader
with fallback (SRC5), time tokens and their error case (TXT7)."""

import tempfile

from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions import text as TX
from parlance.operators.merging import rejected_slices
from parlance.operators.rejects import slice_rejects
from parlance.operators.slicing import SLICE_SEGMENT
from parlance.sources.specs import read_prepared


def test_time_tokens_and_errors(spark):
    df = spark.createDataFrame([(0.0,), (1.01,), (1.03,), (29.99,), (30.0,), (30.01,), (-0.5,)], ["s"])
    got = [r[0] for r in df.select(TX.timestamp_token(F.col("s"))).collect()]
    # rounding to 0.02 is half-even on the quotient, as Python's round
    assert got == ["<|0.00|>", "<|1.00|>", "<|1.04|>", "<|30.00|>", "<|30.00|>", None, None]


def test_transcript_error_rows_are_split_out(spark):
    schema = T.StructType([T.StructField("entry_id", T.LongType()), T.StructField("slice_idx", T.IntegerType()),
                           T.StructField("seek", T.DoubleType()), T.StructField("segments", T.ArrayType(SLICE_SEGMENT))])
    seg = lambda a, b, t: {"start": a, "end": b, "text": t, "word_scores": []}
    df = spark.createDataFrame([(1, 0, 0.0, [seg(0.0, 5.0, "ok")]), (1, 1, 40.0, [seg(0.0, 45.0, "too long")])], schema)
    rej = rejected_slices(df).collect()
    assert [(r["entry_id"], r["slice_idx"]) for r in rej] == [(1, 1)]
    assert [tuple(r) for r in slice_rejects(df).collect()] == [("slice", 1, 1, "timestamp token out of range", 1)]


def test_prefix_space_rule(spark):
    df = spark.createDataFrame([("hi", True), ("hi", False), ("hi", None)], "t string, ts boolean")
    assert [r[0] for r in df.select(TX.with_prefix_space(F.col("t"), F.col("ts"))).collect()] == ["hi", " hi", " hi"]


def test_read_prepared_with_fallback(spark):
    d = tempfile.mkdtemp(prefix="parlance-prepared-")
    spark.range(5).withColumn("split", F.lit("train")).write.mode("overwrite").partitionBy("split").parquet(d + "/a")
    assert read_prepared(spark, d + "/a").count() == 5
    fb = read_prepared(spark, d + "/missing", fallback=lambda: spark.range(2))
    assert fb.count() == 2
