"""Gap-merge goldens (FIXTURES A2) through the native array expression, and the metadata
exclusion goldens (FIXTURES A3)."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.operators.filters import exclusion_predicate, parse_exclude_filter, python_str_value
from parlance.operators.merging import merge_gaps
from parlance.operators.slicing import SLICE_SEGMENT

O = None
# (name, threshold, segments [(start, end|O, text|O)], expected)
MERGE_CASES = [
    ("no_segments", 0.3, [], []),
    ("one_segment", 0.3, [(0, 5, "Hello")], [(0, 5, "Hello")]),
    ("gap_too_large", 0.3, [(0, 5, "Hello "), (5.5, 10, "world")], [(0, 5, "Hello "), (5.5, 10, "world")]),
    ("within_threshold", 0.3, [(0, 5, "Hello "), (5.2, 10, "world")], [(0, 10, "Hello world")]),
    ("chain", 0.3, [(0, 5, "Hello "), (5.1, 10, "world "), (10.2, 15, "today")], [(0, 15, "Hello world today")]),
    ("some_merge", 0.3, [(0, 5, "Hello "), (5.1, 10, "world "), (10.5, 15, "today")],
     [(0, 10, "Hello world "), (10.5, 15, "today")]),
    ("threshold_1", 1.0, [(0, 5, "Hello "), (5.5, 10, "world "), (15, 20, "today")],
     [(0, 10, "Hello world "), (15, 20, "today")]),
    ("open_segment", 0.3, [(0, 5, "Hello "), (5.1, O, O)], [(0, 5, "Hello "), (5.1, O, O)]),
    ("mixed", 0.3, [(0, 5, "First "), (5.2, 10, "second "), (10.5, 15, "third "), (15.1, 20, "fourth "),
                    (20.2, 26, "fifth "), (26.1, O, O)],
     [(0, 10, "First second "), (10.5, 26, "third fourth fifth "), (26.1, O, O)]),
]


@pytest.mark.parametrize("name,thr,segs,expected", MERGE_CASES, ids=[c[0] for c in MERGE_CASES])
def test_merge_golden(spark, name, thr, segs, expected):
    rows = [{"start": float(s), "end": None if e is None else float(e), "text": t,
             "word_scores": [float(i)] if t is not None else None} for i, (s, e, t) in enumerate(segs)]
    schema = T.StructType([T.StructField("segments", T.ArrayType(SLICE_SEGMENT))])
    df = spark.createDataFrame([(rows,)], schema)
    got = df.select(merge_gaps(F.col("segments"), thr).alias("m")).first()["m"]
    assert [(s["start"], s["end"], s["text"]) for s in got] == [
        (float(a), None if b is None else float(b), c) for a, b, c in expected]
    # merged segments keep the first segment's scores
    if name == "within_threshold":
        assert got[0]["word_scores"] == [0.0]


def test_merge_two_slices(spark):
    schema = T.StructType([T.StructField("seek", T.DoubleType()), T.StructField("segments", T.ArrayType(SLICE_SEGMENT))])
    s = lambda a, b, t: {"start": a, "end": b, "text": t, "word_scores": []}
    df = spark.createDataFrame([(0.0, [s(0.0, 5.0, "Hello "), s(5.1, 10.0, "world")]),
                                (30.0, [s(0.0, 5.0, "Another "), s(5.5, 10.0, "segment")])], schema)
    got = {r["seek"]: [(x["start"], x["end"], x["text"]) for x in r["m"]]
           for r in df.select("seek", merge_gaps(F.col("segments")).alias("m")).collect()}
    assert got[0.0] == [(0.0, 10.0, "Hello world")]
    assert got[30.0] == [(0.0, 5.0, "Another "), (5.5, 10.0, "segment")]


def test_parse_exclude_filter():
    assert parse_exclude_filter("source_id:eq:youtube") == ("source_id", "eq", "youtube")
    assert parse_exclude_filter("metadata.quality_score:eq:0.5") == ("metadata.quality_score", "eq", "0.5")
    assert parse_exclude_filter("a:eq:b:c") == ("a", "eq", "b:c")
    for bad in ["invalid_format", "field:invalid_op:value", "field:ne:value"]:
        with pytest.raises(ValueError):
            parse_exclude_filter(bad)


def test_nested_lookup_and_exclusion(spark):
    docs = [
        '{"source_id": "youtube", "quality_score": 0.8}',
        '{"metadata": {"source_id": "youtube", "nested": {"value": "test"}}}',
        '{"metadata": {"source": "x", "stats": {"views": 1000}}}',
        '{"flag": true, "s": "true", "f": 1.0, "e": 1e3, "n": null}',
    ]
    df = spark.createDataFrame([(d,) for d in docs], ["j"])
    j = F.col("j")
    r = df.select(*[python_str_value(j, p).alias(p) for p in
                    ["source_id", "quality_score", "metadata.source_id", "metadata.nested.value", "missing",
                     "metadata.missing", "flag", "s", "f", "e", "n", "source_id.x"]]).collect()
    assert (r[0]["source_id"], r[0]["quality_score"]) == ("youtube", "0.8")
    assert (r[1]["metadata.source_id"], r[1]["metadata.nested.value"]) == ("youtube", "test")
    assert r[0]["missing"] is None and r[1]["metadata.missing"] is None and r[0]["source_id.x"] is None
    assert (r[3]["flag"], r[3]["s"], r[3]["f"], r[3]["e"], r[3]["n"]) == ("True", "true", "1.0", "1000.0", None)

    def excl(specs):
        return [x[0] for x in df.select(exclusion_predicate(j, specs)).collect()]
    assert excl(["source_id:eq:youtube"]) == [True, False, False, False]
    assert excl(["source_id:eq:vimeo"]) == [False, False, False, False]
    assert excl(["source_id:eq:vimeo", "quality_score:eq:0.8"]) == [True, False, False, False]
    assert excl(["metadata.source:eq:x"]) == [False, False, True, False]
    assert excl(["metadata.stats.views:eq:1000"]) == [False, False, True, False]
    assert excl(["metadata.stats.views:eq:2000"]) == [False, False, False, False]
    assert excl(["flag:eq:True"]) == [False, False, False, True]
