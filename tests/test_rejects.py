"""FLT10: bad entries, slices and label rows are set aside and nothing else is lost."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from parlance.operators import rejects as RJ
from parlance.operators.slicing import generate_slices
from parlance.plans import fixtures as FX
from parlance.plans.flows import build_with_rejects, prepare_labels

SF = "/root/testdata/sf0.001"


def test_one_null_start_costs_its_entry_only(spark):
    seg = FX.segment_rows(spark, SF)
    want = [tuple(r) for r in generate_slices(seg.where("entry_id <> 3"), 30, 0.5).select("entry_id", "slice_idx", "seek").collect()]
    hurt = seg.withColumn("start", F.when((F.col("entry_id") != 3) | (F.col("seg_idx") != 1), F.col("start")))
    got = [tuple(r) for r in generate_slices(hurt, 30, 0.5).select("entry_id", "slice_idx", "seek").collect()]
    assert sorted(got) == sorted(want)
    assert [tuple(r) for r in RJ.entry_rejects(hurt).collect()] == [("entry", 3, None, "segment without a start", 1)]


def test_reasons_and_the_slicer_s_shuffle(spark):
    rows = [(1, 0, 0.0, 1.0, 9.0), (2, 0, 0.0, None, 9.0), (2, 1, float("nan"), 2.0, 9.0), (3, 0, 0.0, 1.0, None), (4, 0, 1.0, 2.0, 3.0)]
    seg = spark.createDataFrame(rows, "entry_id long, seg_idx long, start double, end double, audio_duration double").withColumns(
        {"text": F.lit("a"), "word_scores": F.array(F.lit(1.0))})
    got = {r["entry_id"]: (r["reason"], r["n"]) for r in RJ.entry_rejects(seg).collect()}
    assert got == {2: ("segment without an end", 2), 3: ("no audio duration", 1)}
    slices = generate_slices(seg, 30)
    plan = slices._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the window over an entry adds no shuffle
    assert {r["entry_id"] for r in slices.collect()} == {1, 4}
    seen, count = RJ.counted(RJ.entry_rejects(seg), "rejects")
    seen.collect()
    assert count.get == {"rows": 2}
    assert RJ.entry_rejects(seg.limit(0)).collect() == [] and generate_slices(seg.limit(0), 30).collect() == []


def _entry(root, name, segments, metadata):
    d = os.path.join(root, name)
    os.makedirs(d)
    for file, content in (("captions.json", segments), ("metadata.json", metadata)):
        with open(os.path.join(d, file), "w") as f:
            f.write(content if isinstance(content, str) else json.dumps(content))
    with open(os.path.join(d, "audio.mp3"), "wb") as f:
        f.write(b"\x00")


def test_build_from_files_goes_on_past_bad_entries(spark):
    root = tempfile.mkdtemp(prefix="parlance-rejects-")
    def seg(*times):
        return [{"start": a, "end": b, "text": f"t{a}", "words": []} for a, b in times]
    own = {"source_id": "s", "source_entry_id": "7", "duration": 40.0, "a.b": "x", "a": {"b": "y"}}
    _entry(root, "one", seg((0, 5), (6, 9)), own)
    _entry(root, "same ids", seg((1, 4)), own)
    _entry(root, "broken captions", "{oops", own)
    _entry(root, "no array", "{}", own)
    _entry(root, "broken metadata", seg((0, 5)), "[1,")
    _entry(root, "null start", seg((0, 5), (None, 9)), own)
    _entry(root, "excluded", "{oops", own | {"source_id": "skip"})
    out = build_with_rejects(spark, root, "*.mp3", "captions.json", "metadata.json", exclude_filters=["source_id:eq:skip"],
                             copy_metadata_fields=["a.b"])
    ex = {os.path.basename(r["entry_dir"]): r for r in out.examples.collect()}
    assert set(ex) == {"one", "same%20ids"} or set(ex) == {"one", "same ids"}
    assert all(r["entry_id"] == "7" and r["metadata"]["a.b"] == "x" and not r["has_prev"] for r in ex.values())
    got = sorted((os.path.basename(r["entry_id"]).replace("%20", " "), r["level"], r["reason"], r["n"]) for r in out.rejects.collect())
    assert got == [("broken captions", "entry", "captions are not JSON", 1), ("broken metadata", "entry", "metadata is not JSON", 1),
                   ("no array", "entry", "captions are not JSON", 1), ("null start", "entry", "segment without a start", 1)]


def test_label_rows(spark):
    long = " ".join(f"w{i}" for i in range(500))
    rows = [(1, "<|0.00|>a b<|1.00|>", "", False), (2, "<|0.00|>" + long + "<|1.00|>", "", False), (3, "c", "zz new words", True)]
    ex = spark.createDataFrame(rows, "id long, transcript string, prev_transcript string, has_prev boolean").withColumn(
        "has_timestamps", F.col("id") < 3)
    good = {r["id"]: r["labels"] for r in prepare_labels(ex, ["id"], 1.0, 1.0).collect()}
    assert set(good) == {1, 3} and all(x is not None for ids in good.values() for x in ids)  # words of previous texts have ids
    assert [tuple(r) for r in prepare_labels(ex, ["id"], 1.0, 1.0, rejects=True).collect()] == [(2, "labels too long")]
