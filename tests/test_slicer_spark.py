"""The distributed slicer (sorted mapInArrow) equals the pure-Python state machine run
entry by entry; the example chain reuses it."""

from collections import defaultdict

from pyspark.sql import functions as F

from parlance.operators.slicing import Seg, generate_slices, slice_segments
from parlance.plans import fixtures as FX

SF = "/root/testdata/sf0.001"


def test_spark_slicer_equals_python(spark):
    seg = FX.segment_rows(spark, SF)
    rows = seg.orderBy("entry_id", "seg_idx").collect()
    by_entry = defaultdict(list)
    dur = {}
    for r in rows:
        by_entry[r["entry_id"]].append(Seg(r["start"], r["end"], r["text"], list(r["word_scores"])))
        dur[r["entry_id"]] = r["audio_duration"]
    want = {}
    for e, segs in by_entry.items():
        for k, (seek, out) in enumerate(slice_segments(segs, dur[e], 30, 0.5)):
            want[(e, k)] = (seek, [(s["start"], s.get("end"), s.get("text")) for s in out])
    got = {}
    for r in generate_slices(seg, 30, 0.5, num_partitions=3).collect():
        got[(r["entry_id"], r["slice_idx"])] = (r["seek"], [(s["start"], s["end"], s["text"]) for s in r["segments"]])
    assert got == want
    assert len(got) > 0


def test_slicer_is_partitioning_independent(spark):
    seg = FX.segment_rows(spark, SF)
    a = generate_slices(seg, 30, 0.0, num_partitions=1).select("entry_id", "slice_idx", F.to_json("segments")).collect()
    b = generate_slices(seg, 30, 0.0, num_partitions=7).select("entry_id", "slice_idx", F.to_json("segments")).collect()
    assert sorted(a) == sorted(b)
