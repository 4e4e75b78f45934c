"""STR4: resumable packing equals the batch slicer, in pure Python and as a stream."""

import datetime
import random
import tempfile

from pyspark.sql import Window
from pyspark.sql import functions as F

from parlance.operators.slicing import Seg, generate_slices, resume_slices, slice_segments
from parlance.plans import fixtures as FX
from parlance.streaming.slicer import stream_slices
from tests.test_slicer_goldens import CASES

SF = "/root/testdata/sf0.001"


def _chunked(segs, dur, thr, cuts):
    out, nxt, i, base, buf = [], 0.0, 0, 0, []
    pos = 0
    for c in cuts + [len(segs)]:
        buf = buf + segs[pos:c]
        pos = c
        final = pos == len(segs)
        sl, nxt, i, done, base, buf = resume_slices(base, buf, dur, 30, thr, nxt, i, final)
        out += sl
        if done:
            break
    return out


def test_resumable_equals_batch_on_goldens():
    rng = random.Random(5)
    for _, segs, dur, thr, _ in CASES:
        s = [Seg(*x) for x in segs]
        want = list(slice_segments(s, dur, 30, thr))
        for _ in range(10):
            cuts = sorted(rng.sample(range(len(s) + 1), k=rng.randint(0, len(s))))
            assert _chunked(s, dur, thr, cuts) == want


def test_stream_slicer_equals_batch(spark):
    seg = FX.segment_rows(spark, SF)
    last = F.max("seg_idx").over(Window.partitionBy("entry_id"))
    ts = (F.lit("2024-01-01 00:00:00").cast("timestamp")
          + F.make_dt_interval(mins=F.col("entry_id").cast("int"), secs=F.col("seg_idx").cast("int")))
    rows = seg.withColumn("ts", ts).withColumn("is_last", F.col("seg_idx") == last)
    d = tempfile.mkdtemp(prefix="parlance-segstream-")
    b = rows.withColumn("_b", F.ntile(4).over(Window.orderBy("ts", "entry_id")))
    for k in range(1, 5):  # sequential appends: file order is time order
        b.filter(F.col("_b") == k).drop("_b").coalesce(1).write.mode("append").parquet(d)
    s = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(d)
    ck = tempfile.mkdtemp(prefix="parlance-ckpt-")
    q = (stream_slices(s, 30, 0.5).writeStream.format("memory").queryName("str4").outputMode("append")
         .option("checkpointLocation", ck).start())
    q.processAllAvailable()
    q.stop()
    got = spark.table("str4").select("entry_id", "slice_idx", "seek", F.to_json("segments").alias("j")).collect()
    want = generate_slices(seg, 30, 0.5).select("entry_id", "slice_idx", "seek", F.to_json("segments").alias("j")).collect()
    assert sorted(got) == sorted(want) and len(got) > 0


def _run(spark, batches, schema, name):
    """The stream over the batches in this order, one file each."""
    d, ck = tempfile.mkdtemp(prefix="parlance-segstream-"), tempfile.mkdtemp(prefix="parlance-ckpt-")
    s = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(d)
    out = None
    for b in batches:  # written and processed one after the other
        spark.createDataFrame(b, schema).coalesce(1).write.mode("append").parquet(d)
        q = (stream_slices(s, 30, 0.0).writeStream.format("memory").queryName(name).outputMode("append")
             .option("checkpointLocation", ck).start()) if out is None else out
        out = q
        q.processAllAvailable()
    out.stop()
    return spark.table(name).select("entry_id", "slice_idx", "seek", F.to_json("segments").alias("j")).collect()


def test_late_repeated_reordered_and_overlong_segments(spark):
    """Entry 1 comes out of order and repeated, entry 2 goes on beyond its audio's end, entry 3 has a
    null start: the slices are the batch slicer's, and none comes twice."""
    rng = random.Random(3)
    schema = ("entry_id long, seg_idx long, ts timestamp, start double, end double, text string, word_scores array<double>, "
              "audio_duration double, is_last boolean")
    t0 = datetime.datetime(2024, 1, 1)
    def rows(e, n, dur):
        return [(e, k, t0 + datetime.timedelta(seconds=k % 30), 7.0 * k, 7.0 * k + 6, f"s{k}", [0.9], dur, k == n - 1) for k in range(n)]
    one, two, three = rows(1, 24, 170.0), rows(2, 24, 60.0), rows(3, 6, 45.0)
    three[4] = (*three[4][:3], None, *three[4][4:])
    mixed = one[:]
    rng.shuffle(mixed)
    batches = [[r for p in (mixed, two, three) for r in p[k::4]] for k in range(4)]
    batches[2] += mixed[0::4] + two[:3]          # repeats within the watermark
    batches.append(two[:4] + two[-2:] + one[:2])  # and after the entries have ended
    got = _run(spark, batches, schema, "str4_hard")
    want = generate_slices(spark.createDataFrame(one + two, schema), 30, 0.0).select(
        "entry_id", "slice_idx", "seek", F.to_json("segments").alias("j")).collect()
    assert sorted(r for r in got if r["entry_id"] < 3) == sorted(want) and len(want) > 4
    assert len({(r["entry_id"], r["slice_idx"]) for r in got}) == len(got)
