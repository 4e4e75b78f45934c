"""End-to-end flows: dataset build from files, evaluation with a scorer, label preparation;
plus sinks and the reuse anti-join."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from parlance.functions.align import align_words
from parlance.operators import merging as MG
from parlance.operators.slicing import generate_slices
from parlance.operators.transcribe import example_scorer_factory
from parlance.plans import fixtures as FX
from parlance.plans.flows import build_dataset, evaluate, evaluate_to, prepare_labels, summarize
from parlance.sources import files as FS
from parlance.sources import sinks as SK

SF = "/root/testdata/sf0.001"


def _write_corpus(spark, root):
    """One folder per conversation: captions JSON (F1 segments), dummy audio, metadata."""
    seg = FX.segment_rows(spark, SF).orderBy("entry_id", "seg_idx").collect()
    by = {}
    for r in seg:
        by.setdefault(r["entry_id"], []).append(r)
    for e, rows in by.items():
        d = os.path.join(root, f"src{e % 3}", f"entry{e}")
        os.makedirs(d)
        caps = [{"start": r["start"], "end": r["end"], "text": r["text"],
                 "words": [{"word": w, "start": r["start"], "end": r["end"], "probability": p}
                           for w, p in zip(r["text"].split(), r["word_scores"])]} for r in rows]
        with open(os.path.join(d, "captions.json"), "w") as f:
            json.dump(caps, f)
        with open(os.path.join(d, "audio.mp3"), "wb") as f:
            f.write(b"\x00")
        meta = {"source_id": f"src{e % 3}", "source_entry_id": str(e), "duration": rows[0]["audio_duration"],
                "quality_score": (e % 10) / 10, "extra": {"k": e % 4}}
        with open(os.path.join(d, "metadata.json"), "w") as f:
            json.dump(meta, f)
    return by


def test_build_dataset_from_files(spark):
    root = tempfile.mkdtemp(prefix="parlance-corpus-")
    by = _write_corpus(spark, root)
    # captions.json and metadata.json both match *.json: two segment files is an error
    try:
        FS.manifest(spark, root, "*.mp3", "*.json", "metadata.json")
        raise AssertionError("expected an error")
    except ValueError:
        pass
    man = FS.manifest(spark, root, "*.mp3", "captions.json", "metadata.json")
    assert man.count() == len(by)
    ex = build_dataset(spark, root, "*.mp3", "captions.json", "metadata.json", per_segment_quality_threshold=0.5,
                       exclude_filters=["extra.k:eq:3"], quality_threshold=0.2, copy_metadata_fields=["source_id"])
    got = {(r["entry_id"], r["slice_idx"]): r for r in ex.collect()}
    # the same examples straight from the segment table, with the same gates applied
    keep = [e for e in by if (e % 4) != 3 and (e % 10) / 10 >= 0.2]
    seg = FX.segment_rows(spark, SF).filter(F.col("entry_id").isin(keep))
    want = MG.build_examples(generate_slices(seg, 30, 0.5)).collect()
    assert {(str(r["entry_id"]), r["slice_idx"]): (r["transcript"], r["has_prev"], r["prev_transcript"]) for r in want} == \
        {k: (r["transcript"], r["has_prev"], r["prev_transcript"]) for k, r in got.items()}
    one = next(iter(got.values()))
    assert one["metadata"]["source"].startswith("src") and one["metadata"]["source_id"] == one["metadata"]["source"]
    assert one["has_timestamps"] is True and abs(one["metadata"]["duration"] - 30.0) < 1e-6


def test_manifest_rejects_incomplete_folder(spark):
    root = tempfile.mkdtemp(prefix="parlance-bad-")
    d = os.path.join(root, "a")
    os.makedirs(d)
    open(os.path.join(d, "captions.json"), "w").write("[]")
    open(os.path.join(d, "metadata.json"), "w").write("{}")
    try:
        FS.manifest(spark, root, "*.mp3", "captions.json", "metadata.json")
        raise AssertionError("expected an error")
    except ValueError:
        pass


def test_text_pair(spark):
    root = tempfile.mkdtemp(prefix="parlance-pair-")
    a, b = os.path.join(root, "ref.txt"), os.path.join(root, "hyp.txt")
    open(a, "w").write("Hello, big-world!\n")
    open(b, "w").write("hello big world\n")
    r = FS.read_text_pair(spark, a, b).first()
    assert r["reference_text"].startswith("Hello") and r["predicted_text"].startswith("hello")


def test_evaluate_and_reuse(spark):
    conv = (FX.chunk_stream(spark, SF)
            .select(F.concat_ws("-", "stream_id", "seq").alias("id"), "text", "role",
                    (F.length("text") / 50.0).alias("audio_duration")))
    rows = evaluate(conv, "text", lambda **kw: example_scorer_factory(**kw), model="m", dataset="conv",
                    engine="example").cache()
    n = conv.count()
    assert rows.count() == n
    # short inputs are not scored: empty prediction, zero time
    short = rows.filter(F.col("audio_duration") < 0.5).collect()
    assert all(r["predicted_text"] == "" and r["transcription_time"] == 0.0 for r in short)
    # per-row counts agree with a direct alignment of the normalised texts
    for r in rows.limit(20).collect():
        _, _, s, d, i, h = align_words(r["norm_reference_text"].split(), r["norm_predicted_text"].split())
        assert (r["substitutions"], r["deletions"], r["insertions"], r["hits"]) == (s, d, i, h)
    assert {"metadata_role", "model", "dataset", "split", "engine"} <= set(rows.columns)
    corpus, lat = summarize(rows)
    c = corpus.first()
    assert c["n_pairs"] == n and 0 <= c["wer"]
    assert lat.count() == 3
    # SNK2 round trip and SNK5: nothing left to do after a full run
    out = tempfile.mkdtemp(prefix="parlance-eval-") + "/rows"
    SK.write_csv(rows, out)
    back = SK.read_csv(spark, out, rows.select("id", "wer").schema)
    assert back.count() == n
    assert SK.pending(conv, back, ["id"]).count() == 0
    assert SK.pending(conv, back.limit(10), ["id"]).count() == n - 10


def test_every_row_is_scored_once(spark):
    """Resumed after one of three blocks was lost, then summarised: one call of the scorer per row."""
    import shutil
    log = tempfile.mkdtemp(prefix="parlance-calls-")

    def factory():
        inner = example_scorer_factory()

        def fn(entry):
            with open(os.path.join(log, f"{os.getpid()}.txt"), "a") as f:
                f.write(entry["id"] + "\n")
            return inner(entry)
        return fn

    def calls():
        return sorted(x for n in os.listdir(log) for x in open(os.path.join(log, n)).read().split())

    conv = (FX.chunk_stream(spark, SF).select(F.concat_ws("-", "stream_id", "seq").alias("id"), "text",
                                              (F.length("text") / 50.0).alias("audio_duration")))
    scored = sorted(r["id"] for r in conv.where("audio_duration >= 0.5").collect())
    path = tempfile.mkdtemp(prefix="parlance-kept-") + "/rows"
    run = lambda **kw: evaluate_to(spark, path, conv, "text", factory, model="m", dataset="conv", **kw)
    rows = run(blocks=3)
    assert rows.count() == conv.count()
    corpus, lat = summarize(rows)
    assert corpus.first()["n_pairs"] == conv.count() and lat.count() == 3
    assert calls() == scored
    before = sorted(map(tuple, rows.drop("batch").collect()))
    lost = {r["id"] for r in rows.where("batch = 1 AND audio_duration >= 0.5").collect()}
    shutil.rmtree(path + "/batch=1")
    again = run()
    assert sorted(map(tuple, again.drop("batch").collect())) == before
    assert calls() == sorted([*scored, *lost]) and lost
    assert run(overwrite=True).count() == conv.count() and calls() == sorted([*scored, *scored, *lost])


def test_sweep_goes_on_after_failures(spark):
    from parlance.sources import specs as SP
    ran = []

    def run_one(es):
        ran.append(es.name)
        if es.name == "refused":
            raise ValueError("no access\nsecond line")
        n = spark.range(4).withColumn("x", F.lit(es.text_column))
        if es.name == "breaks":
            return n.withColumn("x", F.when(F.col("id") == 3, F.raise_error(F.lit("bad row"))).otherwise(F.col("x")))
        return n if es.name != "absent" else spark.table("no_such_table_here")
    path = tempfile.mkdtemp(prefix="parlance-sweep-")
    specs = ["a/b:test:t", "breaks", "refused", "absent", "c", "a/b:test:t"]
    out = SP.run_sweep(spark, specs, run_one, path)
    st = {r["spec"]: r for r in out.status.collect()}
    assert {k: r["status"] for k, r in st.items()} == {"a/b:test:t": "finished", "breaks": "failed", "refused": "failed",
                                                       "absent": "failed", "c": "finished"}
    assert st["refused"]["reason"] == "ValueError: no access" and st["breaks"]["reason"] and st["absent"]["reason"]
    assert sorted(map(tuple, out.results.groupBy("dataset").count().collect())) == [("a/b:test", 4), ("c:test", 4)]
    ran.clear()
    again = SP.run_sweep(spark, specs[:2], run_one, path)
    assert [r["status"] for r in again.status.orderBy("spec").collect()] == ["reused", "failed"] and ran == ["breaks"]
    ran.clear()
    assert SP.run_sweep(spark, specs[:1], run_one, path, overwrite=True).status.first()["status"] == "finished" and ran == ["a/b"]
    none = SP.run_sweep(spark, ["refused"], run_one, path)
    assert none.results is None and none.status.first()["n_rows"] is None


def test_prepare_labels_and_write(spark):
    ex = MG.build_examples(FX.fixed_hop_slices(spark, SF))
    lab = prepare_labels(ex, ["entry_id", "slice_idx"])
    rows = lab.collect()
    assert rows and all(len(r["labels"]) <= 448 for r in rows)
    out = tempfile.mkdtemp(prefix="parlance-prep-") + "/ds"
    SK.write_dataset(lab.withColumn("split", F.when(F.col("slice_idx") % 5 == 0, "eval").otherwise("train")), out)
    counts = {r["split"]: r["n_rows"] for r in SK.split_counts(spark.read.parquet(out)).collect()}
    assert sum(counts.values()) == len(rows) and set(counts) == {"train", "eval"}
