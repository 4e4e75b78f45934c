"""Edges of sources, specs and metrics: odd folder names, ranges from the end, empty predictions."""

import json

import pytest
from pyspark.sql import functions as F

from parlance.functions import align as A
from parlance.plans.catalog import QUERIES
from parlance.plans.flows import build_dataset
from parlance.plans.queries_sampling import PROBS, falling_weights
from parlance.sources.sinks import existing
from parlance.sources.specs import parse_dataset_spec, read_prepared


def test_default_globs_and_odd_folder_names(spark, tmp_path):
    names = ["plain", "with space", "a+b", "שלום"]
    for i, n in enumerate(names):
        d = tmp_path / n
        d.mkdir()
        (d / "audio.mp3").write_bytes(b"\x00")
        (d / "transcript.aligned.json").write_text(json.dumps([{"start": 0.0, "end": 4.0, "text": f"t{i}", "words": []}]))
        (d / "metadata.json").write_text(json.dumps({"source_entry_id": str(i), "duration": 5.0}))
    assert {r["entry_id"] for r in build_dataset(spark, str(tmp_path)).collect()} == {"0", "1", "2", "3"}


def test_specs():
    s = parse_dataset_spec("a/b[x:y]:train[10:20]")
    assert (s.name, s.split, s.start, s.stop) == ("a/b[x:y]", "train", 10, 20)
    for bad in ("d:train[:-5]", "d:train[-5:]", "d:train[10%:]", "d:train[1"):
        with pytest.raises(ValueError):
            parse_dataset_spec(bad)


def test_empty_prediction_and_empty_reference(spark):
    n = [F.lit(0).cast("long")] * 4
    df = spark.range(1).select(A.wil(n[0], F.lit(3), n[0], n[0]).alias("no_prediction"), A.wil(n[0], n[0], F.lit(2), n[0]).alias("no_reference"))
    assert tuple(df.first()) == (1.0, None)


def test_only_a_missing_path_counts_as_missing(spark, tmp_path):
    assert existing(spark, str(tmp_path / "none")) is None
    assert read_prepared(spark, str(tmp_path / "none"), lambda: spark.range(3)).count() == 3
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "a.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        existing(spark, str(tmp_path / "broken"))


@pytest.mark.parametrize("name", ["interleave_round_robin", "interleave_weighted"])
def test_interleaving_takes_every_language_of_the_table(spark, tmp_path, name):
    rows = [(1, "it"), (2, "it"), (3, None), (4, "de"), (5, "fr"), (6, "en"), (7, "zh")]
    spark.createDataFrame(rows, "doc_id long, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES[name](spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["source"]) for r in got} == set(rows)
    assert sorted(r["step"] for r in got) == list(range(len(got)))
    assert falling_weights(4) == PROBS
