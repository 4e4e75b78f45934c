"""Feature validation, declared schema, Beta interval, adaptive ratios, interleave rules."""

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.operators import sampling as SM
from parlance.operators.shaping import EXAMPLE_SCHEMA, cast_to, validate_features
from parlance.plans import fixtures as FX
from parlance.operators.merging import build_examples
from parlance.sources.specs import parse_dataset_spec, parse_eval_spec
from parlance.sources.tables import table

SF = "/root/testdata/sf0.001"


def test_validate_and_cast(spark):
    ex = build_examples(FX.fixed_hop_slices(spark, SF))
    assert validate_features(ex, {"transcript": T.StringType}) == []
    with pytest.raises(ValueError):
        validate_features(ex.drop("prev_transcript"), {"transcript": T.StringType})
    with pytest.raises(ValueError):
        validate_features(ex.drop("transcript"), {"transcript": T.StringType})
    notes = validate_features(ex.drop("has_timestamps"), {"transcript": T.StringType})
    assert len(notes) == 1
    out = cast_to(ex, EXAMPLE_SCHEMA)
    assert out.schema.simpleString() == EXAMPLE_SCHEMA.simpleString() and out.count() == ex.count()


def test_beta_interval_closed_forms():
    # Beta(1,1) is uniform: central 95% has width 0.95
    assert abs(SM.interval_width(np.array([0.0]), np.array([0.0]))[0] - 0.95) < 1e-9
    # Beta(a,1): quantile q^(1/a)
    a = 5.0
    w = SM.beta_ppf(0.975, np.array([a]), np.array([1.0]))[0] - SM.beta_ppf(0.025, np.array([a]), np.array([1.0]))[0]
    assert abs(w - (0.975 ** (1 / a) - 0.025 ** (1 / a))) < 1e-9
    # symmetric case narrows like the normal approximation
    w = SM.interval_width(np.array([4000.0]), np.array([2000.0]))[0]
    assert abs(w - 2 * 1.959964 * np.sqrt(0.25 / 4002)) < 1e-3


def test_adaptive_ratios_match_sequential_replay(spark):
    lab = table(spark, SF, "labels").orderBy("doc_id").collect()
    est = {r["attribute"]: r for r in SM.estimate_ratios(table(spark, SF, "labels"), "doc_id", {
        "quality": F.col("quality") == 1, "toxic": F.col("toxic") == 1}).collect()}
    # sequential replay of the reference's loop
    n = 0
    pos = {"quality": 0, "toxic": 0}
    done = {"quality": False, "toxic": False}
    for r in lab:
        n += 1
        all_done = True
        for a in pos:
            pos[a] += int(r[a] == 1)
            w = SM.interval_width(np.array([float(n)]), np.array([float(pos[a])]))[0]
            if not done[a] and (w < 0.05 or n >= 4000):
                done[a] = True
            all_done = all_done and done[a]
        if all_done:
            break
    for a in pos:
        assert est[a]["samples"] == n and est[a]["positives"] == pos[a]


def test_specs():
    s = parse_dataset_spec("ds:train[10:20]")
    assert (s.name, s.split, s.start, s.stop) == ("ds", "train", 10, 20)
    assert parse_dataset_spec("org/ds").split == "train"
    with pytest.raises(ValueError):
        parse_dataset_spec("ds:train[10%:20%]")
    e = parse_eval_spec("a/b")
    assert (e.name, e.split, e.text_column) == ("a/b", "test", "text")


def test_interleave_rules(spark):
    d = table(spark, SF, "documents").select("doc_id", "lang")
    frames = {l: d.filter(F.col("lang") == l).select("doc_id") for l in ["de", "en"]}
    sizes = {l: f.count() for l, f in frames.items()}
    out = SM.interleave(spark, frames, "doc_id").collect()
    # round robin until the larger set is exhausted; the smaller one is oversampled
    assert len(out) == 2 * max(sizes.values()) - (1 if sizes["de"] > sizes["en"] else 0)
    seen = {}
    for r in out:
        seen.setdefault(r["source"], set()).add(r["doc_id"])
    assert all(len(seen[l]) == sizes[l] for l in sizes)
    assert SM.interleave(spark, {"de": frames["de"]}, "doc_id") is frames["de"]
    with pytest.raises(ValueError):
        SM.interleave(spark, frames, "doc_id", probabilities=[1.0])


@pytest.mark.parametrize("weighted", [False, True])
def test_interleave_groups_is_the_sequential_one(spark, weighted):
    """150 datasets of unequal length, one of a single row and one without a name, step by step."""
    from parlance.functions.random import uniform
    rows = [(i, None if i % 17 == 0 else f"g{i * i % 149:03d}") for i in range(1200)] + [(5000, "one")]
    weigh = (lambda k: [(i % 5) + 1.0 for i in range(k)]) if weighted else None
    out = SM.interleave_groups(spark.createDataFrame(rows, "id long, g string"), "g", "id", weigh).collect()
    got = {r["step"]: (r["source"], r["id"]) for r in out}
    sets = {}
    for i, g in sorted(rows):
        sets.setdefault(g, []).append(i)
    names = sorted(sets, key=lambda g: (g is None, g or ""))
    k = len(names)
    us = [r[0] for r in spark.range(100_000).orderBy("id").select(uniform(745, F.col("id"), F.lit("interleave"))).collect()] if weighted else []
    p = weigh(k) if weighted else []
    bounds, acc = [], 0.0
    for x in p[:-1]:
        acc += x / sum(p)
        bounds.append(acc)
    taken, step, want = dict.fromkeys(names, 0), 0, {}
    while any(taken[g] < len(sets[g]) for g in names):
        g = names[sum(b <= us[step] for b in bounds)] if weighted else names[step % k]
        want[step] = (g, sets[g][taken[g] % len(sets[g])])
        taken[g] += 1
        step += 1
    assert len(out) == len(got) and got == want


def test_interleave_beside_a_tiny_dataset(spark):
    """A row that is drawn more often than one task repeats it, and one or no dataset."""
    big = spark.range(10_000).withColumn("g", F.lit("a"))
    out = SM.interleave_groups(big.unionByName(spark.createDataFrame([(-1, "b")], "id long, g string")), "g", "id")
    assert out.where("source = 'b' AND id = -1 AND step % 2 = 1").count() == 9_999
    assert out.where("source = 'a'").select("id").distinct().count() == out.where("source = 'a' AND step = 2 * id").count() == 10_000
    assert [tuple(r) for r in SM.interleave_groups(big.limit(0), "g", "id").collect()] == []
    one = SM.interleave_groups(spark.createDataFrame([(7, "x"), (3, "x")], "id long, g string"), "g", "id")
    assert sorted((r["step"], r["source"], r["id"]) for r in one.collect()) == [(0, "x", 3), (1, "x", 7)]


def test_average_is_repeatable_to_the_bit(spark):
    """Any partitioning and any block size gives the same bits; vectors of unequal length too."""
    import random

    from parlance.operators import vectors as VC
    rng = random.Random(2)
    rows = [(c, k, [rng.uniform(-1, 1) * 10 ** rng.randint(-6, 6) for _ in range(40 + k)]) for c in range(5) for k in range(6)]
    w = [0.1, 0.2, 0.3, 0.25, 0.15]
    want = None
    for parts, block in ((1, 4096), (7, 16), (3, 1)):
        rng.shuffle(rows)
        ws = spark.createDataFrame(rows, "checkpoint int, key int, values array<float>").repartition(parts)
        long = {(r["key"], r["pos"]): r["value"] for r in VC.average(ws, list(range(5)), w, block=block).collect()}
        arrays = {r["key"]: list(r["values"]) for r in VC.average(ws, list(range(5)), w, as_arrays=True, block=block).collect()}
        assert {(k, p): v for k, vs in arrays.items() for p, v in enumerate(vs)} == long
        want = want or long
        assert long == want and len(long) == sum(40 + k for k in range(6))


def test_partial_average_scales_the_weights_that_are_there(spark):
    from parlance.operators import vectors as VC
    rows = [(0, 1, [1.0, 2.0, 3.0]), (1, 1, [3.0, 6.0]), (1, 2, [5.0, 7.0]), (0, 3, None), (1, 3, [4.0])]
    ws = spark.createDataFrame(rows, "checkpoint int, key int, values array<float>")
    for block in (4096, 1):
        got = {(r["key"], r["pos"]): r["value"] for r in VC.average(ws, [0, 1], [0.25, 0.75], block=block, partial=True).collect()}
        assert got == {(1, 0): 2.5, (1, 1): 5.0, (1, 2): 3.0, (2, 0): 5.0, (2, 1): 7.0, (3, 0): 4.0}
    with pytest.raises(ValueError, match="different keys"):
        VC.average(ws, [0, 1], [0.25, 0.75])


@pytest.mark.parametrize("query", ["checkpoint_average_equal", "checkpoint_average_weighted"])
def test_checkpoint_average_takes_every_vector(spark, tmp_path, query):
    """A number of vectors that ten does not divide, checkpoints of unequal size, labels and ids that
    are null, repeated or beyond 0..9."""
    import duckdb

    from parlance.plans.catalog import ORACLES, QUERIES
    rows = [(i, [float(i), i / 8, -1.0], (i * i) % 10) for i in range(53)]
    rows += [(None, [9.0, 9.5], 4), (7, [2.0, 2.0, 2.0], 9), (7, [1.0, 1.0, 1.0], 9), (60, [3.5], None), (61, [4.5, 1.0], 17), (62, None, 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{tmp_path}/embeddings.parquet")
    got = {(r["key"], r["pos"]): r["value"] for r in QUERIES[query](spark, str(tmp_path)).collect()}
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{tmp_path}/embeddings.parquet/*.parquet'")
    want = {(k, p): v for k, p, v in con.sql(ORACLES[query]).fetchall()}
    sets = {}
    for i, e, label in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or [])):
        sets.setdefault((label or 0) % 10, []).append(e)
    brute = {}
    for c, vectors in sorted(sets.items()):
        for k, e in enumerate(vectors, 1):
            for p, v in enumerate(e or []):
                brute.setdefault((k, p), []).append((0.1 if query.endswith("equal") else (c + 1) / 55, v))
    assert got.keys() == want.keys() == brute.keys()
    for at, held in brute.items():
        x = sum(w * v for w, v in held) / (sum(w for w, _ in held) if len(held) < 10 else 1)
        assert abs(got[at] - x) < 2e-6 * max(1, abs(x)) and abs(got[at] - want[at]) < 2e-6 * max(1, abs(x))
