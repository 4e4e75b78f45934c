"""A hot group (a third of all rows) is spread over tasks by the rank operators and the
results stay exact."""

import numpy as np
from pyspark.sql import functions as F

from parlance.operators.ranks import SMALL_GROUP, order_stats, with_position
from parlance.sources.tables import table

SF = "/root/testdata/sf0.01"


def _skewed(spark):
    ev = table(spark, SF, "events").select("event_id", "value")
    # group 0 holds every third event id range... and a third of all rows overall
    return ev.select(F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("event_id") % 50 + 1).alias("g"),
                     "value", "event_id")


def test_hot_group_spans_many_tasks_and_ranks_are_exact(spark):
    df = _skewed(spark)
    r = with_position(df, ["value", "event_id"], partition_cols=["g"], name="rank", num_partitions=8)
    hot = r.filter("g = 0").select(F.spark_partition_id().alias("p")).distinct().count()
    assert hot > 1, "the hot group is cut over several partitions"
    rows = r.filter("g = 0").orderBy("rank").collect()
    vals = [x["value"] for x in rows]
    assert [x["rank"] for x in rows] == list(range(len(rows)))
    assert vals == sorted(vals)


def test_order_stats_on_hot_group_match_numpy(spark):
    df = _skewed(spark)
    got = {r["g"]: r for r in order_stats(df, ["g"], "value").collect()}
    data = {}
    for r in df.collect():
        data.setdefault(r["g"], []).append(r["value"])
    for g in (0, 1, 7):
        xs = sorted(data[g])
        n = len(xs)
        med = xs[n // 2] if n % 2 else (xs[n // 2 - 1] + xs[n // 2]) / 2
        assert got[g]["n"] == n
        assert abs(got[g]["median"] - med) < 1e-12
        assert got[g]["p90"] == xs[int(0.9 * n)] and got[g]["p99"] == xs[int(0.99 * n)]
        assert abs(got[g]["mean"] - float(np.mean(xs))) < 1e-9


def test_positions_within_hot_group(spark):
    df = _skewed(spark)
    pos = with_position(df, ["event_id"], partition_cols=["g"], name="p", num_partitions=8)
    hot = pos.filter("g = 0").orderBy("event_id").collect()
    assert [x["p"] for x in hot] == list(range(len(hot)))


def test_order_stats_with_hot_value_and_odd_distributions(spark):
    n = 3 * SMALL_GROUP + 17
    x = F.when(F.col("id") % 3 == 0, F.lit(7.25)).otherwise(F.pow(F.lit(10.0), (F.xxhash64("id") % 300).cast("double")) * F.rand(5))
    df = spark.range(0, n, 1, 6).select((F.col("id") % 2 == 0).cast("string").alias("g"), x.alias("v")).unionByName(
        spark.createDataFrame([(None, 1.0), (None, 3.0), ("few", 5.0), ("none", None)], "g string, v double"))
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    stats = order_stats(df, ["g"], "v")
    got = {r["g"]: r for r in stats.collect()}
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before  # nothing is cached
    data = {}
    for r in df.where("v IS NOT NULL").collect():
        data.setdefault(r["g"], []).append(r["v"])
    assert set(got) == set(data) == {"true", "false", None, "few"}
    for g, xs in data.items():
        xs.sort()
        k = len(xs)
        want = ((xs[(k - 1) // 2] + xs[k // 2]) / 2, xs[int(0.9 * k)], xs[int(0.99 * k)], k)
        assert tuple(got[g][c] for c in ("median", "p90", "p99", "n")) == want
    assert order_stats(df.limit(0), ["g"], "v").collect() == []
    assert order_stats(df.select("v"), [], "v").first()["n"] == sum(map(len, data.values()))
