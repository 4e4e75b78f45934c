"""Position-based operators give the same result whatever the input partitioning
(the test tables scan as a single partition, so spread them deliberately)."""

from pyspark.sql import functions as F

from parlance.operators import sampling as SM
from parlance.operators.labels import build_vocabulary
from parlance.operators.ranks import with_position
from parlance.sources.tables import table

SF = "/root/testdata/sf0.01"


def _both(spark, fn):
    d = table(spark, SF, "documents").select("doc_id", "lang", "text")
    return sorted(fn(d.coalesce(1)).collect()), sorted(fn(d.repartition(7, "lang")).collect())


def test_slice_split_head_positions(spark):
    for fn in [lambda d: SM.absolute_slice(d.select("doc_id"), "doc_id", 100, 350),
               lambda d: SM.train_eval_split(d.select("doc_id"), "doc_id", 0.1),
               lambda d: SM.shuffled_head(d.select("doc_id"), "doc_id", 100, 745),
               lambda d: with_position(d.select("doc_id", "lang"), ["doc_id"], partition_cols=["lang"], name="p",
                                       num_partitions=5),
               lambda d: build_vocabulary(d.filter(F.col("doc_id") < 300), "text")]:
        a, b = _both(spark, fn)
        assert a == b and len(a) > 0


def test_interleave_partitioning(spark):
    def fn(d):
        frames = {l: d.filter(F.col("lang") == l).select("doc_id") for l in ["de", "en", "es"]}
        return SM.interleave(spark, frames, "doc_id", probabilities=[0.5, 0.3, 0.2])
    a, b = _both(spark, fn)
    assert a == b
