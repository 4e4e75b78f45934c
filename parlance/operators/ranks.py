"""Exact order statistics and positions without putting a group into one task (AGG2).

``collect_list`` + sort, ``percentile`` and ``row_number() OVER (PARTITION BY g)`` all
send every value of a group to one task; with one group holding a third of the data
that task is the job. ``order_stats`` selects the wanted ranks (sketch, count, order what is
left). ``with_position`` numbers all rows:

1. range-partition on the keys and sort inside partitions: a hot group is
   cut into many contiguous ranges by the sampled range bounds;
2. the position inside a partition comes from ``monotonically_increasing_id`` (it
   encodes partition index and record number, so it is ordered after the sort);
3. rows per ``(group, partition)`` -- at most ``#groups + #partitions`` rows -- give
   each partition's offset inside its group via a running sum;
4. position = offset + position in the partition - first position of the group there.

The offsets table is broadcast only when its proven bound (#groups + #partitions, with
#groups counted by a cheap partial aggregate first) is small; otherwise it is a normal
join. The sorted data is persisted so the count and the join read one partitioning.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# A side is broadcast only below this many rows (its row width is four longs).
BROADCAST_ROWS = 2_000_000


def _sorted_once(df: DataFrame, keys: list[str], p: int) -> DataFrame:
    """Range-partition and sort once, tagging partition index and position.

    The per-partition counts and the rows must see the same partitioning. Two range
    exchanges over differently pruned inputs sample with different seeds (the seed
    includes the RDD id) and so can cut at different bounds; the sorted data is
    therefore persisted (memory and disk) and both branches read it. A lost block is
    recomputed from the same shuffle dependency, hence the same bounds.
    """
    from pyspark import StorageLevel
    s = (df.repartitionByRange(p, *[F.col(k).asc_nulls_first() for k in keys])
           .sortWithinPartitions(*keys)
           .withColumn("_pid", F.spark_partition_id())
           .withColumn("_pos", F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33)))
    return s.persist(StorageLevel.MEMORY_AND_DISK)


#: Accuracy of the quantile sketches (rank error n / ACCURACY) and the share of a group's rows to
#: each side of a wanted rank that is then ordered exactly, several times that error.
ACCURACY = 50_000
MARGIN = 2e-4
#: Groups of fewer rows are ordered whole: their ranks are coarser than the margin.
SMALL_GROUP = 20_000
#: Parts that the values of a group are spread over when they meet its bounds.
SPREAD = 32
_WANTED = (0.5, 0.9, 0.99)


def order_stats(df: DataFrame, group_cols: list[str], value_col: str) -> DataFrame:
    """mean, median (mean of middle pair), p90 = sorted[int(0.9 n)], p99 = sorted[int(0.99 n)]
    (0-based) and n for each group, exactly. Null values are left out.

    Distributed selection, without a cache and without a job while the plan is made:

    1. a sketch of bounded size per group, combined map-side, gives values certainly below and above
       each wanted rank;
    2. ties are folded to ``(group, value, count)`` with a map-side combine, so a value that holds a
       third of the rows is a row per task, and meet the bounds of their group in ``SPREAD`` parts;
    3. rows below are only counted (one row per group and task), rows between are ordered: about
       2 * MARGIN of a group, or all of a small one, whatever the distribution of the values. The
       count shows whether the bounds held; the query fails rather than give another value.
    """
    v = F.col(value_col).cast("double")
    group = F.struct(*group_cols) if group_cols else F.struct(F.lit(0).alias("_all"))
    rows = df.where(v.isNotNull()).select(group.alias("_g"), v.alias("_v"))
    around = F.array(*[F.lit(x) for q in _WANTED for x in (q - MARGIN, q + MARGIN)])
    small = F.col("n") < SMALL_GROUP
    sized = (rows.groupBy("_g").agg(F.count(F.lit(1)).alias("n"), (F.sum("_v") / F.count(F.lit(1))).alias("mean"),
                                    F.percentile_approx("_v", around, ACCURACY).alias("_b"),
                                    F.min("_v").alias("_min"), F.max("_v").alias("_max"))
             .select("_g", "n", "mean", F.array(*[F.struct(
                 F.lit(k).alias("k"), F.when(small, F.col("_min")).otherwise(F.col("_b")[2 * k]).alias("lo"),
                 F.when(small, F.col("_max")).otherwise(F.col("_b")[2 * k + 1]).alias("hi")) for k in range(len(_WANTED))]).alias("_bands"),
                 F.explode(F.sequence(F.lit(0), F.lit(SPREAD - 1))).alias("_part")))
    folded = rows.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn(
        "_part", F.pmod(F.xxhash64("_v"), F.lit(SPREAD)).cast("int"))
    near = (folded.join(sized, ["_g", "_part"])
            .select("_g", "n", "mean", "_v", "_c", F.explode(F.filter("_bands", lambda b: F.col("_v") <= b["hi"])).alias("_band"))
            .groupBy("_g", "_band.k", F.when(F.col("_v") >= F.col("_band.lo"), F.col("_v")).alias("_v"))
            .agg(F.sum("_c").alias("_c"), F.max("n").alias("n"), F.max("mean").alias("mean")))
    upto = F.sum("_c").over(Window.partitionBy("_g", "k").orderBy(F.col("_v").asc_nulls_first())
                            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    n = F.col("n")

    def at(k: int, rank):
        return F.min(F.when((F.col("k") == k) & F.col("_v").isNotNull() & (F.col("_upto") >= rank), F.col("_v")))

    def first(k: int):  # rows certainly below the band
        return F.max(F.when((F.col("k") == k) & F.col("_v").isNull(), F.col("_upto")))

    low, high = F.floor((n + 1) / 2), F.floor(n / 2) + 1
    k90, k99 = F.floor(F.lit(0.9) * n) + 1, F.floor(F.lit(0.99) * n) + 1
    picked = near.withColumn("_upto", upto).groupBy("_g").agg(
        F.max("mean").alias("mean"), F.max("n").alias("n"), ((at(0, low) + at(0, high)) / 2).alias("median"),
        at(1, k90).alias("p90"), at(2, k99).alias("p99"), *[F.coalesce(first(k), F.lit(0)).alias(f"_f{k}") for k in range(3)])
    held = ((F.col("_f0") < low) & (F.col("_f1") < k90) & (F.col("_f2") < k99)
            & F.col("median").isNotNull() & F.col("p90").isNotNull() & F.col("p99").isNotNull())
    checked = F.when(held, F.col("median")).otherwise(F.raise_error(F.lit("a quantile sketch missed a wanted rank")).cast("double"))
    return picked.select(*[F.col(f"_g.{c}") for c in group_cols], "mean", "n", checked.alias("median"), "p90", "p99")


def with_position(df: DataFrame, order_cols: list[str], partition_cols: list[str] | None = None,
                  name: str = "pos", num_partitions: int | None = None) -> DataFrame:
    """Add a 0-based position in ``order_cols`` order (inside ``partition_cols`` groups).

    Same scheme as ``ranked`` but carrying every column: range-partition + per-partition
    counts + running offsets, so neither a hot group nor the whole table meets in one
    task. ``order_cols`` must make the order total (end with a unique key).
    """
    spark = df.sparkSession
    p = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = list(partition_cols or [])
    keys = groups + list(order_cols)
    s = _sorted_once(df, keys, p)
    counts = s.groupBy(*groups, "_pid").agg(F.count(F.lit(1)).alias("_c"), F.min("_pos").alias("_first"))
    w = (Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))).orderBy("_pid")
    offsets = (counts
               .withColumn("_off", F.coalesce(F.sum("_c").over(w.rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)) - F.col("_first"))
               .select(*groups, "_pid", "_off"))
    n_groups = df.select(*groups).distinct().count() if groups else 1
    if n_groups + p <= BROADCAST_ROWS:
        offsets = F.broadcast(offsets)
    out = s.join(offsets, on=[*groups, "_pid"], how="inner")
    return out.withColumn(name, F.col("_off") + F.col("_pos")).drop("_pid", "_pos", "_off")
