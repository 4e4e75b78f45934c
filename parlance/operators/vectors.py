"""Weight-set operators: weighted element-wise averaging (AGG9), key-set check (JOIN3)
and renamed overlay (JOIN4).

A weight set is the long table ``(checkpoint, key, values ARRAY<FLOAT>)``. Averaging cuts the
vectors into blocks of ``BLOCK`` values: a row is shuffled per block and checkpoint, not per
value, and one very large tensor is spread over many tasks by the ``(key, block)`` hash. The
blocks of the checkpoints are folded in the order of the checkpoints, in DOUBLE, so the result
is the same to the last bit however the input is partitioned.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 1_000_000
#: Values of a block.
BLOCK = 4096


def validate_weights(n_checkpoints: int, weights: list[float] | None) -> list[float]:
    """Weights must match the checkpoints in number and sum to 1 within 1e-6; default
    equal."""
    if not weights:
        return [1.0 / n_checkpoints] * n_checkpoints
    if len(weights) != n_checkpoints:
        raise ValueError(f"{len(weights)} weights were given for {n_checkpoints} checkpoints")
    if abs(sum(weights) - 1.0) >= 1e-6:
        raise ValueError(f"the weights add up to {sum(weights)}, not to 1")
    return list(weights)


def key_coverage(ws: DataFrame) -> DataFrame:
    """JOIN3: per checkpoint, its key count and how many keys of the union it lacks."""
    n_union = ws.select("key").distinct().count()  # one scalar
    per = ws.groupBy("checkpoint").agg(F.countDistinct("key").alias("n_keys"))
    return per.select("checkpoint", F.col("n_keys").cast("bigint").alias("n_keys"),
                      (F.lit(n_union) - F.col("n_keys")).cast("bigint").alias("n_missing"))


def assert_same_keys(ws: DataFrame) -> None:
    """Fail when checkpoints differ in their key sets (keys held by fewer checkpoints
    than exist)."""
    n_ckpt = ws.select("checkpoint").distinct().count()
    bad = (ws.groupBy("key").agg(F.countDistinct("checkpoint").alias("c"))
             .filter(F.col("c") != n_ckpt).limit(1).count())
    if bad:
        raise ValueError("Model checkpoints have different keys")


def average(ws: DataFrame, checkpoints: list, weights: list[float] | None = None, check: bool = True,
            as_arrays: bool = False, block: int = BLOCK, partial: bool = False) -> DataFrame:
    """AGG9: ``sum_c w_c * values_c`` per key, accumulated in DOUBLE in the order of
    ``checkpoints``, result FLOAT.

    Checkpoints of different keys are an error, as in the reference. With ``partial`` they are not:
    a value that only some checkpoints hold is the average over those, their weights scaled to sum
    to 1; one that all hold is the same as without ``partial``.

    Returns the long form ``(key, pos, value)``; ``as_arrays`` re-assembles one array per
    key (a whole tensor then sits in one row, so keep that for tensors of bounded size).
    """
    w = validate_weights(len(checkpoints), weights)
    if check and not partial:
        assert_same_keys(ws.filter(F.col("checkpoint").isin(checkpoints)))
    order = F.create_map(*[x for i, c in enumerate(checkpoints) for x in (F.lit(c), F.lit(i))])
    wmap = F.create_map(*[x for i, wt in enumerate(w) for x in (F.lit(i), F.lit(float(wt)))])
    cuts = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.size("values") / block).cast("int") - 1, F.lit(0))),
                       lambda b: F.slice("values", b * block + 1, F.lit(block)))
    parts = (ws.filter(F.col("checkpoint").isin(checkpoints))
               .select("key", order[F.col("checkpoint")].alias("c"), F.posexplode(cuts).alias("block", "v"))
               .groupBy("key", "block").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("_p")))
    none = F.array().cast("array<double>")

    def fold(values):  # a missing end of a shorter vector counts as 0
        return F.aggregate("_p", none, lambda acc, p: F.zip_with(
            acc, F.transform(F.coalesce(p["v"], none), lambda v: values(v, p["c"])),
            lambda a, v: F.coalesce(a, F.lit(0.0)) + F.coalesce(v, F.lit(0.0))))
    folded = fold(lambda v, c: v.cast("double") * wmap[c])
    if partial:
        held = F.zip_with(fold(lambda v, c: F.lit(1.0)), fold(lambda v, c: wmap[c]),
                          lambda n, x: F.when(n < len(checkpoints), x).otherwise(F.lit(1.0)))
        folded = F.zip_with(folded, held, lambda v, x: F.when(x > 0, v / x).otherwise(v))
    summed = parts.select("key", "block", F.transform(folded, lambda x: x.cast("float")).alias("v"))
    if not as_arrays:
        return summed.select("key", "block", F.posexplode("v").alias("at", "value")).select(
            "key", (F.col("block") * block + F.col("at")).alias("pos"), "value")
    return (summed.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("block", "v"))).alias("_a"))
                  .select("key", F.flatten(F.col("_a.v")).alias("values")))


def overlay(target: DataFrame, source: DataFrame, mapping: DataFrame) -> DataFrame:
    """JOIN4: for every ``(target_key, source_key)`` in ``mapping`` the target row takes the
    source row's values; other target rows stay. A mapping that names a missing source
    key is an error, as in the reference."""
    n_map = mapping.count()
    m = F.broadcast(mapping) if n_map <= BROADCAST_ROWS else mapping
    src = source.select(F.col("key").alias("source_key"), F.col("values").alias("_src_values"))
    mapped = m.join(src, "source_key", "left")
    if mapped.filter(F.col("_src_values").isNull()).limit(1).count():
        raise KeyError("mapping names a key the source does not have")
    mapped = mapped.select(F.col("target_key").alias("key"), "_src_values")
    return (target.join(mapped, "key", "left")
                  .select("key", F.coalesce("_src_values", "values").alias("values"),
                          F.col("_src_values").isNotNull().alias("overwritten")))
