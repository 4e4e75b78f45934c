"""Sampling, limits, splits and dataset combination.

LIM1/LIM3 seeded shuffle + first n, LIM2 absolute slice, LIM4 exact train/eval split,
LIM5 attribute sampling, LIM6 Beta(2,3) shift, AGG7/AGG8 adaptive attribute ratios,
SET1 concatenation, SET2 interleave, SET3 sweep.

All randomness is the portable hash of ``parlance.functions.random``: a row's draw
depends on (seed, key, tag) only, so reruns, retries and other engines agree.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.functions.random import beta_2_3, bernoulli, uniform
from parlance.operators.ranks import BROADCAST_ROWS, with_position

# Top-k stays a bounded per-task heap (TakeOrderedAndProject) up to this many rows;
# beyond it, positions are assigned by the distributed range-rank.
TOPK_ROWS = 100_000


def shuffled_head(df: DataFrame, key: str, n: int | None, seed: int) -> DataFrame:
    """LIM1/LIM3: seeded shuffle, then the first ``n`` rows (0 or None = all)."""
    u = uniform(seed, F.col(key))
    if not n:
        return df
    if n <= TOPK_ROWS:
        return df.withColumn("_u", u).orderBy("_u", key).limit(n).drop("_u")
    return (with_position(df.withColumn("_u", u), ["_u", key], name="_p")
            .filter(F.col("_p") < n).drop("_u", "_p"))


def absolute_slice(df: DataFrame, key: str, start: int | None, stop: int | None) -> DataFrame:
    """LIM2: rows ``[start, stop)`` of the table in ``key`` order (skip, then take)."""
    a = start or 0
    pos = with_position(df, [key], name="_p")
    cond = F.col("_p") >= a
    if stop is not None:
        cond = cond & (F.col("_p") < stop)
    return pos.filter(cond).drop("_p")


def train_eval_split(df: DataFrame, key: str, eval_fraction: float, seed: int = 745) -> DataFrame:
    """LIM4: exact-size random split; adds ``split`` in {train, eval}.

    ``ceil(f * n)`` rows go to eval: the first ones in seeded-hash order.
    """
    if not 0 < eval_fraction < 1:
        raise ValueError("validation split size must be strictly between 0 and 1")
    n = df.count()
    n_eval = math.ceil(eval_fraction * n)
    pos = with_position(df.withColumn("_u", uniform(seed, F.col(key))), ["_u", key], name="_p")
    return (pos.withColumn("split", F.when(F.col("_p") < n_eval, F.lit("eval")).otherwise(F.lit("train")))
               .drop("_u", "_p"))


def random_split(df: DataFrame, key: str, eval_fraction: float, seed: int = 745) -> DataFrame:
    """LIM4 when the size need not be exact: one pass, no ranking."""
    return df.withColumn("split", F.when(uniform(seed, F.col(key), F.lit("split")) < eval_fraction, "eval")
                                   .otherwise("train"))


MAX_SHIFTED_END = 29.6  # fixed value: shifted audio must end before this many seconds


def shift_seconds(duration: Column, key: Column, seed: int = 998) -> Column:
    """LIM6: Beta(2,3) * room, in hundredths (half-even), only when there is room below
    29.6 s; else 0."""
    room = F.lit(MAX_SHIFTED_END) - duration
    return F.when(room > 0, F.rint(beta_2_3(seed, key) * room * 100) / 100).otherwise(F.lit(0.0))


def attribute_draws(key: Column, probs: dict[str, Column | float], seed: int = 998) -> dict[str, Column]:
    """LIM5: one seeded Bernoulli draw per attribute."""
    return {name: bernoulli(seed, key, name, p) for name, p in probs.items()}


# ---- AGG7: adaptive ratio estimation ----------------------------------------------------

def _betacf(a, b, x, iters=300):
    """Continued fraction for the regularised incomplete beta (vectorised modified
    Lentz); converged elements leave the working set."""
    tiny = 1e-300
    a, b, x = (np.asarray(v, dtype=float).copy() for v in (a, b, x))
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c = np.ones_like(x)
    d = 1.0 - qab * x / qap
    d = np.where(np.abs(d) < tiny, tiny, d)
    d = 1.0 / d
    h = d.copy()
    out = h.copy()
    idx = np.arange(len(x))
    for m in range(1, iters + 1):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        h = h * d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = np.where(np.abs(d) < tiny, tiny, d)
        c = 1.0 + aa / c
        c = np.where(np.abs(c) < tiny, tiny, c)
        d = 1.0 / d
        delta = d * c
        h = h * delta
        out[idx] = h
        keep = np.abs(delta - 1.0) >= 3e-16
        if not keep.any():
            break
        if not keep.all():
            idx, a, b, x, qab, qap, qam, c, d, h = (v[keep] for v in (idx, a, b, x, qab, qap, qam, c, d, h))
    return out


def _log_beta(a, b):
    from math import lgamma
    lg = np.vectorize(lgamma, otypes=[float])
    return lg(a) + lg(b) - lg(a + b)


def beta_cdf(x, a, b, log_beta=None):
    """Regularised incomplete beta I_x(a, b), numpy-vectorised."""
    x = np.clip(np.asarray(x, dtype=float), 0.0, 1.0)
    a = np.asarray(a, dtype=float)
    b = np.asarray(b, dtype=float)
    lb = _log_beta(a, b) if log_beta is None else log_beta
    with np.errstate(divide="ignore", invalid="ignore"):
        lbt = -lb + a * np.log(np.where(x > 0, x, 1.0)) + b * np.log(np.where(x < 1, 1 - x, 1.0))
        bt = np.where((x == 0) | (x == 1), 0.0, np.exp(lbt))
        use_direct = x < (a + 1.0) / (a + b + 2.0)
        xa = np.where(use_direct, x, 1 - x)
        aa = np.where(use_direct, a, b)
        bb = np.where(use_direct, b, a)
        cf = _betacf(aa, bb, np.where((xa > 0) & (xa < 1), xa, 0.5))
        direct = bt * cf / aa
        res = np.where(use_direct, direct, 1.0 - direct)
    return np.where(x <= 0, 0.0, np.where(x >= 1, 1.0, res))


def beta_ppf(q, a, b, iters=60, tol=1e-14):
    """Quantile of Beta(a, b): Newton steps on the CDF from the normal approximation,
    kept inside a shrinking bracket (bisection whenever Newton would leave it);
    converged elements leave the working set."""
    from statistics import NormalDist
    a = np.asarray(a, dtype=float)
    b = np.asarray(b, dtype=float)
    out = np.empty_like(a)
    lb = _log_beta(a, b)
    mean = a / (a + b)
    sd = np.sqrt(a * b / ((a + b) ** 2 * (a + b + 1)))
    x = np.clip(mean + NormalDist().inv_cdf(float(q)) * sd, 1e-12, 1 - 1e-12)
    lo, hi = np.zeros_like(a), np.ones_like(a)
    idx = np.arange(len(a))
    for _ in range(iters):
        f = beta_cdf(x, a, b, lb) - q
        lo = np.where(f < 0, x, lo)
        hi = np.where(f < 0, hi, x)
        with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
            pdf = np.exp((a - 1) * np.log(x) + (b - 1) * np.log1p(-x) - lb)
            nx = x - np.where(pdf > 0, f / pdf, np.inf)
        bad = ~np.isfinite(nx) | (nx <= lo) | (nx >= hi)
        nx = np.where(bad, (lo + hi) / 2, nx)
        out[idx] = nx
        keep = (np.abs(nx - x) >= tol) & (hi - lo >= tol)
        if not keep.any():
            break
        idx, a, b, lb, lo, hi, x = (v[keep] for v in (idx, a, b, lb, lo, hi, nx))
    return out


def interval_width(n: np.ndarray, pos: np.ndarray, confidence: float = 0.95) -> np.ndarray:
    """Width of the central ``confidence`` interval of Beta(1 + pos, 1 + n - pos)."""
    a = 1.0 + pos
    b = 1.0 + (n - pos)
    t = (1 - confidence) / 2
    return beta_ppf(1 - t, a, b) - beta_ppf(t, a, b)


@F.pandas_udf(T.DoubleType())
def _width_udf(n: pd.Series, pos: pd.Series) -> pd.Series:
    return pd.Series(interval_width(n.to_numpy(dtype=float), pos.to_numpy(dtype=float)))


def estimate_ratios(df: DataFrame, key: str, discriminators: dict[str, Column], max_rows: int = 4000,
                    target_width: float = 0.05) -> DataFrame:
    """AGG7: positives per attribute over the ordered sample, stopping at the first row
    where every attribute's 95% Beta interval is narrower than ``target_width`` (or
    ``max_rows`` rows). Output: attribute, samples, positives, estimated_ratio.

    The scan never reads past ``max_rows`` rows: a bounded top-k by key feeds a window
    over at most ``max_rows`` rows.
    """
    sample = df.select(key, *[F.coalesce(c, F.lit(False)).cast("int").alias(f"_a_{i}")
                              for i, c in enumerate(discriminators.values())])
    sample = sample.orderBy(key).limit(max_rows)
    w = Window.orderBy(key).rowsBetween(Window.unboundedPreceding, 0)
    names = list(discriminators)
    cum = sample.select(F.row_number().over(Window.orderBy(key)).alias("n"),
                        *[F.sum(f"_a_{i}").over(w).alias(f"_p_{i}") for i in range(len(names))])
    long = cum.select("n", F.explode(F.array(*[
        F.struct(F.lit(nm).alias("attribute"), F.col(f"_p_{i}").alias("pos")) for i, nm in enumerate(names)]))
        .alias("_x")).select("n", "_x.attribute", "_x.pos")
    long = long.withColumn("done", (_width_udf(F.col("n"), F.col("pos")) < target_width) | (F.col("n") >= max_rows))
    # one pass over the bounded sample (<= max_rows x attributes rows): windows, no re-evaluation
    by_attr = Window.partitionBy("attribute")
    everything = Window.partitionBy(F.lit(0))
    long = (long.withColumn("_fd", F.min(F.when(F.col("done"), F.col("n"))).over(by_attr))
                .withColumn("_last", F.max("n").over(everything))
                .withColumn("_open", F.max(F.col("_fd").isNull().cast("int")).over(everything))
                .withColumn("_stop", F.when(F.col("_open") == 1, F.col("_last")).otherwise(F.max("_fd").over(everything))))
    at = long.filter(F.col("n") == F.col("_stop")).select(
        "attribute", F.col("n").cast("bigint").alias("samples"), F.col("pos").cast("bigint").alias("positives"))
    return at.withColumn("estimated_ratio", F.round(F.col("positives") / F.col("samples"), 6))


def relative_ratio(prob: float, ratio: Column) -> Column:
    """AGG8: min(1, prob / ratio); 1.0 when the ratio is 0."""
    return F.when(ratio > 0, F.least(F.lit(1.0), F.lit(float(prob)) / ratio)).otherwise(F.lit(1.0))


# ---- SET1-SET3 -------------------------------------------------------------------------

def concatenate(frames: list[DataFrame]) -> DataFrame:
    """SET1: bag union by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


#: Steps of the seeded draw stream that are numbered together.
DRAW_BLOCK = 1 << 16
#: Datasets up to which a draw is compiled as a chain of conditions, which is the faster form.
WHEN_CHAIN = 50
#: Times that one row of a small dataset is repeated inside one task.
REPEATS = 1 << 12


def interleave(spark: SparkSession, frames: dict[str, DataFrame], key: str,
               probabilities: list[float] | None = None, seed: int = 745) -> DataFrame:
    """SET2: interleave datasets until every one is exhausted (oversampling the rest).

    Step t picks a source (round-robin without probabilities, else by a seeded draw
    against cumulative probabilities); the c-th draw of source s takes its row
    ``(c - 1) mod len_s`` in ``key`` order. Output has ``source``, ``step`` and the
    source's columns. A single dataset is returned untouched.
    """
    names = list(frames)
    if len(names) == 1:
        return frames[names[0]]
    _check_probabilities(probabilities, len(names))
    rows = concatenate([frames[nm].withColumn("source", F.lit(nm).cast("string")).withColumn("_src", F.lit(i))
                        for i, nm in enumerate(names)])
    sizes = rows.groupBy("_src").agg(F.count(F.lit(1)).alias("_len"))
    if sizes.count() < len(names):
        raise ValueError("cannot interleave an empty dataset")
    return _interleaved(rows, sizes, len(names), key, probabilities, seed)


def interleave_groups(df: DataFrame, group_col: str, key: str,
                      weigh: Callable[[int], list[float]] | None = None, seed: int = 745) -> DataFrame:
    """SET2 with one dataset per value of ``group_col``, in value order, null last; ``weigh(k)`` gives
    the probabilities of k datasets. Output: ``step``, ``source`` (the value) and the other columns.
    The number of jobs does not depend on the number of datasets; with one dataset ``step`` is the
    position in ``key`` order, and without rows there is none.
    """
    number = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("_value").asc_nulls_last()))  # a row per dataset
    sizes = (df.groupBy(F.col(group_col).alias("_value")).agg(F.count(F.lit(1)).alias("_len"))
             .withColumn("_src", number - 1))
    k = sizes.count()
    probabilities = weigh(k) if weigh and k > 1 else None
    _check_probabilities(probabilities, k)
    src = sizes.select("_src", "_value")
    rows = df.join(_small(src, k), df[group_col].eqNullSafe(src["_value"])).drop(group_col).withColumnRenamed("_value", "source")
    return _interleaved(rows, sizes.select("_src", "_len"), k, key, probabilities, seed)


def _check_probabilities(probabilities: list[float] | None, k: int) -> None:
    if probabilities is not None:
        if len(probabilities) != k:
            raise ValueError("number of probabilities must match number of datasets")
        if any(p <= 0 for p in probabilities):
            raise ValueError("probabilities must be positive")


def _small(df: DataFrame, rows: int) -> DataFrame:
    """Broadcast below the bound of ``ranks``; ``rows`` is counted, not guessed."""
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def _interleaved(rows: DataFrame, sizes: DataFrame, k: int, key: str, probabilities: list[float] | None, seed: int) -> DataFrame:
    """The draws of the k datasets of ``rows`` (``_src``), whose lengths are ``sizes``."""
    placed = with_position(rows, [key], partition_cols=["_src"], name="_row").join(_small(sizes, k), "_src")
    if probabilities is None or k < 2:
        # draw c of source s is step c * k + s, so a row knows its own steps
        stop = sizes.agg(F.max((F.col("_len") - 1) * k + F.col("_src"))).first()[0]
        last = F.floor((F.lit(stop).cast("bigint") - F.col("_src")) / k)
        return _repeated(placed, last).withColumn("step", F.col("_draw") * k + F.col("_src")).drop("_src", "_len", "_row", "_draw")
    total = sum(probabilities)
    shares, bounds, acc = [p / total for p in probabilities], [], 0.0
    for p in shares[:-1]:
        acc += p
        bounds.append(acc)

    def pick(step: Column) -> Column:
        u = uniform(seed, step, F.lit("interleave"))
        if k > WHEN_CHAIN:
            return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b <= u))
        out = F.lit(k - 1)
        for i in reversed(range(k - 1)):
            out = F.when(u < bounds[i], F.lit(i)).otherwise(out)
        return out

    share = F.element_at(F.array(*map(F.lit, shares)), F.col("_src") + 1)
    steps = int(math.ceil(2 * sizes.agg(F.max(F.col("_len") / share)).first()[0])) + 100
    while True:
        upto, stop = _stop(rows.sparkSession, steps, pick, sizes, k)
        if stop is not None:
            break
        steps *= 2  # a source was not exhausted: the longer stream begins with the same draws
    drawn = _draws(rows.sparkSession.range(stop + 1).withColumnRenamed("id", "step"), pick).join(upto, ["_block", "_src"])
    drawn = drawn.join(_small(sizes, k), "_src").select(
        "step", "_src", ((F.col("_before") + F.col("_nth")) % F.col("_len")).alias("_row"))
    return drawn.join(placed.drop("_len"), ["_src", "_row"]).drop("_src", "_row")


def _draws(steps: DataFrame, pick: Callable[[Column], Column]) -> DataFrame:
    """Source of each step and its number among the draws of that source in its block."""
    src = steps.withColumn("_src", pick(F.col("step"))).withColumn("_block", F.floor(F.col("step") / DRAW_BLOCK))
    return src.withColumn("_nth", F.row_number().over(Window.partitionBy("_block", "_src").orderBy("step")) - 1)


def _stop(spark: SparkSession, steps: int, pick: Callable[[Column], Column], sizes: DataFrame, k: int) -> tuple[DataFrame, int | None]:
    """Draws of each source before each block, and the step at which the last source is exhausted
    (None where ``steps`` do not suffice). Only the blocks in which a source ends are numbered."""
    counted = (spark.range(steps).withColumnRenamed("id", "step")
               .groupBy(F.floor(F.col("step") / DRAW_BLOCK).alias("_block"), pick(F.col("step")).alias("_src"))
               .agg(F.count(F.lit(1)).alias("_n")))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_src").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    upto = counted.withColumn("_before", before)
    need = F.col("_len") - 1
    ends = (upto.join(_small(sizes, k), "_src").where((F.col("_before") <= need) & (need < F.col("_before") + F.col("_n")))
            .select("_block", "_src", (need - F.col("_before")).alias("_nth")))
    inside = ends.select("_block").distinct().select(F.explode(F.sequence(
        F.col("_block") * DRAW_BLOCK, F.least(F.lit(steps), (F.col("_block") + 1) * DRAW_BLOCK) - 1)).alias("step"))
    at = _draws(inside, pick).join(ends, ["_block", "_src", "_nth"])
    found, stop = at.agg(F.count(F.lit(1)), F.max("step")).first()
    return upto.select("_block", "_src", "_before"), stop if found == k else None


def _repeated(placed: DataFrame, last: Column) -> DataFrame:
    """Every draw ``_row``, ``_row + _len``, ... up to ``last``. A row that is drawn more than ``REPEATS``
    times is first dealt out in parts over the tasks, so a tiny dataset beside a large one is no hot row."""
    rows = placed.withColumn("_last", last).where(F.col("_row") <= F.col("_last"))
    hop = F.col("_len") * REPEATS
    few = rows.where(F.col("_last") - F.col("_row") < hop).withColumn("_from", F.col("_row"))
    many = (rows.where(F.col("_last") - F.col("_row") >= hop)
            .withColumn("_from", F.explode(F.sequence(F.col("_row"), F.col("_last"), hop)))
            .repartition("_src", "_row", "_from"))
    end = F.least(F.col("_last"), F.col("_from") + hop - 1)
    return few.unionByName(many).withColumn("_draw", F.explode(F.sequence("_from", end, "_len"))).drop("_last", "_from")
