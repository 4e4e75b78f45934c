"""Dataset specifications (SRC4, SRC5, SRC6) and the sweep over evaluation sets (SET3).

A dataset here is a parquet table (or folder) whose rows carry a split column; a
spec names the table, a split and optionally an absolute row range, e.g.
``documents:en[100:350]``. Parsing is a few driver-side string operations; the rows are
read and sliced by Spark.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import NamedTuple
from urllib.parse import quote

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parlance.session import delete_path, path_exists

_SPLIT_RANGE = re.compile(r"(?P<name>[^\[\]]+)(?:\[(?P<a>\d*):(?P<b>\d*)\])?")


def _outside_brackets(spec: str) -> list[str]:
    """The parts of ``spec`` between the colons that lie outside square brackets."""
    parts, depth = [""], 0
    for c in spec:
        depth += (c == "[") - (c == "]")
        if c == ":" and depth <= 0:
            parts.append("")
        else:
            parts[-1] += c
    return parts


@dataclass(frozen=True)
class DatasetSpec:
    name: str
    split: str
    start: int | None = None
    stop: int | None = None


def parse_dataset_spec(spec: str, default_split: str = "train") -> DatasetSpec:
    """SRC4: ``name[:split]`` with ``split[a:b]`` absolute slicing; percent units and
    positions counted from the end are rejected."""
    parts = _outside_brackets(spec)
    name = parts[0]
    split = parts[1] if len(parts) == 2 else default_split
    m = _SPLIT_RANGE.fullmatch(split)
    if not m:
        raise ValueError(f"cannot read split {split!r}: a name, or name[a:b] with row numbers, is expected")
    a = int(m.group("a")) if m.group("a") else None
    b = int(m.group("b")) if m.group("b") else None
    return DatasetSpec(name, m.group("name"), a, b)


@dataclass(frozen=True)
class EvalSpec:
    name: str
    split: str
    text_column: str


def parse_eval_spec(spec: str) -> EvalSpec:
    """SRC6: ``name:split:text_column`` with defaults ``test`` and ``text``."""
    parts = spec.split(":")
    return EvalSpec(parts[0], parts[1] if len(parts) > 1 else "test", parts[2] if len(parts) > 2 else "text")


def load_spec(spark: SparkSession, resolve: Callable[[str], DataFrame], spec: str, key: str,
              split_col: str = "split") -> DataFrame:
    """Read a dataset by spec: the split's rows, then rows ``[a, b)`` in ``key`` order."""
    from parlance.operators.sampling import absolute_slice
    s = parse_dataset_spec(spec)
    df = resolve(s.name).filter(F.col(split_col) == F.lit(s.split))
    if s.start is None and s.stop is None:
        return df
    return absolute_slice(df, key, s.start, s.stop)


def read_prepared(spark: SparkSession, path: str, fallback: Callable[[], DataFrame] | None = None) -> DataFrame:
    """SRC5: read a prepared train/eval set (parquet partitioned by ``split``); on a
    missing path use ``fallback`` (the remote copy in the reference)."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if fallback is None or e.getCondition() != "PATH_NOT_FOUND":
            raise
        return fallback()


def sweep(specs: list[str], run_one: Callable[[EvalSpec], DataFrame]) -> DataFrame | None:
    """SET3 as one plan: sets whose analysis fails (missing table or column) are skipped, the
    others are unioned with a ``dataset`` column. One that fails while running fails them all;
    ``run_sweep`` runs each on its own."""
    out = None
    for spec in specs:
        es = parse_eval_spec(spec)
        try:
            df = run_one(es)
            df.schema  # analysis errors (missing table/column) surface here
        except Exception:
            continue
        df = df.withColumn("dataset", F.lit(es.name + ":" + es.split))
        out = df if out is None else out.unionByName(df)
    return out


class Sweep(NamedTuple):
    """``results``: the rows of the sets that could be evaluated with their ``dataset`` (None where
    there are none); ``status``: (spec, dataset, status, n_rows, reason), a row per set."""

    results: DataFrame | None
    status: DataFrame


SWEEP_STATUS = "spec string, dataset string, status string, n_rows bigint, reason string"


def run_sweep(spark: SparkSession, specs: list[str], run_one: Callable[[EvalSpec], DataFrame], path: str,
              overwrite: bool = False) -> Sweep:
    """SET3: evaluate several sets, each by a job of its own that writes below ``path``.

    A set that fails, while its plan is made or while it runs, leaves a reason and the others go on.
    One that an earlier sweep has finished (its folder holds the mark that Spark writes last) is
    ``reused`` unless ``overwrite``; a folder without the mark is an interrupted run and is written anew.
    Specs are listed by their user; nothing but a row per spec is held on the driver.
    """
    status, out = [], None
    for spec in dict.fromkeys(specs):
        es = parse_eval_spec(spec)
        name = f"{es.name}:{es.split}"
        where = f"{path.rstrip('/')}/{quote(spec, safe='')}"
        reused = not overwrite and path_exists(spark, f"{where}/_SUCCESS")
        try:
            if not reused:
                run_one(es).write.mode("overwrite").parquet(where)
            rows = spark.read.parquet(where)
            status.append((spec, name, "reused" if reused else "finished", rows.count(), None))
        except (PySparkException, Py4JJavaError, ValueError) as e:
            delete_path(spark, where)
            status.append((spec, name, "failed", None, _reason(e)))
            continue
        rows = rows.withColumn("dataset", F.lit(name))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return Sweep(out, spark.createDataFrame(status, SWEEP_STATUS))


def _reason(e: Exception) -> str:
    """The error condition, where Spark names one, else the first line of the message."""
    condition = e.getCondition() if isinstance(e, PySparkException) else None
    return condition or f"{type(e).__name__}: {(str(e).splitlines() or [''])[0][:200]}"
