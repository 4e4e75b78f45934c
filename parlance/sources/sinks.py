"""Sinks: dataset with splits (SNK1, SNK3), evaluation rows as CSV (SNK2), per-split
counts (SNK4), reuse of finished work (SNK5 / JOIN5) and results written in batches that may
be written twice (SNK5, STR6)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_dataset(df: DataFrame, path: str, split_col: str | None = "split", mode: str = "overwrite") -> None:
    """SNK1/SNK3: parquet, partitioned by split when there is one."""
    w = df.write.mode(mode)
    if split_col and split_col in df.columns:
        w = w.partitionBy(split_col)
    w.parquet(path)


def split_counts(df: DataFrame, split_col: str = "split") -> DataFrame:
    """SNK4: rows per split."""
    return df.groupBy(split_col).agg(F.count(F.lit(1)).alias("n_rows"))


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """SNK2: evaluation rows as CSV with a header; nested columns are written as JSON text."""
    flat = df.select(*[F.to_json(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name)
                       for f in df.schema.fields])
    flat.write.mode(mode).option("header", "true").option("emptyValue", "").option("escape", '"').csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Read evaluation rows back with an explicit schema (no inference). Texts may hold
    line breaks, so records are parsed multi-line (one task per written file)."""
    return (spark.read.option("header", "true").option("multiLine", "true").option("escape", '"')
            .schema(schema).csv(path))


def pending(todo: DataFrame, done: DataFrame | None, key_cols: list[str]) -> DataFrame:
    """SNK5/JOIN5: rows whose key has no finished result yet (``left_anti``)."""
    if done is None:
        return todo
    return todo.join(done.select(*key_cols).distinct(), key_cols, "left_anti")


def existing(spark: SparkSession, path: str, reader=None) -> DataFrame | None:
    """Previously written results, or None when there are none."""
    try:
        return reader(path) if reader else spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


# ---- results in batches ----------------------------------------------------------------

def write_batch(df: DataFrame, path: str, batch: int) -> None:
    """Write ``df`` as batch number ``batch`` of the results at ``path``. A batch that is written
    again, as after a failure, replaces its former rows, so a replay changes nothing."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}")


def batch_writer(path: str) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function of a stream of results: the micro-batch number is the batch."""
    return lambda df, batch: write_batch(df, path, batch)


def latest(spark: SparkSession, path: str, key_cols: list[str]) -> DataFrame | None:
    """One row per key of the results at ``path`` with its ``batch``, the newest one; None where
    nothing is written. Of rows that repeat a key in one batch the one with the largest JSON text
    stays. Rows are combined before they are shuffled; null keys are a key."""
    rows = existing(spark, path)
    if rows is None:
        return None
    rest = [c for c in rows.columns if c not in (*key_cols, "batch")]
    row = F.struct(*[F.col(c) for c in rest], F.col("batch").cast("bigint").alias("batch"))
    rank = F.struct(F.col("batch").cast("bigint"), F.to_json(F.struct(*rest)) if rest else F.lit(""))
    newest = rows.groupBy(*key_cols).agg(F.max_by(row, rank).alias("_row"))
    return newest.select(*key_cols, *[F.col("_row")[c].alias(c) for c in (*rest, "batch")])
