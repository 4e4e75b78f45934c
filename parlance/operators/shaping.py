"""Column shaping: feature validation (PRJ6), declared-schema cast (PRJ7), stable row
ids (PRJ8), pairing by id (JOIN2), output ordering (SRT1)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parlance.operators.ranks import with_position


def validate_features(df: DataFrame, required: dict[str, type], optional: tuple[str, ...] = ("has_timestamps",
                                                                                              "has_prev")) -> list[str]:
    """PRJ6: required columns must exist with the given Spark type class; a ``has_prev``
    column needs ``prev_transcript``. Returns notes for absent optional columns (which
    are then taken as false)."""
    fields = {f.name: f.dataType for f in df.schema.fields}
    for name, typ in required.items():
        if name not in fields:
            raise ValueError(f"column {name!r} is missing")
        if not isinstance(fields[name], typ):
            raise ValueError(f"column {name!r} is {fields[name].simpleString()}, {typ.__name__} is needed")
    notes = [f"column {o!r} is absent and read as false" for o in optional if o not in fields]
    if "has_prev" in fields and "prev_transcript" not in fields:
        raise ValueError("has_prev is there without the prev_transcript column that it speaks of")
    return notes


def cast_to(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ7: reorder, project and cast to a declared schema (errors on incompatible
    columns, missing nullable columns become null)."""
    cols = []
    have = set(df.columns)
    for f in schema.fields:
        cols.append((F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def with_row_id(df: DataFrame, order_cols: list[str], name: str = "id") -> DataFrame:
    """PRJ8: 0-based id equal to the row's position in an explicit total order
    (distributed ranking; never ``monotonically_increasing_id`` for output)."""
    return with_position(df, order_cols, name=name)


def pair_by_id(refs: DataFrame, preds: DataFrame, id_cols: list[str]) -> DataFrame:
    """JOIN2: each reference with its prediction (inner equi-join on the id)."""
    return refs.join(preds, id_cols, "inner")


def ordered_by_id(df: DataFrame, id_col: str = "id") -> DataFrame:
    """SRT1: results in id order (a range-partitioned global sort)."""
    return df.orderBy(id_col)


EXAMPLE_SCHEMA = T.StructType([
    T.StructField("transcript", T.StringType()),
    T.StructField("has_prev", T.BooleanType()),
    T.StructField("has_timestamps", T.BooleanType()),
    T.StructField("prev_transcript", T.StringType()),
    T.StructField("metadata", T.StructType([
        T.StructField("seek", T.FloatType()), T.StructField("duration", T.FloatType()),
        T.StructField("source", T.StringType()), T.StructField("entry_id", T.StringType()),
        T.StructField("quality_score", T.FloatType())])),
])
