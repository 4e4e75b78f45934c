"""Readers for the parquet test tables (one file per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def ntz_as_utc(spark: SparkSession, c):
    """TIMESTAMP_NTZ wall clock read as UTC -> TIMESTAMP, whatever the session time zone
    (watermarks and session windows need TIMESTAMP)."""
    tz = spark.conf.get("spark.sql.session.timeZone")
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), c).cast("timestamp")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; Catalyst prunes columns and pushes filters into it."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    if name == "events":
        df = df.withColumn("ts", ntz_as_utc(spark, F.col("ts")))
    return df
