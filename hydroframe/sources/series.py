"""Measurement series: the driver's tables as device series, and rules every source follows (NaN becomes null)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nan_to_null(df: DataFrame) -> DataFrame:
    """In every float column NaN becomes null: comparisons with a missing value must fail."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (DoubleType, FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats})


def micros(ts: str | Column) -> Column:
    """Microseconds since 1970 of a timestamp column, with or without a zone (taken as UTC)."""
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table as a series: event_id, device, kind, ts, us (microseconds), value, props."""
    df = nan_to_null(table(spark, sf_dir, "events"))
    return df.select("event_id", F.col("user_id").alias("device"), F.col("event_type").alias("kind"), F.col("ts").cast("timestamp").alias("ts"), micros("ts").alias("us"), "value", "props")
