"""How the queries see the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as signals: a case per user, a track per event type."""
    e = table(spark, sf_dir, "events")
    seconds = F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(1e6)
    return e.select(F.col("user_id").alias("caseid"), seconds.alias("time_sec"), F.col("event_type").alias("track"), "value", F.col("event_id").alias("ord"))


#: The same view in SQL.
SIGNALS_SQL = "signals AS (SELECT user_id AS caseid, epoch_us(ts) / 1e6 AS time_sec, event_type AS track, value, event_id AS ord FROM events)"
HOUR = 3600.0
DAY = 86400.0
START = 1704067200.0
