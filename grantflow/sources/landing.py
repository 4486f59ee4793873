"""Sinks partitioned by landing date, by id prefix and by run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.functions.keys import id_prefix


def write_landing(df: DataFrame, day: Column, source: Column, path: str) -> None:
    """Rows under ``dt=<day>/source=<name>``; the day is taken as given, never moved to UTC."""
    (
        df.withColumn("dt", day.cast("date")).withColumn("source", source)
        .hint("rebalance", "dt", "source")
        .write.mode("append").partitionBy("dt", "source").parquet(path)
    )


def write_prepared(df: DataFrame, key: str, source: Column, path: str) -> None:
    """Objects under ``id_prefix=<3 chars>/source=<name>``; a hot prefix is split over tasks."""
    (
        df.withColumn("id_prefix", id_prefix(F.col(key))).withColumn("source", source)
        .hint("rebalance", "id_prefix", "source")
        .write.mode("overwrite").partitionBy("id_prefix", "source").parquet(path)
    )


def write_quarantine(df: DataFrame, run_id: str, step: str, path: str) -> None:
    """Dead letters: (run_id, step, key, seq, reason, payload). A run that is repeated replaces its own."""
    (
        df.select(
            F.col("key").cast("string"), F.col("seq").cast("string"), "reason", "payload",
            F.current_timestamp().alias("written_at"),
        )
        .write.mode("overwrite").parquet(f"{path}/run_id={run_id}/step={step}")
    )


def retained(quarantine: DataFrame, now: Column, days: int = 14) -> DataFrame:
    """Dead letters still inside the retention period."""
    return quarantine.where(F.col("written_at") > now - F.expr(f"INTERVAL {days} DAYS"))
