"""Alerts over run metrics.

Every alert first sums into time buckets, so what is windowed or joined grows with time and the
number of steps, not with the number of samples.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# How long a window is left to settle, and the windows of the alerts.
EVALUATION_DELAY_SECONDS = 900
RATIO_WINDOW = "10 hours"
SUM_WINDOW = "1 hour"
STALE_WINDOW = "4 days"


def _recent(ts: Column, now: Column, width: str, delay: int) -> Column:
    end = now - F.expr(f"INTERVAL {delay} SECONDS")
    return (ts > end - F.expr(f"INTERVAL {width}")) & (ts <= end)


def alert_ratio(
    df: DataFrame, now: Column, part: Column, whole: Column, by: str = "step",
    width: str = RATIO_WINDOW, threshold: float = 1.0, delay: int = EVALUATION_DELAY_SECONDS,
    ts: str = "ts",
) -> DataFrame:
    """Ratio of two sums over the trailing window; no denominator, no alert."""
    sums = df.where(_recent(F.col(ts), now, width, delay)).groupBy(by).agg(
        F.sum(part).alias("part"), F.sum(whole).alias("whole")
    )
    ratio = F.try_divide("part", "whole")
    return sums.withColumn("ratio", ratio).withColumn(
        "alert", F.coalesce(ratio >= threshold, F.lit(False))
    )


def ratio_history(
    df: DataFrame, part: Column, whole: Column, by: str, hours: int = 10,
    bucket_seconds: int = 60, threshold: float = 1.0, ts: str = "ts",
) -> DataFrame:
    """The ratio alert evaluated at every bucket: sums of the buckets of the last ``hours``."""
    epoch = F.unix_micros(F.col(ts).cast("timestamp")) / 1_000_000
    bucket = F.floor(epoch / bucket_seconds).cast("bigint")
    sums = df.groupBy(by, bucket.alias("bucket")).agg(
        F.sum(part).alias("_part"), F.sum(whole).alias("_whole")
    )
    span = hours * 3600 // bucket_seconds
    trailing = Window.partitionBy(by).orderBy("bucket").rangeBetween(-(span - 1), 0)
    out = sums.select(
        by, "bucket", F.sum("_part").over(trailing).alias("part"),
        F.sum("_whole").over(trailing).alias("whole"),
    )
    ratio = F.try_divide("part", "whole")
    return out.withColumn("alert", F.coalesce(ratio >= threshold, F.lit(False)))


def alert_sum(
    df: DataFrame, now: Column, value: Column, by: str = "step", width: str = SUM_WINDOW,
    threshold: float = 0, delay: int = EVALUATION_DELAY_SECONDS, ts: str = "ts",
) -> DataFrame:
    """Trailing sum above the threshold."""
    sums = df.where(_recent(F.col(ts), now, width, delay)).groupBy(by).agg(
        F.sum(value).alias("total")
    )
    return sums.withColumn("alert", F.col("total") > threshold)


def alert_stale(
    df: DataFrame, subjects: DataFrame, now: Column, value: Column, by: str = "step",
    width: str = STALE_WINDOW, minimum: float = 1, delay: int = EVALUATION_DELAY_SECONDS,
    ts: str = "ts",
) -> DataFrame:
    """Subjects that produced less than the minimum; one without samples counts as 0."""
    sums = df.where(_recent(F.col(ts), now, width, delay)).groupBy(by).agg(
        F.sum(value).alias("total")
    )
    out = subjects.join(sums, by, "left").withColumn("total", F.coalesce("total", F.lit(0)))
    return out.withColumn("alert", F.col("total") < minimum)


def alert_depth(
    df: DataFrame, value: Column, by: dict[str, Column] | None = None, ts: str = "ts"
) -> DataFrame:
    """Queue depth: average per minute, smallest minute per hour, alert above 0."""
    by = by or {}
    minutes = df.groupBy(
        F.date_trunc("minute", ts).alias("minute"), *[c.alias(n) for n, c in by.items()]
    ).agg(F.avg(value).alias("_avg"))
    hours = minutes.groupBy(F.date_trunc("hour", "minute").alias("hour"), *by).agg(
        F.min("_avg").alias("depth")
    )
    return hours.withColumn("alert", F.col("depth") > 0)
