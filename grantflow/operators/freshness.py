"""Is an incoming record new, newer or stale? (lookup of the stored date by key)"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from grantflow.functions.dates import is_set, text_date
from grantflow.operators.skew import lookup_join
from grantflow.records import RecordSpec


def freshness(
    incoming: DataFrame,
    index: DataFrame,
    spec: RecordSpec,
    hot: DataFrame | None = None,
    stored_date: str | None = None,
) -> DataFrame:
    """Adds ``outcome`` (created, updated, skipped, failed) and ``reason`` to every record.

    ``index`` is unique on the key; only the key and the stored date text are read from it. An
    older or equal date never overwrites, so late records are skipped.
    """
    stored = F.col("_stored")
    slim = index.select(spec.key, F.col(stored_date or spec.date_col).alias("_stored"))
    out = lookup_join(incoming, slim, spec.key, "left", hot)
    own_day = text_date(F.col(spec.date_col), spec.date_format)
    stored_day = text_date(stored, spec.date_format)
    reason = (
        F.when(own_day.isNull(), "bad_date")
        .when(is_set(stored) & stored_day.isNull(), "bad_stored_date")
    )
    out = out.withColumn("reason", reason)
    outcome = (
        F.when(F.col("reason").isNotNull(), "failed")
        .when(~is_set(stored), "created")
        .when(stored_day >= own_day, "skipped")
        .otherwise("updated")
    )
    return out.withColumn("outcome", outcome).drop("_stored")


def outcome_counts(judged: DataFrame, *by: str) -> DataFrame:
    return judged.groupBy(*by, "outcome").agg(F.count(F.lit(1)).alias("records"))


def latest_per_key(df: DataFrame, key: str, *newest_first) -> DataFrame:
    """One record per key: the first in the given order.

    ``row_number() = 1`` lets Spark keep one row per key in each task before the shuffle, so a
    hot key costs one row per task, not all of its rows in one task.
    """
    order = Window.partitionBy(key).orderBy(*newest_first)
    return df.withColumn("_rn", F.row_number().over(order)).where("_rn = 1").drop("_rn")


def newest_record_order(spec: RecordSpec, *place: str) -> list:
    """Newest date, then synopsis before forecast, then last in document order."""
    day = text_date(F.col(spec.date_col), spec.date_format)
    return [F.desc_nulls_last(day), F.asc("is_forecast"), *[F.desc(p) for p in place]]


def error_summary(rejects: DataFrame, *by: str) -> DataFrame:
    """Errors counted by kind and reason; the reasons are a fixed vocabulary."""
    return rejects.groupBy(*by, "kind", "reason").agg(F.count(F.lit(1)).alias("errors"))
