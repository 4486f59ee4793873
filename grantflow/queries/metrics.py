"""Events as metric samples: roll-ups, formulas and alerts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.operators import metrics, monitors
from grantflow.queries.base import query, table

_NOW = "2024-01-24 00:15:00"


def _now():
    return F.lit(_NOW).cast("timestamp_ntz")


def _cents():
    """Values as whole numbers, whose sums are exact in any order."""
    return F.round(F.col("value") * 100).cast("bigint")


def _samples(spark: SparkSession, folder: str) -> DataFrame:
    tag = F.create_map(F.lit("k"), F.get_json_object("props", "$.k"))
    return table(spark, folder, "events").select(
        "event_id", "ts", F.col("user_id").alias("step"), F.col("event_type").alias("metric"), "value",
        tag.alias("tags"),
    )


@query("""
SELECT CAST(ts AS DATE) AS day, event_type AS metric, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents,
       avg(CAST(round(value * 100) AS BIGINT)) AS average, count(*) AS samples
FROM events GROUP BY ALL
""")
def metric_rollup(spark, folder):
    out = metrics.rollup(
        _samples(spark, folder), "1 day", {"metric": F.col("metric")},
        {"cents": F.sum(_cents()), "average": F.avg(_cents()), "samples": F.count(F.lit(1))},
    )
    return out.withColumn("day", F.to_date("bucket")).drop("bucket")


@query("""
SELECT date_trunc('hour', ts)::VARCHAR AS hour, props->>'k' AS k, count(*) AS n
FROM events WHERE event_type = 'error' GROUP BY ALL
""")
def metric_by_tag(spark, folder):
    """Errors per hour and tag value."""
    errors = _samples(spark, folder).where("metric = 'error'")
    out = metrics.rollup(errors, "1 hour", {"k": metrics.tag("k")}, {"n": F.count(F.lit(1))})
    return out.select(F.date_format("bucket", "yyyy-MM-dd HH:mm:ss").alias("hour"), "k", "n")


@query("""
SELECT CAST(ts AS DATE) AS day, round(coalesce(sum(CASE WHEN props->>'k' = '7' THEN value END), 0), 2) AS sevens,
       round(coalesce(sum(CASE WHEN props->>'k' <> '7' THEN value END), 0), 2) AS others
FROM events GROUP BY ALL
""")
def metric_filtered(spark, folder):
    """Sums restricted to a tag value."""
    value = F.col("value")
    out = metrics.rollup(_samples(spark, folder), "1 day", {}, {
        "sevens": metrics.sum_where(value, metrics.tag("k") == "7"),
        "others": metrics.sum_where(value, metrics.tag("k") != "7"),
    })
    return out.select(
        F.to_date("bucket").alias("day"), F.round("sevens", 2).alias("sevens"), F.round("others", 2).alias("others")
    )


@query("""
WITH d AS (
  SELECT CAST(ts AS DATE) AS day, count(*) AS total, count_if(event_type = 'error') AS errors,
         count_if(event_type IN ('signup', 'purchase')) AS saved, count_if(event_type = 'absent') AS absent
  FROM events GROUP BY ALL)
SELECT day, CAST(total - errors AS DOUBLE) AS succeeded, CAST(total - errors - saved AS DOUBLE) AS skipped,
       CAST(absent AS DOUBLE) AS absent
FROM d
""")
def metric_formula(spark, folder):
    """succeeded = total - errors; skipped = total - errors - saved under its two names."""
    counted = _samples(spark, folder).withColumn("value", F.lit(1.0))
    out = metrics.formula(
        counted, "1 day", {},
        {
            "total": F.sum("value"), "errors": metrics.metric_sum("error"),
            "saved": metrics.metric_sum("signup", "purchase"), "absent": metrics.metric_sum("absent"),
        },
        {
            "succeeded": F.col("total") - F.col("errors"),
            "skipped": F.col("total") - F.col("errors") - F.col("saved"), "absent": F.col("absent"),
        },
    )
    return out.withColumn("day", F.to_date("bucket")).drop("bucket")


@query("""
WITH b AS (
  SELECT user_id AS step, CAST(floor(epoch(ts) / 60) AS BIGINT) AS bucket,
         count_if(event_type = 'error') AS errors, count_if(event_type = 'view') AS views
  FROM events GROUP BY ALL)
SELECT step, bucket, CAST(sum(errors) OVER w AS BIGINT) AS part, CAST(sum(views) OVER w AS BIGINT) AS whole,
       coalesce(sum(errors) OVER w >= sum(views) OVER w AND sum(views) OVER w > 0, false) AS alert
FROM b WINDOW w AS (PARTITION BY step ORDER BY bucket RANGE BETWEEN 599 PRECEDING AND CURRENT ROW)
""")
def alert_error_ratio(spark, folder):
    """Errors per view over the trailing ten hours, judged at every minute with samples."""
    one = lambda name: F.when(F.col("metric") == name, 1).otherwise(0)
    return monitors.ratio_history(_samples(spark, folder), one("error"), one("view"), "step")


_WINDOW = "ts > TIMESTAMP '2024-01-24 00:00:00' - INTERVAL '{}' AND ts <= TIMESTAMP '2024-01-24 00:00:00'"


@query(f"""
WITH s AS (
  SELECT user_id AS step, count_if(event_type = 'error') AS part, count_if(event_type = 'view') AS whole
  FROM events WHERE {_WINDOW.format('10 hours')} GROUP BY ALL)
SELECT step, CAST(part AS BIGINT) AS part, CAST(whole AS BIGINT) AS whole, whole > 0 AND part >= whole AS alert FROM s
""")
def alert_ratio_now(spark, folder):
    one = lambda name: F.when(F.col("metric") == name, 1).otherwise(0)
    return monitors.alert_ratio(_samples(spark, folder), _now(), one("error"), one("view")).drop("ratio")


@query(f"""
SELECT user_id AS step, count_if(event_type = 'error') AS total, count_if(event_type = 'error') > 0 AS alert
FROM events WHERE {_WINDOW.format('1 hour')} GROUP BY ALL
""")
def alert_sum(spark, folder):
    one = F.when(F.col("metric") == "error", 1).otherwise(0)
    return monitors.alert_sum(_samples(spark, folder), _now(), one)


@query(f"""
WITH u AS (SELECT DISTINCT user_id AS step FROM events),
s AS (SELECT user_id AS step, count(*) AS n FROM events
      WHERE event_type = 'purchase' AND {_WINDOW.format('4 days')} GROUP BY ALL)
SELECT step, coalesce(n, 0) AS total, coalesce(n, 0) < 1 AS alert FROM u LEFT JOIN s USING (step)
""")
def alert_stale(spark, folder):
    """Users without a purchase in four days."""
    rows = _samples(spark, folder)
    bought = F.when(F.col("metric") == "purchase", 1).otherwise(0)
    return monitors.alert_stale(rows, rows.select("step").distinct(), _now(), bought)


@query("""
WITH m AS (
  SELECT date_trunc('minute', ts) AS minute, avg(greatest(CAST(round(value * 100) AS BIGINT) - 500, 0)) AS a FROM events GROUP BY ALL)
SELECT date_trunc('hour', minute)::VARCHAR AS hour, min(a) AS depth, min(a) > 0 AS alert
FROM m GROUP BY ALL
""")
def alert_depth(spark, folder):
    """Average per minute, smallest minute of the hour."""
    depth = F.greatest(_cents() - 500, F.lit(0))
    out = monitors.alert_depth(_samples(spark, folder), depth)
    return out.select(
        F.date_format("hour", "yyyy-MM-dd HH:mm:ss").alias("hour"), "depth", "alert"
    )


@query("""
SELECT 'publish' AS step, 'event.' || event_type AS metric, CAST(count(*) AS DOUBLE) AS value,
       CAST(user_id AS VARCHAR) AS tag
FROM events GROUP BY event_type, user_id
""")
def metric_samples(spark, folder):
    """Counts turned into samples with a tag."""
    counts = table(spark, folder, "events").groupBy("event_type", "user_id").agg(
        F.count(F.lit(1)).alias("n"), F.max("ts").alias("last")
    )
    out = metrics.samples(
        counts, "publish", F.col("last"), F.concat(F.lit("event."), F.col("event_type")), F.col("n"),
        {"user": F.col("user_id")},
    )
    return out.select("step", "metric", "value", metrics.tag("user").alias("tag"))
