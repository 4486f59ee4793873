"""Run metrics: samples, bucketed sums and averages, formulas over them."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Metric names by step.
METRICS = {
    "download_registry": ["source_size"],
    "extract_registry": ["archive.downloaded", "xml.extracted", "xml.uploaded"],
    "split_registry": ["record.created", "record.updated", "record.skipped", "record.failed"],
    "persist_registry": ["record.saved", "record.failed"],
    "receive_mail": ["email.untrusted"],
    "download_sheet": ["source_size"],
    "split_sheet": [
        "opportunity.created", "opportunity.failed", "spreadsheet.row_count",
        "spreadsheet.cell_parsing_errors",
    ],
    "persist_sheet": ["opportunity.saved"],
    "publish_events": [
        "invocation_batch_size", "record.failed", "event.published", "item_image.build",
        "item_image.unbuildable", "item_image.malformatted_field", "grant_data.invalid",
    ],
}


def samples(
    counts: DataFrame, step: str, ts: Column, metric: Column, value: Column,
    tags: dict[str, Column] | None = None,
) -> DataFrame:
    """(ts, step, metric, value, tags) rows from a table of counts."""
    pairs = [x for name, c in (tags or {}).items() for x in (F.lit(name), c.cast("string"))]
    tag_map = F.create_map(*pairs) if pairs else F.map_from_arrays(
        F.array().cast("array<string>"), F.array().cast("array<string>")
    )
    return counts.select(
        ts.cast("timestamp").alias("ts"), F.lit(step).alias("step"), metric.alias("metric"),
        value.cast("double").alias("value"), tag_map.alias("tags"),
    )


def rollup(
    df: DataFrame, width: str, by: dict[str, Column], aggs: dict[str, Column], ts: str = "ts"
) -> DataFrame:
    """Aggregates per time bucket; ``bucket`` is the start of the bucket."""
    bucket = F.window(F.col(ts), width)
    keys = [c.alias(name) for name, c in by.items()]
    out = df.groupBy(bucket.alias("_w"), *keys).agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("_w.start").alias("bucket"), *by, *aggs)


def tag(name: str) -> Column:
    return F.try_element_at(F.col("tags"), F.lit(name))


def sum_where(value: Column, condition: Column) -> Column:
    """Sum over the rows that satisfy the condition; 0 when there are none."""
    return F.coalesce(F.sum(F.when(condition, value)), F.lit(0.0))


def metric_sum(*names: str, value: str = "value", metric: str = "metric") -> Column:
    """Sum of a metric, over all names it has had."""
    return sum_where(F.col(value), F.col(metric).isin(*names))


def formula(
    df: DataFrame, width: str, by: dict[str, Column], terms: dict[str, Column],
    exprs: dict[str, Column], ts: str = "ts",
) -> DataFrame:
    """Arithmetic over per-bucket sums; a series without samples counts as 0."""
    out = rollup(df, width, by, terms, ts)
    return out.select("bucket", *by, *[c.alias(n) for n, c in exprs.items()])


def union_samples(*parts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)
