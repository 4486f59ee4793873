"""Purge of prepared data and backfill of old workbooks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.functions.dates import long_date
from grantflow.operators.purge import match_paths, purge_items, purge_matchers
from grantflow.sources import items


class FeedActive(RuntimeError):
    """Purging while changes are being published would publish the purge."""


def purge_table(
    spark: SparkSession, root: str, version: int | None = None, allow_feed: bool = False,
    feed_active: bool = False, dry_run: bool = False, **what: bool,
) -> DataFrame:
    """Write a purged snapshot as the next version; ``dry_run`` only counts. Refused while the feed is active, and where
    ``version`` isn't the next one: a base below a delta would purge nothing that readers see."""
    start = items.next_version(spark, root, None if dry_run else version)
    prepared = items.read_snapshot(spark, root, last=start[0]).drop("id_prefix")
    if dry_run:
        return purge_items(prepared, dry_run=True)
    if feed_active and not allow_feed:
        raise FeedActive("stop publishing first, or pass allow_feed=True")
    items.write_snapshot(purge_items(prepared, **what), root, start=start)
    return items.read_snapshot(spark, root, start[1])


def purge_listing(
    spark: SparkSession, path: str, prefix: str = "", strip: str = "", **what
) -> DataFrame:
    """Objects under ``path`` that a purge would remove; keys are taken below ``strip``."""
    listed = items.list_objects(spark, path)
    keyed = listed.withColumn("key", F.replace("path", F.lit(strip), F.lit("")))
    return match_paths(keyed, purge_matchers(**what), prefix, "key")


def backfill_manifest(
    cells: DataFrame, prefix: str = "sources", suffix: str = "ffis.org/download.xlsx"
) -> tuple[DataFrame, DataFrame]:
    """(source_path, dest_key) oldest first, and workbooks without a readable publish date.

    The date stands in cell N2.
    """
    second_row = cells.where((F.col("row_idx") == 1) & F.col("error").isNull())
    dates = second_row.select("file", long_date(F.get("cells", F.lit(13))).alias("day"))
    files = cells.groupBy("file").agg(F.max("error").alias("error")).join(dates, "file", "left")
    key = F.concat_ws("/", F.lit(prefix), F.date_format("day", "yyyy/MM/dd"), F.lit(suffix))
    manifest = files.where("day IS NOT NULL").select(
        F.col("file").alias("source_path"), key.alias("dest_key")
    )
    reason = F.when(F.col("error").isNotNull(), "unreadable_workbook").otherwise("publish_date")
    rejects = files.where("day IS NULL").select("file", reason.alias("reason"))
    return manifest.orderBy("dest_key", "source_path"), rejects
