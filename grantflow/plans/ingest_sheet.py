"""Workbooks -> parsed rows -> bill on the prepared row."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.frames import stored
from grantflow.functions.keys import key_problem
from grantflow.operators.freshness import latest_per_key
from grantflow.operators.metrics import samples, union_samples
from grantflow.operators.sheet import file_errors, parse_sheet
from grantflow.operators.upsert import feed_rows, upsert_delta
from grantflow.records import sheet_spec
from grantflow.sources import items, landing
from grantflow.sources.workbooks import read_sheet_cells


def bill_updates(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(one bill per grant, rejects): the last row of the last file wins."""
    keyed = rows.select(
        F.col("grant_id").cast("string").alias("grant_id"), F.col("bill").alias("Bill"),
        "file", "row_idx",
    )
    reason = F.coalesce(
        key_problem(F.col("grant_id")), F.when(F.col("Bill") == "", "missing_bill")
    )
    keyed = keyed.withColumn("reason", reason)
    good = latest_per_key(
        keyed.where("reason IS NULL"), "grant_id", F.desc("file"), F.desc("row_idx")
    )
    return good.select("grant_id", "Bill"), keyed.where("reason IS NOT NULL")


def ingest_sheet(
    spark: SparkSession, workbooks: str, root: str, work: str, run_id: str,
    batch_millis: int, version: int | None = None,
) -> dict[str, DataFrame]:
    start = items.next_version(spark, root, version)
    # the cells are written once: a workbook is decoded a single time
    cells = stored(read_sheet_cells(spark, workbooks), f"{work}/{run_id}/cells")
    rows, cell_errors = parse_sheet(cells)
    updates, rejects = bill_updates(rows)

    previous = items.read_snapshot(spark, root, prefixes=items.prefixes_of(updates), last=start[0])
    previous = items.empty_prepared(spark) if previous is None else previous.drop("id_prefix")
    changed = upsert_delta(previous, updates, sheet_spec(), F.lit(batch_millis), images=True)
    items.write_delta(feed_rows(changed, previous.columns), root, writer=run_id, start=start)

    place = F.concat_ws(":", "file", "row_idx").alias("seq")
    dead = rejects.select(F.col("grant_id").alias("key"), place, "reason", F.col("Bill").alias("payload"))
    unread = file_errors(cells).select(
        F.lit(None).cast("string").alias("key"), F.col("file").alias("seq"),
        F.lit("unreadable_workbook").alias("reason"), F.col("error").alias("payload"),
    )
    landing.write_quarantine(dead.unionByName(unread), run_id, "split_sheet", f"{root}/_quarantine")

    at = F.timestamp_millis(F.lit(batch_millis))
    by_target = cell_errors.groupBy("target").agg(F.count(F.lit(1)).alias("n"))
    row_counts = cells.where("error IS NULL").groupBy("file").agg(
        (F.max("row_idx") + 1).alias("n")
    )
    measured = union_samples(
        samples(by_target, "split_sheet", at, F.lit("spreadsheet.cell_parsing_errors"),
                F.col("n"), {"target": F.col("target")}),
        samples(row_counts, "split_sheet", at, F.lit("spreadsheet.row_count"), F.col("n")),
    )
    measured.write.mode("overwrite").json(f"{root}/_metrics/run_id={run_id}/step=split_sheet")
    return {"rows": rows, "cell_errors": cell_errors, "samples": measured}
