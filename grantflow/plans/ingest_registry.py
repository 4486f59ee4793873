"""Registry extract -> judged records -> new snapshot."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.frames import stored
from grantflow.functions.keys import key_problem
from grantflow.operators.caps import cap_records
from grantflow.operators.freshness import (
    freshness,
    latest_per_key,
    newest_record_order,
    outcome_counts,
)
from grantflow.operators.metrics import samples
from grantflow.operators.upsert import feed_rows, upsert_delta
from grantflow.records import registry_spec
from grantflow.sources import items, landing
from grantflow.sources.registry_xml import parse_all, parse_results, read_chunks

PLACE = ("file", "split", "ord")


def judge(records: DataFrame, index: DataFrame, hot: DataFrame | None = None) -> DataFrame:
    """Freshness outcome, with ids too short for the key layout failed as well."""
    judged = freshness(records, index, registry_spec(), hot)
    short = key_problem(F.col("grant_id"))
    return judged.withColumn("reason", F.coalesce("reason", short)).withColumn(
        "outcome", F.when(short.isNotNull(), "failed").otherwise(F.col("outcome"))
    )


def accept(judged: DataFrame) -> DataFrame:
    """The record to store for each key: newest among those created or updated."""
    wanted = judged.where(F.col("outcome").isin("created", "updated"))
    return latest_per_key(wanted, "grant_id", *newest_record_order(registry_spec(), *PLACE))


def ingest_registry(
    spark: SparkSession,
    extracts: str,
    root: str,
    work: str,
    run_id: str,
    batch_millis: int,
    version: int | None = None,
    forecasts: bool = False,
    caps: dict | None = None,
    chunks: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Run one ingest; returns the outcome counts and metric samples as tables.

    The parsed chunks and the judged records are written once under ``work`` and read back, so the XML is parsed and
    joined one time however many results are taken from it. Of the table only the id prefixes of the batch are read.
    """
    start = items.next_version(spark, root, version)
    source = chunks if chunks is not None else read_chunks(spark, extracts)
    records, rejects = parse_results(stored(parse_all(source, forecasts), f"{work}/{run_id}/parsed"))
    if caps:
        records = records.withColumn("_kind", F.col("is_forecast").cast("string"))
        records = cap_records(
            records, caps.get("total", -1),
            {"false": caps.get("synopsis", -1), "true": caps.get("forecast", -1)},
            "file", "_kind", "ord", F.col("split"),
        ).drop("_kind")
    previous = items.read_snapshot(spark, root, prefixes=items.prefixes_of(records), last=start[0])
    previous = items.empty_prepared(spark) if previous is None else previous.drop("id_prefix")
    judged = stored(judge(records, previous), f"{work}/{run_id}/judged")

    changed = upsert_delta(previous, accept(judged), registry_spec(), F.lit(batch_millis), images=True)
    items.write_delta(feed_rows(changed, previous.columns), root, writer=run_id, start=start)

    undecoded = rejects.select(
        F.lit(None).cast("string").alias("key"),
        F.concat_ws(":", *PLACE).alias("seq"), "reason", F.col("chunk").alias("payload"),
    )
    failed = judged.where("outcome = 'failed'").select(
        F.col("grant_id").alias("key"), F.concat_ws(":", *PLACE).alias("seq"), "reason",
        F.to_json(F.struct("grant_id", "LastUpdatedDate", "is_forecast")).alias("payload"),
    )
    landing.write_quarantine(
        undecoded.unionByName(failed), run_id, "split_registry", f"{root}/_quarantine"
    )
    counts = outcome_counts(judged)
    measured = samples(
        counts, "split_registry", F.timestamp_millis(F.lit(batch_millis)),
        F.concat(F.lit("record."), F.col("outcome")), F.col("records"),
    )
    measured.write.mode("overwrite").json(f"{root}/_metrics/run_id={run_id}/step=split_registry")
    return {"counts": counts, "samples": measured}
