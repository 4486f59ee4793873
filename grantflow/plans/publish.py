"""Change feed -> events and quarantine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.frames import stored
from grantflow.functions.ulid import ulid_time
from grantflow.operators.diff import changed_prefixes, diff_snapshots
from grantflow.operators.events import malformed_counts, outcomes, split_outcomes
from grantflow.operators.metrics import samples, union_samples
from grantflow.sources import items, landing, manifest


def with_revision(changes: DataFrame) -> DataFrame:
    """Adds (seq, event_time); the revision of the change orders and dates it."""
    revision = F.coalesce(F.col("new.revision"), F.col("old.revision"))
    return changes.withColumn("seq", revision).withColumn("event_time", ulid_time(revision))


def changes_between(old: DataFrame, new: DataFrame) -> DataFrame:
    """(op, old, new, seq, event_time) from two whole snapshots."""
    return with_revision(diff_snapshots(old, new, "grant_id", "revision"))


def audit_changes(spark: SparkSession, root: str, old_version: int | None, new_version: int) -> DataFrame:
    """The net changes between two versions, whatever wrote them: the hash sums of the id prefixes are compared, and only
    prefixes that differ are opened."""
    before = {} if old_version is None else items.prefix_states(spark, root, old_version)
    wanted = changed_prefixes(before, items.prefix_states(spark, root, new_version))
    wanted = wanted if len(wanted) <= items.PRUNED else None
    new = items.read_snapshot(spark, root, new_version, prefixes=wanted).drop("id_prefix")
    old = (
        items.empty_prepared(spark) if old_version is None
        else items.read_snapshot(spark, root, old_version, prefixes=wanted).drop("id_prefix")
    )
    return changes_between(old, new)


def feed_changes(spark: SparkSession, root: str, old_version: int | None, new_version: int) -> DataFrame | None:
    """Every change after ``old_version`` from the deltas that made it; None where a version left no feed."""
    files = manifest.Files(spark, root)
    versions = [v for v in manifest.versions(files) if (old_version or 0) < v <= new_version]
    if any(c.changes is None and c.kind != "merge" for c in (manifest.load(files, v) for v in versions)):
        return None
    return with_revision(items.read_changes(spark, root, versions).drop("version"))


def publish(
    spark: SparkSession, root: str, work: str, out: str, run_id: str, batch_millis: int,
    old_version: int | None, new_version: int, source: str = "grantflow",
) -> dict[str, DataFrame]:
    """Publish what happened after ``old_version`` up to ``new_version``: from the change feed, one event per change; only
    where a version has no feed (a purge, a table loaded whole) the net changes of the snapshots."""
    changes = feed_changes(spark, root, old_version, new_version)
    if changes is None:
        changes = audit_changes(spark, root, old_version, new_version)
    judged = stored(outcomes(changes), f"{work}/{run_id}/outcomes")
    events, rejected = split_outcomes(judged, source)
    events.write.mode("overwrite").json(f"{out}/run_id={run_id}")
    landing.write_quarantine(
        rejected.select("key", "seq", "reason", "payload"), run_id, "publish_events",
        f"{root}/_quarantine",
    )
    measured = publish_samples(judged, F.timestamp_millis(F.lit(batch_millis)))
    measured.write.mode("overwrite").json(f"{root}/_metrics/run_id={run_id}/step=publish_events")
    return {"events": events, "rejected": rejected, "samples": measured}


def publish_samples(judged: DataFrame, at: Column) -> DataFrame:
    """All metrics of the step, from the stored outcomes: one narrow pass each, columns pruned."""
    step = "publish_events"
    one = F.count(F.lit(1))
    kinds = judged.select(F.explode(F.array(
        F.when(F.lit(True), F.struct(F.lit("invocation_batch_size").alias("metric"), F.lit(None).cast("string").alias("change"))),
        F.when(F.col("reason").isNotNull(), F.struct(F.lit("record.failed").alias("metric"), F.lit(None).cast("string").alias("change"))),
        *[F.when(F.col("op").isin(*ops), F.struct(F.lit("item_image.build").alias("metric"), F.lit(change).alias("change")))
          for change, ops in (("OldImage", ("MODIFY", "REMOVE")), ("NewImage", ("INSERT", "MODIFY")))],
        *[F.when(F.col("reason") == f"unbuildable_{side}", F.struct(
            F.lit("item_image.unbuildable").alias("metric"), F.lit(change).alias("change")))
          for side, change in (("old", "OldImage"), ("new", "NewImage"))],
        *[F.when(F.size(f"errors_{side}") > 0, F.struct(F.lit("grant_data.invalid").alias("metric"), F.lit(change).alias("change")))
          for side, change in (("old", "OldImage"), ("new", "NewImage"))],
    )).alias("m")).where("m IS NOT NULL").groupBy("m.metric", "m.change").agg(one.alias("n"))
    by_type = judged.where("reason IS NULL").groupBy("type").agg(one.alias("n"))
    return union_samples(
        samples(kinds.where("change IS NULL"), step, at, F.col("metric"), F.col("n")),
        samples(kinds.where("change IS NOT NULL"), step, at, F.col("metric"), F.col("n"), {"change": F.col("change")}),
        samples(by_type, step, at, F.lit("event.published"), F.col("n"), {"type": F.col("type")}),
        samples(malformed_counts(judged), step, at, F.lit("item_image.malformatted_field"), F.col("n"),
                {"field": F.col("field"), "change": F.col("change")}),
    )
