"""Changes -> published events and quarantined changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.frames import settled
from grantflow.operators.canonical import grant_json, to_canonical
from grantflow.operators.diff import event_type, images_for
from grantflow.operators.skew import lookup_join
from grantflow.operators.validate import grant_errors

DETAIL_TYPE = "GrantModificationEvent"


def judge_changes(changes: DataFrame) -> DataFrame:
    """Adds documents, errors, ``type`` and ``reason`` to rows (op, old, new, ...).

    An invalid new version blocks the event; an invalid old version is only a warning; a version
    that cannot be built blocks either way. ``reason`` is NULL for what may be published.
    """
    old, new = images_for(F.col("op"), F.col("old"), F.col("new"))
    out = changes.withColumn("old", old).withColumn("new", new)
    out = to_canonical(
        out, {"old": ("previous", "malformed_old"), "new": ("current", "malformed_new")}
    )
    previous, current = F.col("previous"), F.col("current")
    out = out.withColumns({
        "errors_old": F.when(previous.isNotNull(), grant_errors(previous)),
        "errors_new": F.when(current.isNotNull(), grant_errors(current)),
    })

    def unbuildable(image: str) -> Column:
        if "unbuildable" not in changes.schema[image].dataType.fieldNames():
            return F.lit(False)
        return F.coalesce(F.col(f"{image}.unbuildable"), F.lit(False))

    kind = event_type(current, previous)
    reason = (
        F.when(kind.isNull(), "no_version")
        .when(unbuildable("new"), "unbuildable_new")
        .when(F.size("errors_new") > 0, "invalid_new")
        .when(unbuildable("old"), "unbuildable_old")
    )
    return out.withColumn("type", kind).withColumn("reason", settled(reason))


def event_json(kind: Column, previous: Column, current: Column) -> Column:
    """``{"type": ..., "versions": {"previous": ..., "new": ...}}`` with explicit nulls."""
    shown = lambda g: F.coalesce(F.when(g.isNotNull(), grant_json(g)), F.lit("null"))
    return F.concat(
        F.lit('{"type":"'), kind, F.lit('","versions":{"previous":'), shown(previous),
        F.lit(',"new":'), shown(current), F.lit("}}"),
    )


def outcomes(changes: DataFrame, carry: tuple[str, ...] = ("seq", "event_time")) -> DataFrame:
    """One row per change with all that publishing takes from it, so that a job can store it and judge once: the event's
    ``detail`` or, with a ``reason``, the ``payload`` for the quarantine; and the malformed fields of both images."""
    judged = judge_changes(changes)
    free = F.col("reason").isNull()
    return judged.select(
        F.coalesce(F.col("new.grant_id"), F.col("old.grant_id")).alias("key"), "op", "type", "reason",
        F.when(free, event_json(F.col("type"), F.col("previous"), F.col("current"))).alias("detail"),
        F.when(~free, F.to_json(F.struct("op", "old", "new"))).alias("payload"),
        "errors_old", "errors_new", "malformed_old", "malformed_new", *carry)


def split_outcomes(
    judged: DataFrame, source: str = "grantflow", carry: tuple[str, ...] = ("seq", "event_time")
) -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) of outcomes."""
    events = judged.where("reason IS NULL").select(
        F.lit(source).alias("source"), F.lit(DETAIL_TYPE).alias("detail_type"), "type", "detail", *carry)
    return events, judged.where("reason IS NOT NULL").select("key", "reason", "errors_new", "payload", *carry)


def publishable(
    changes: DataFrame, source: str = "grantflow", carry: tuple[str, ...] = ("seq", "event_time")
) -> tuple[DataFrame, DataFrame]:
    """(events, quarantine) of changes (op, old, new, seq, event_time)."""
    return split_outcomes(outcomes(changes, carry), source, carry)


def malformed_counts(judged: DataFrame) -> DataFrame:
    """(change, field, n): one count for each malformed occurrence."""
    sides = F.array(
        F.struct(F.lit("OldImage").alias("change"), F.col("malformed_old").alias("fields")),
        F.struct(F.lit("NewImage").alias("change"), F.col("malformed_new").alias("fields")),
    )
    return (
        judged.select(F.explode(sides).alias("s"))
        .select("s.change", F.explode("s.fields").alias("field"))
        .groupBy("change", "field").agg(F.count(F.lit(1)).alias("n"))
    )


def prefix_until_failure(
    df: DataFrame, batch: str, seq: str, failed: Column, hot: DataFrame | None = None
) -> DataFrame:
    """Adds ``disposition``: published before a batch's first failure, failed at it, retry after.

    Only each batch's first failing position is needed, and that is a minimum that combines before
    the shuffle; no batch is ordered in one task.
    """
    flagged = df.withColumn("_failed", failed)
    first = (
        flagged.where("_failed").groupBy(batch).agg(F.min(seq).alias("_first"))
    )
    out = lookup_join(flagged, first, batch, "left", hot)
    disposition = (
        F.when(F.col("_first").isNull() | (F.col(seq) < F.col("_first")), "published")
        .when(F.col(seq) == F.col("_first"), "failed")
        .otherwise("retry")
    )
    return out.withColumn("disposition", disposition).drop("_failed", "_first")
