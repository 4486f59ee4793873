"""File-triggered steps, stateful upsert and metric roll-up as streams."""

from __future__ import annotations

import json
import re
import time
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.types import StructType

from grantflow import schemas
from grantflow.frames import stored
from grantflow.functions.keys import key_problem
from grantflow.operators.events import outcomes, split_outcomes
from grantflow.operators.freshness import freshness, latest_per_key
from grantflow.operators.router import route
from grantflow.operators.upsert import feed_rows, upsert_delta
from grantflow.plans.publish import with_revision
from grantflow.records import RecordSpec
from grantflow.sources import items, landing, manifest
from grantflow.sources.registry_xml import DELIMITER
from grantflow.streaming.retry import apply_halving, failures

# Fixed value: longest time a micro-batch gathers changes.
GATHER = "180 seconds"
# The file names of each step; the route itself is checked on the whole key.
_LAST_NAME = {
    "extract_registry": "archive.zip",
    "split_registry": "extract.xml",
    "enqueue_sheet_download": "raw.eml",
    "split_sheet": "download.xlsx",
    "persist_registry": "v2.*",
    "persist_sheet": "v1.json",
}


def stream_route(spark: SparkSession, root: str, step: str) -> DataFrame:
    """New objects under ``root`` whose key takes them to ``step``, in the shape its reader takes."""
    reader = (
        spark.readStream.option("recursiveFileLookup", "true")
        .option("pathGlobFilter", _LAST_NAME[step])
    )
    path = F.col("_metadata.file_path")
    # the key is what stands below the root
    here = re.sub(r"^\w+:", "", root).strip("/") + "/"
    key = F.substring_index(path, here, -1)
    mine = route(key) == step
    if step == "split_registry":
        return reader.option("lineSep", DELIMITER).format("text").load(root).where(mine).select(
            path.alias("file"), F.col("_metadata.file_block_start").alias("split"),
            F.col("value").alias("chunk"),
        )
    if step in ("enqueue_sheet_download", "persist_registry", "persist_sheet"):
        return reader.option("wholetext", "true").format("text").load(root).where(mine).select(
            path.alias("path"), F.col("value").alias("text")
        )
    return reader.format("binaryFile").schema(
        "path string, modificationTime timestamp, length long, content binary"
    ).load(root).where(mine)


def _trigger(writer: DataStreamWriter, available_now: bool) -> DataStreamWriter:
    return writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime=GATHER
    )


def with_order(batch: DataFrame) -> DataFrame:
    """Document order of a micro-batch of chunks, as the batch reader gives it."""
    return batch.withColumn("ord", F.monotonically_increasing_id())


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a checkpoint keeps: another checkpoint is another stream, whatever its batch numbers."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata", wholetext=True).first().value)["id"]


def _begun(spark: SparkSession, root: str, writer: str, batch_id: int) -> int:
    """Milliseconds at which a batch was first begun; a replay finds the same."""
    path = f"{root}/_begun/{writer}/{batch_id}"
    try:
        return spark.read.schema("millis long").json(path).first().millis
    except (AnalysisException, AttributeError):
        now = int(time.time() * 1000)
        spark.range(1).select(F.lit(now).alias("millis")).write.mode("overwrite").json(path)
        return now


ATTEMPTS = 20  # of a batch that meets the commits of other writers


def stream_upsert(
    stream: DataFrame,
    root: str,
    spec: RecordSpec,
    checkpoint: str,
    newest_first: list[Column],
    prepare: Callable[[DataFrame], DataFrame | tuple[DataFrame, DataFrame]] | None = None,
    schema: StructType = schemas.PREPARED,
    available_now: bool = True,
    fanout: int = items.FANOUT,
) -> StreamingQuery:
    """Keep the table current. Its state is the table itself, keyed by record.

    ``prepare`` turns a micro-batch into records, or into (records, rejects ``key, seq, reason, payload``). A batch is
    parsed and judged once and written beside the table; what is created or updated becomes a delta with the next
    version, what failed goes to the quarantine. Of the table only the id prefixes of the batch are read.

    The commit names stream and batch: a replayed batch that was committed is skipped, one that was not starts over with
    the same time. Where another writer commits first, the batch is judged again on the newer table. A stream with a new
    checkpoint reads its input again, which changes nothing. After its commit the stream merges deltas that have become
    many.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        writer = _stream_id(spark, checkpoint)
        if items.written(spark, root, writer, batch_id):
            return
        work = f"{root}/_work/{writer}/{batch_id}"
        prepared = prepare(batch) if prepare else batch
        records, rejects = prepared if isinstance(prepared, tuple) else (prepared, None)
        records = stored(records, f"{work}/records")
        prefixes = items.prefixes_of(records, spec.key)
        for attempt in range(ATTEMPTS):
            try:
                upsert_batch(records, rejects, prefixes, writer, batch_id, work)
                break
            except manifest.CommitConflict:
                if attempt == ATTEMPTS - 1 or items.written(spark, root, writer, batch_id):
                    raise
        items.compact(spark, root, schema, spec.key, fanout)

    def upsert_batch(
        records: DataFrame, rejects: DataFrame | None, prefixes: list[str] | None, writer: str, batch_id: int, work: str,
    ) -> None:
        spark = records.sparkSession
        start = items.next_version(spark, root)
        previous = items.read_snapshot(spark, root, schema=schema, key=spec.key, prefixes=prefixes, last=start[0])
        previous = spark.createDataFrame([], schema) if previous is None else previous.drop("id_prefix")
        # late data: an older or equal date never overwrites
        judged = freshness(records, previous, spec) if spec.date_col else records.withColumns(
            {"outcome": F.lit("created"), "reason": F.lit(None).cast("string")})
        problem = key_problem(F.col(spec.key))
        judged = judged.withColumn("reason", F.coalesce("reason", problem)).withColumn(
            "outcome", F.when(problem.isNotNull(), "failed").otherwise(F.col("outcome")))
        judged = stored(judged, f"{work}/judged")

        failed = judged.where("outcome = 'failed'").select(
            F.col(spec.key).cast("string").alias("key"), F.lit(None).cast("string").alias("seq"), "reason",
            F.to_json(F.struct(*records.columns)).alias("payload"))
        dead = failed if rejects is None else failed.unionByName(rejects.select("key", "seq", "reason", "payload"))
        landing.write_quarantine(dead, f"{writer}-{batch_id}", "stream_upsert", f"{root}/_quarantine")
        accepted = judged.where(F.col("outcome").isin("created", "updated")).drop("outcome", "reason")
        incoming = latest_per_key(accepted, spec.key, *newest_first)
        changed = upsert_delta(previous, incoming, spec, F.lit(_begun(spark, root, writer, batch_id)), images=True)
        items.write_delta(feed_rows(changed, previous.columns), root, None, spec.key, writer, batch_id, start)

    stream_writer = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return _trigger(stream_writer, available_now).start()


def _publish_batch(changes: DataFrame, out: str, quarantine: str, source: str, writer: str, batch_id: int) -> None:
    """Judged once; the folders of stream and batch, so that a replay replaces its own events and nobody else's.

    A batch that fails is halved until the changes that break it stand alone; those go to the quarantine to be tried again
    (``retry.redrive``), all others are published."""
    mine = f"writer={writer}/batch={batch_id}"

    def publish_part(part: DataFrame, name: str) -> None:
        judged = stored(outcomes(part), f"{quarantine}/_outcomes/{mine}/{name}")
        events, rejected = split_outcomes(judged, source)
        rejected.write.mode("overwrite").json(f"{quarantine}/{mine}/{name}")
        events.write.mode("overwrite").json(f"{out}/{mine}/{name}")

    for folder in (out, quarantine):  # parts of an earlier try may have other borders
        manifest.Files(changes.sparkSession, folder).delete(mine)
    bad = apply_halving(changes, f"{quarantine}/_outcomes/{mine}", publish_part)
    failed = stored(failures(bad), f"{quarantine}/_failures/{mine}")
    if failed.limit(1).count():
        failed.write.mode("overwrite").parquet(f"{quarantine}/_broken/{mine}/generation=0")


def stream_publish(
    changes: DataFrame, out: str, quarantine: str, checkpoint: str, source: str = "grantflow",
    available_now: bool = True,
) -> StreamingQuery:
    """Publish a stream of changes (op, old, new, seq, event_time)."""
    def apply(batch: DataFrame, batch_id: int) -> None:
        _publish_batch(batch, out, quarantine, source, _stream_id(batch.sparkSession, checkpoint), batch_id)

    writer = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return _trigger(writer, available_now).start()


def stream_feed(
    spark: SparkSession, root: str, out: str, quarantine: str, checkpoint: str, source: str = "grantflow",
    schema: StructType = schemas.PREPARED, versions_at_once: int = 50, available_now: bool = True,
) -> StreamingQuery:
    """Publish every change of a table as it is committed, each version once; no snapshot is read.

    The source is the stream of commits: a commit appears whole and after its data, and the checkpoint remembers which
    ones were taken. A purge and a merge change nothing that is published. Versions must be kept (``items.vacuum``) until
    they are published.
    """
    def apply(batch: DataFrame, batch_id: int) -> None:
        versions = sorted(r.version for r in batch.select("version").collect())  # at most versions_at_once
        changes = with_revision(items.read_changes(batch.sparkSession, root, versions, schema))
        _publish_batch(changes, out, quarantine, source, _stream_id(batch.sparkSession, checkpoint), batch_id)

    marks = (
        spark.readStream.schema("version long").option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", versions_at_once).json(f"{root}/{manifest.COMMITS}")
    )
    writer = marks.writeStream.option("checkpointLocation", checkpoint).foreachBatch(apply)
    return _trigger(writer, available_now).start()


def stream_rollup(
    stream: DataFrame, width: str, by: list[str], aggs: dict[str, Column], ts: str = "ts",
    delay: str = "900 seconds",
) -> DataFrame:
    """Bucketed aggregates that are emitted once the evaluation delay has passed."""
    grouped = stream.withWatermark(ts, delay).groupBy(F.window(F.col(ts), width).alias("_w"), *by)
    out = grouped.agg(*[c.alias(n) for n, c in aggs.items()])
    return out.select(F.col("_w.start").alias("bucket"), *by, *aggs)
