"""Batches that fail: halved until the rows that break them stand alone, counted, and tried again later."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.frames import stored

# Fixed value: tries of a row before it is given up.
ATTEMPTS = 5
_LOWEST, _ABOVE = -(1 << 63), 1 << 63
_PLACE = "_place"


def apply_halving(
    rows: DataFrame, work: str, apply: Callable[[DataFrame, str], None],
) -> DataFrame:
    """Calls ``apply(rows, name)`` for parts of ``rows`` that together hold all but the rows that make it fail; gives those,
    with the ``error`` of each.

    The batch is stored with a hash as each row's place, so a part is a range of places and no row is numbered in one
    task. A part that fails is halved; with k bad rows among n some k log2(n) parts fail, whatever n is. ``apply`` must
    replace what an earlier try under the same name left.
    """
    placed = rows.withColumn(_PLACE, F.xxhash64(F.monotonically_increasing_id(), F.spark_partition_id()))
    batch = stored(placed, f"{work}/batch")
    bad = []
    parts = [(_LOWEST, _ABOVE)]
    while parts:
        low, high = parts.pop()
        here = batch.where((F.col(_PLACE) >= low) & (F.col(_PLACE) <= high - 1))
        try:
            apply(here.drop(_PLACE), f"part={low}")
        except Exception as error:  # whatever the rows do to it
            found = here.select(F.min(_PLACE).alias("first"), F.max(_PLACE).alias("last")).first()
            if found.first is None:  # not a matter of rows
                raise
            if found.first == found.last:
                bad.append((found.first, f"{type(error).__name__}: {error}"[:500]))
            else:
                # halve what is there, not the empty space around it
                middle = (found.first + found.last) // 2 + 1
                parts += [(found.first, middle), (middle, found.last + 1)]
    names = rows.sparkSession.createDataFrame(bad, f"{_PLACE} long, error string")  # one row per bad row of a batch
    return batch.join(names, _PLACE).drop(_PLACE)


def failures(bad: DataFrame, attempt: int = 1) -> DataFrame:
    """Quarantine rows of what ``apply_halving`` gave: the change as JSON, the attempts so far, whether it is dead."""
    payload = [c for c in bad.columns if c not in ("error", "attempts")]
    tries = F.col("attempts") + 1 if "attempts" in bad.columns else F.lit(attempt)
    return bad.select(
        F.to_json(F.struct(*payload)).alias("payload"), F.col("error").alias("reason"), tries.cast("int").alias("attempts"),
        (tries >= ATTEMPTS).alias("dead"), F.current_timestamp().alias("written_at"))


def redrive(
    spark: SparkSession, quarantine: str, run_id: str, work: str, schema: str, apply: Callable[[DataFrame, str], None],
) -> DataFrame:
    """Tries the living rows of the newest generation of a quarantine again; the rest is the next generation, which it
    gives. A row that has failed ``ATTEMPTS`` times is dead and stays for a person to look at.

    Generations are folders ``generation=<n>``: a repeated run reads the same one and replaces its own result.
    """
    rows = spark.read.parquet(quarantine)
    newest = rows.agg(F.max("generation")).first()[0] or 0
    rows = rows.where(F.col("generation") == newest).drop("generation")
    alive = rows.where("NOT dead").select(F.from_json("payload", schema).alias("row"), "attempts").select("row.*", "attempts")
    bad = apply_halving(alive, f"{work}/{run_id}", lambda part, name: apply(part.drop("attempts"), f"{run_id}/{name}"))
    kept = stored(failures(bad).unionByName(rows.where("dead")), f"{work}/{run_id}/kept")
    kept.write.mode("overwrite").parquet(f"{quarantine}/generation={newest + 1}")
    return kept
