"""Record caps counted in document order (a testing aid of the ingest job)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from grantflow.operators.skew import running


def cap_records(
    df: DataFrame, total: int, per_type: dict, group: str, kind: str, pos: str, block: Column | None = None,
) -> DataFrame:
    """Keep the first ``total`` records per group and the first ``per_type[k]`` of each kind.

    -1 means no cap. A record dropped by its type's cap does not use up the total. ``block`` goes before ``pos`` in the
    order.
    """
    out = df
    limits = {k: n for k, n in per_type.items() if n >= 0}
    if limits:
        capped = F.col(kind).isin(list(limits))
        most = max(limits.values())
        cap = F.lit(most)
        for value, n in limits.items():
            cap = F.when(F.col(kind) == F.lit(value), F.lit(n)).otherwise(cap)
        kept = _first(df.where(capped), [group, kind], pos, block, most).where(F.col("_nth") <= cap).drop("_nth")
        out = kept.unionByName(df.where(~F.coalesce(capped, F.lit(False))))
    if total >= 0:
        out = _first(out, [group], pos, block, total).drop("_nth")
    return out


def _first(df: DataFrame, group: list[str], pos: str, block: Column | None, most: int) -> DataFrame:
    """The first ``most`` rows of each group, with their number ``_nth``.

    A row number under a small limit lets each task keep the first rows of a group before anything is shuffled. Spark
    does so up to a threshold; above it rows are counted in blocks, so that no task holds a whole group.
    """
    if most <= int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold")):
        order = [F.col(pos)] if block is None else [block, F.col(pos)]
        out = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*group).orderBy(*order)))
    else:
        out = running(df, group, pos, {"_nth": ("sum", F.lit(1))}, block)
    return out.where(F.col("_nth") <= most)
