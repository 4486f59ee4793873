"""Small helpers on columns and whole DataFrames."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def settled(c: Column) -> Column:
    """A costly column that is filtered on later, computed once.

    The optimizer moves a filter on a computed column below the computation by copying the
    expression into it, so a document would be parsed twice. It does not do so when the column
    depends on where the row stands, which is what the condition here, always true, stands for.
    """
    return F.when(F.spark_partition_id() >= 0, c)


def let(c: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a column that it mentions several times, computed once per row."""
    return F.get(F.transform(F.array(c), lambda v: use(v)), 0)


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Rows dealt over all the shuffle partitions, for costly work on each of them: a compact table is read by a few tasks,
    and without a number given the optimizer puts partitions together again by their bytes."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def stored(df: DataFrame, path: str) -> DataFrame:
    """``df`` written to ``path`` and read back: computed once, whatever is made of it, and not again when executors go."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below ``spark.checkpoint.dir`` of the session.

    Only where that is unset (a local session, as in tests) it is a folder of this machine.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared is None:
        shared = tempfile.mkdtemp(prefix="grantflow-")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
