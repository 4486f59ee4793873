"""Helpers shared by the training-data operators: staging folders, words, row checks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ASCII white space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where it is unset (a local session, as in tests) a folder of this machine is named instead.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None:
        folder = tempfile.mkdtemp(prefix="grantflow-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def fresh_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/grantflow-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back: cuts lineage, computes costly rows once."""
    path = fresh_folder(df.sparkSession, name)
    df.write.parquet(path)
    back = df.sparkSession.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def discard(*dfs: DataFrame) -> None:
    """Delete the folders of staged tables that nothing reads any more."""
    for df in dfs:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.staged_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of the shuffle files of finished steps now: they stay until the driver collects its garbage."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small(batches: Iterable[pa.RecordBatch], rows: int = 500, size: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in parts of at most ``rows`` rows and, but for a single larger row, ``size`` bytes of text, so that
    what a task makes of a part stays small. Memory that is free goes back to the system after each batch."""
    for batch in batches:
        ends = np.cumsum(sum((_sizes(c) for c in batch.columns), np.zeros(batch.num_rows, dtype=np.int64)))
        at = 0
        while at < batch.num_rows:
            before = ends[at - 1] if at else 0
            end = max(at + 1, min(at + rows, int(np.searchsorted(ends, before + size, side="right"))))
            yield batch.slice(at, end - at)
            at = end
        trim()


def _sizes(column: pa.Array) -> np.ndarray:
    """Bytes of text in each row of a column; texts inside a struct count as well."""
    if pa.types.is_struct(column.type):
        return sum((_sizes(c) for c in column.flatten()), np.zeros(len(column), dtype=np.int64))
    if pa.types.is_string(column.type) or pa.types.is_binary(column.type):
        return pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.zeros(len(column), dtype=np.int64)


def trim() -> None:
    """Give free memory of this process back to the system: a Python worker lives on after its task."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)


def binaries(column: pa.Array) -> list[bytes | None]:
    """Values of a text column as UTF-8."""
    return column.cast(pa.binary()).to_pylist()


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, so that further columns with clashing names do no harm."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def keyed(df: DataFrame) -> DataFrame:
    """``row``, a struct of all columns, whatever their names, and ``key``, its hash."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), row_key(df).alias("key"))


def row_key(df: DataFrame) -> Column:
    """A hash of all columns: equal rows have equal keys. Nulls are told from texts and from each other's columns."""
    return F.xxhash64(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(f"\0{i}")) for i, c in enumerate(df.columns)])
