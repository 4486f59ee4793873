"""Archives: many zip files in parallel, each streamed out as record-sized chunks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow import schemas


def _unpack_function():
    """Unpacking function, sent to executors by value: they need not have this package."""
    def run(batches):
        import io
        import re
        import zipfile
        import zlib

        import pandas as pd

        columns = ["path", "entry", "status", "seq", "chunk"]
        broken = (zipfile.BadZipFile, zlib.error, EOFError, OSError, NotImplementedError, RuntimeError)

        def verdict(archive):
            names = archive.namelist()
            if not names:
                return "empty", None
            if not names[0].endswith(".xml"):
                return "not_xml", names[0]
            if len(names) > 1:
                return "extra_entry", names[0]
            # read once to the end before anything is passed on: a bad checksum must reject the whole
            with archive.open(names[0]) as stream:
                while stream.read(1 << 20):
                    pass
            return "ok", names[0]

        def pieces(stream):
            # same cut as the text source makes, a few megabytes at a time
            text = io.TextIOWrapper(stream, encoding="utf-8", errors="replace", newline="")
            held = []
            while block := text.read(1 << 20):
                tail = held[-1][-8:] if held else ""
                if "_1_0>" not in tail + block:
                    held.append(block)
                    continue
                *done, rest = re.split("_1_0>", "".join(held) + block)
                yield from done
                held = [rest]
            if held and "".join(held):
                yield "".join(held)

        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        status, entry = verdict(archive)
                        if status != "ok":
                            yield pd.DataFrame([(path, entry, status, 0, None)], columns=columns)
                            continue
                        with archive.open(entry) as stream:
                            rows = []
                            for seq, piece in enumerate(pieces(stream)):
                                rows.append((path, entry, "ok", seq, piece))
                                if len(rows) == 2000:
                                    yield pd.DataFrame(rows, columns=columns)
                                    rows = []
                            if rows:
                                yield pd.DataFrame(rows, columns=columns)
                except broken:
                    status = "empty" if len(content) == 0 else "invalid"
                    yield pd.DataFrame([(path, None, status, 0, None)], columns=columns)

    return run


def unpack_archives(spark: SparkSession, path: str) -> DataFrame:
    """(path, entry, status, seq, chunk) with status ok, not_xml, empty, invalid or extra_entry.

    Only an archive whose single entry is XML and reads to its end yields chunks, so nothing of a
    rejected archive can be promoted.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInPandas(_unpack_function(), schemas.ARCHIVE_CHUNKS)


def archive_chunks(unpacked: DataFrame) -> DataFrame:
    """Chunks in the shape the registry parser takes."""
    return unpacked.where(F.col("status") == "ok").select(
        F.col("path").alias("file"), F.lit(0).cast("bigint").alias("split"),
        F.col("seq").alias("ord"), "chunk",
    )
