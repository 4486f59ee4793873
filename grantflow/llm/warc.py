"""WARC archives: writing records, and a sequential reader.

Each record is one gzip member. The reader inflates a member step by step, finds the header, frames the block by its
content length, feeds digests while bytes pass, and checks that the member ends where the frame does. It holds one
record, never an archive.

Archives are written by tasks straight to the shared folder. A task attempt writes under names of its own, and the
manifest - written by Spark's own commit - names only the archives of attempts that count, so a lost executor or a
second attempt leaves no record twice.

Payloads that occur more than once are stored once: the record with the largest page id is the ``response``, the
others are ``revisit`` records that refer to it.

Defined results: null html is an empty payload; a null url is left out; a null page id makes a record that others
never refer to (a revisit if a record with an id has its payload, else a response); equal rows are equal records (all
that carry the largest id are responses); no rows, no archives. A broken member gives a row with ``error`` and ends
its archive.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import fresh_folder, pick, staged

CHUNK = 1 << 16
DATE = "1970-01-01T00:00:00Z"
PLAIN = re.compile(r"[\x21-\x7e\x80-\U0010ffff]+")

MANIFEST = pa.schema([("file", pa.string()), ("records", pa.int64()), ("bytes", pa.int64())])
RECORD = pa.schema([
    ("file", pa.string()), ("position", pa.int64()), ("record_id", pa.string()), ("record_type", pa.string()),
    ("uri", pa.string()), ("refers_to_id", pa.string()), ("payload_digest", pa.string()),
    ("payload_bytes", pa.int64()), ("digest_ok", pa.bool_()), ("payload", pa.binary()), ("error", pa.string()),
])


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page: int | None, uri: str | None, digest: str) -> str:
    name = str(page) if page is not None else "none-" + hashlib.sha1(f"{uri}\n{digest}".encode()).hexdigest()
    return f"<urn:page:{name}>"


def encode_record(page: int | None, uri: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    digest = base32(hashlib.sha1(payload).digest())
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if revisit else http + payload
    fields = [
        ("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", record_id(page, uri, digest)),
        ("WARC-Date", DATE), ("WARC-Payload-Digest", "sha1:" + digest),
        ("WARC-Block-Digest", "sha1:" + base32(hashlib.sha1(block).digest())),
        ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block))),
    ]
    if uri is not None:
        # a header line can't hold blanks or control characters
        safe = PLAIN.fullmatch(uri)
        fields.append(("WARC-Target-URI", uri) if safe else (
            "WARC-Target-URI-Base64", base64.b64encode(uri.encode("utf-8", "surrogatepass")).decode()))
    if revisit:
        fields.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        fields.append(("WARC-Refers-To", record_id(refers_to, None, digest)))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode("utf-8", "surrogatepass") + block + b"\r\n\r\n") + packer.flush()


class Members:
    """Bytes of one gzip member after the other, inflated as they are asked for."""

    def __init__(self, stream):
        self.stream, self.raw, self.read_bytes = stream, b"", 0
        self.inflater, self.buffer, self.start = None, b"", 0

    def open(self) -> bool:
        """Go to the next member; False at the end of the archive."""
        self.start = self.read_bytes - len(self.raw)
        if not self.raw:
            self._pull()
        self.inflater, self.buffer = zlib.decompressobj(31), b""
        return bool(self.raw)

    def _pull(self) -> None:
        self.raw = self.stream.read(CHUNK)
        self.read_bytes += len(self.raw)

    def more(self) -> bytes:
        """The next inflated bytes of this member; empty at its end."""
        while not self.inflater.eof:
            if not self.raw:
                self._pull()
                if not self.raw:
                    raise EOFError("member is cut off")
            out = self.inflater.decompress(self.raw, CHUNK)
            self.raw = self.inflater.unused_data if self.inflater.eof else self.inflater.unconsumed_tail
            if out:
                return out
        return b""

    def until(self, mark: bytes) -> bytes:
        """Bytes up to and with ``mark``."""
        parts = self.buffer
        seen = 0
        while (at := parts.find(mark, max(0, seen - len(mark)))) < 0:
            seen = len(parts)
            chunk = self.more()
            if not chunk:
                raise EOFError("no end of header")
            parts += chunk
        self.buffer = parts[at + len(mark):]
        return parts[: at + len(mark)]

    def exactly(self, size: int) -> Iterator[bytes]:
        while size:
            chunk = self.buffer or self.more()
            if not chunk:
                raise EOFError("block is shorter than its content length")
            taken, self.buffer = chunk[:size], chunk[size:]
            size -= len(taken)
            yield taken


def _headers(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "surrogatepass").split("\r\n")[1:]
    return {k.lower(): v.strip() for k, _, v in (line.partition(":") for line in lines if line)}


def read_archive(stream, keep_payload: bool = True) -> Iterator[dict]:
    """Records of one archive in order."""
    members = Members(stream)
    while True:
        row = dict.fromkeys(RECORD.names)
        try:
            if not members.open():
                return
            row["position"] = members.start
            head = members.until(b"\r\n\r\n")
            if not head.startswith(b"WARC/"):
                raise ValueError("not a WARC record")
            fields = _headers(head)
            row["record_type"], row["record_id"] = fields.get("warc-type"), fields.get("warc-record-id")
            row["uri"] = fields.get("warc-target-uri")
            if "warc-target-uri-base64" in fields:
                row["uri"] = base64.b64decode(fields["warc-target-uri-base64"]).decode("utf-8", "surrogatepass")
            row["refers_to_id"] = fields.get("warc-refers-to")
            row["payload_digest"] = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
            _body(members, fields, row, keep_payload)
        except (ValueError, EOFError, KeyError, zlib.error) as broken:
            row["error"] = f"{type(broken).__name__}: {broken}"
            yield row
            return
        yield row


def _body(members: Members, fields: dict[str, str], row: dict, keep_payload: bool) -> None:
    block, payload, kept = hashlib.sha1(), hashlib.sha1(), []
    http: bytes | None = b""  # the block's own header, until its blank line
    size = 0
    for chunk in members.exactly(int(fields["content-length"])):
        block.update(chunk)
        if http is not None:
            http += chunk
            at = http.find(b"\r\n\r\n")
            if at < 0:
                continue
            http, chunk = None, http[at + 4:] if not row.update(_http=http[:at]) else b""
        payload.update(chunk)
        size += len(chunk)
        if keep_payload:
            kept.append(chunk)
    if b"".join(members.exactly(4)) != b"\r\n\r\n" or members.buffer or members.more():
        raise ValueError("member doesn't end after its block")
    head = row.pop("_http", b"")
    stated = fields.get("warc-block-digest", "").removeprefix("sha1:")
    ok = not stated or stated == base32(block.digest())
    if row["record_type"] == "revisit":
        row["payload_bytes"] = int(_headers(head)["content-length"])
    else:
        row["payload_bytes"] = size
        ok = ok and row["payload_digest"] == base32(payload.digest())
        row["payload"] = b"".join(kept) if keep_payload else None
    row["digest_ok"] = ok


def write_warc(pages: DataFrame, folder: str, roll_bytes: int = 64 << 20) -> DataFrame:
    """Write ``page, uri, payload, revisit, refers_to`` as archives to ``folder``; gives the manifest."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, path = fs.FileSystem.from_uri(folder)
        system.create_dir(path, recursive=True)
        attempt, number, out, done = uuid.uuid4().hex, 0, None, []
        records = size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if out is None:
                    name = f"part-{attempt}-{number:05d}.warc.gz"
                    out, number, records, size = system.open_output_stream(f"{path}/{name}", None), number + 1, 0, 0
                member = encode_record(
                    row["page"], row["uri"], (row["payload"] or "").encode("utf-8", "surrogatepass"),
                    row["refers_to"], row["revisit"],
                )
                out.write(member)
                records, size = records + 1, size + len(member)
                if size >= roll_bytes:
                    out.close()
                    out = done.append((f"{folder}/{name}", records, size))
        if out is not None:
            out.close()
            done.append((f"{folder}/{name}", records, size))
        yield pa.RecordBatch.from_pylist([dict(zip(MANIFEST.names, d, strict=True)) for d in done], MANIFEST)

    return staged(pages.mapInArrow(write, from_arrow_schema(MANIFEST)), "manifest")


def read_warc(spark: SparkSession, files: DataFrame, keep_payload: bool = True, batch_bytes: int = 8 << 20) -> DataFrame:
    """Records (RECORD) of the archives named in column ``file``; an archive is read in one pass by one task."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column("file").to_pylist():
                system, path = fs.FileSystem.from_uri(name)
                rows, held = [], 0
                with system.open_input_stream(path, None) as stream:
                    for row in read_archive(stream, keep_payload):
                        rows.append(row | {"file": name})
                        held += len(row["payload"] or b"") + 200
                        if held >= batch_bytes:
                            yield pa.RecordBatch.from_pylist(rows, RECORD)
                            rows, held = [], 0
                yield pa.RecordBatch.from_pylist(rows, RECORD)

    names = files.select("file")
    return names.repartition(max(1, names.count())).mapInArrow(read, from_arrow_schema(RECORD))


def deduplicated(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Rows for ``write_warc``: which record carries a payload and which ones refer to it."""
    rows = pick(pages, id_col, url_col, html_col).toDF("page", "uri", "payload").select(
        F.col("page").cast("long").alias("page"), "uri", F.coalesce("payload", F.lit("")).alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha1(F.encode("payload", "UTF-8"))))
    # one row per repeated payload; the many rows of a hot one are split by the adaptive skew join
    keepers = (
        rows.groupBy("digest").agg(F.max("page").alias("keeper"), F.count("*").alias("n"))
        .where("n > 1").select("digest", "keeper")
    )
    revisit = F.coalesce(F.col("keeper").isNotNull() & ~F.col("page").eqNullSafe(F.col("keeper")), F.lit(False))
    return rows.join(keepers, "digest", "left").select(
        "page", "uri", "payload", revisit.alias("revisit"), F.when(revisit, F.col("keeper")).alias("refers_to"))


def page_of(record: str):
    """Page id within a record id column."""
    return F.expr(f"try_cast(regexp_extract({record}, '^<urn:page:(-?[0-9]+)>$', 1) AS long)")


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write all pages as archives to the shared folder and read every record back."""
    manifest = write_warc(deduplicated(pages), fresh_folder(spark, "warc"))
    return read_warc(spark, manifest, keep_payload=False)
