"""Quality rules: per-document counts and cross-document line frequency.

Lines are normalised (ASCII white space runs to one blank, trimmed, lower case) and hashed. For each host the
distinct documents of every line are counted. A line over the limits is boilerplate and is taken away; a document
that keeps too little of its words is depleted and rejected.

Copies of a document are no boilerplate: equal texts count as one document, and near copies as one group. What tells
groups apart is the *own text* of a document: its lines that stand in no more documents than the limit and don't begin
or end like a line of more documents (an edited copy of a line keeps one of its ends). A line is boilerplate if the
documents that have it have more different own texts than the limit; documents without any own text are one group. So
the place of a line, the length of a block and the size of the host don't matter. Near copies whose edits change both
ends of a line count as different. De-duplication is another operator's work.

Defined results: null text is an empty text (no words: ``base_failed``); a null host is a host of its own; repeated
rows give repeated rows; an empty table gives an empty table; further columns are not read. Lines without a word are
skipped.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.llm.common import keyed, pick, small, staged


class Limits(NamedTuple):
    """``docs``: a line in more documents of a host, near copies counted once, is boilerplate. A document is depleted
    when less than ``left_pct`` % of its words are left."""

    min_words: int = 10
    repeat_pct: int = 20
    docs: int = 100
    left_pct: int = 20


SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\v\f\r"
END_WORDS = 4  # words at either end of a line that an edited copy may share; half of a shorter line
COUNTS = (
    "id long, host string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "text_hash long, lines array<struct<hash: long, head: long, tail: long, words: int>>"
)

NAMES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "text_hash", "lines"]
TYPES = [pa.int64()] * 6 + [
    pa.list_(pa.struct([("hash", pa.int64()), ("head", pa.int64()), ("tail", pa.int64()), ("words", pa.int32())]))]


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


def _hash(words: list[bytes], seed: int = 0) -> int:
    return _signed(xxhash.xxh3_64_intdigest(b" ".join(words), seed))


def repeated_words(codes: np.ndarray, width: int = 5) -> int:
    """Words in windows of ``width`` words that stand twice or more in the text, the first included."""
    n = len(codes) - width + 1
    if n < 2:
        return 0
    window = codes[:n].astype(np.int64)
    for i in range(1, width):
        # code pairs exactly: renumber before a product could leave 64 bits
        if int(window.max() + 1) * int(codes.max() + 1) >= 1 << 62:
            window = np.unique(window, return_inverse=True)[1]
        window = window * (int(codes.max()) + 1) + codes[i : n + i]
    _, inverse, count = np.unique(window, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(count[inverse] > 1)
    if not len(starts):
        return 0
    # width of the union of [s, s + width)
    return int(np.minimum(np.diff(starts), width).sum()) + width


def count_text(text: str | None) -> tuple:
    text = text or ""
    words = text.encode("utf-8", "surrogatepass").split()
    known: dict[bytes, int] = {}
    codes = np.fromiter((known.setdefault(w, len(known)) for w in words), dtype=np.int64, count=len(words))
    seen: set[str] = set()
    dup = 0
    lines: dict[int, list] = {}
    for line in text.split("\n"):
        parts = line.encode("utf-8", "surrogatepass").lower().split()
        if not parts:
            continue
        dup += line in seen
        seen.add(line)
        h = _hash(parts)
        if h not in lines:
            k = min(END_WORDS, len(parts) // 2)
            lines[h] = [_hash(parts[:k], 1), _hash(parts[-k:], 2), 0] if k else [None, None, 0]
        lines[h][2] += len(parts)
    return (
        len(words), len(text) - sum(text.count(c) for c in SPACES), sum(text.count(c) for c in SYMBOLS), dup,
        repeated_words(codes), _signed(xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))),
        [{"hash": h, "head": a, "tail": z, "words": n} for h, (a, z, n) in lines.items()],
    )


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in small(batches):
        counted = [count_text(t) for t in batch.column("text").to_pylist()]
        columns = [pa.array(c, t) for c, t in zip(zip(*counted, strict=True), TYPES, strict=True)] if counted else [
            pa.array([], t) for t in TYPES]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("host"), *columns], names=["id", "host", *NAMES])


def _matched(left: DataFrame, right: DataFrame, how: str, name: str) -> DataFrame:
    """Rows of a host (null is a host) joined where ``name`` is equal; of equal names the left one stays."""
    joined = left.alias("a").join(
        right.alias("b"), F.col("a.host").eqNullSafe(F.col("b.host")) & (F.col(f"a.{name}") == F.col(f"b.{name}")), how)
    if how in ("left_semi", "left_anti"):
        return joined
    return joined.select("a.*", *[F.col(f"b.{c}") for c in right.columns if c not in left.columns])


def _often(rows: DataFrame, name: str, docs: int) -> DataFrame:
    """``host`` and ``name`` of what stands in more than ``docs`` different texts of a host."""
    return (
        rows.select("host", name, "text_hash").distinct().groupBy("host", name).agg(F.count("*").alias("n"))
        .where(F.col("n") > docs).select("host", name)
    )


def _boilerplate(line: DataFrame, docs: int) -> DataFrame:
    """``host, hash`` of the lines that more than ``docs`` groups of near copies of a host have."""
    common = staged(_often(line, "hash", docs), "common")
    holders = _matched(line, common, "left_semi", "hash").select("host", "text_hash").distinct()
    # the lines of texts with a common line, once for equal texts
    inside = staged(
        _matched(line, holders, "left_semi", "text_hash").groupBy("host", "text_hash", "hash").agg(
            F.max("head").alias("head"), F.max("tail").alias("tail")), "inside")
    own = _matched(inside, common, "left_anti", "hash")
    for end in ("head", "tail"):
        own = _matched(own, _often(inside, end, docs), "left_anti", end)
    own = own.groupBy("host", "text_hash").agg(F.bit_xor("hash").alias("own"))
    held = _matched(inside, common, "left_semi", "hash").select("host", "text_hash", "hash")
    groups = _matched(held, own, "left", "text_hash").select("host", "hash", "own").distinct()
    return groups.groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") > docs).select("host", "hash")


def quality_rules(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
    limits: Limits = Limits(),
) -> DataFrame:
    """``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, left_words, kept`` per row."""
    counted = staged(
        pick(docs, id_col, text_col, host_col).toDF("id", "text", "host")
        .select(F.col("id").cast("long").alias("id"), "text", F.col("host").cast("string").alias("host"))
        .mapInArrow(_count, COUNTS),
        "lines",
    )
    line = counted.select("host", "text_hash", F.explode("lines").alias("l")).select("host", "text_hash", "l.*")
    frequent = _boilerplate(line, limits.docs)
    taken = (
        _matched(line, frequent, "left_semi", "hash")
        # equal texts of a host lose the same words
        .groupBy("host", "text_hash", "hash").agg(F.max("words").alias("words"))
        .groupBy("host", "text_hash").agg(F.sum("words").alias("taken"))
    )
    counts = counted.drop("lines")
    failed = (F.col("n_words") < limits.min_words) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * limits.repeat_pct
    )
    left = F.col("n_words") - F.coalesce("taken", F.lit(0))
    return (
        _matched(counts, taken, "left", "text_hash")
        .select(
            "id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            failed.alias("base_failed"), left.alias("left_words"),
            (~failed & (left * 100 >= F.col("n_words") * limits.left_pct)).alias("kept"),
        )
    )


def keep_good(docs: DataFrame, text_col: str = "text", host_col: str = "source", limits: Limits = Limits()) -> DataFrame:
    """The rows of ``docs`` that the rules keep, all columns as they are."""
    rows = keyed(docs)
    plain = rows.select(
        F.col("key").alias("id"), F.col(f"row.`{text_col}`").alias("text"), F.col(f"row.`{host_col}`").alias("host"))
    verdicts = quality_rules(plain, "id", "text", "host", limits)
    rejected = staged(verdicts.where("NOT kept").select(F.col("id").alias("key")).distinct(), "rejected")
    return rows.join(rejected, "key", "left_anti").select("row.*")
