"""Runs of periodic words: Kruskal's algorithm over suffix classes by descending common prefix.

The suffixes of a text's words are sorted; neighbours in that order are joined by an edge that weighs as many words as
they have in common. Edges are taken from heavy to light, and each unites two classes (union-find), whose positions are
kept in order. At an edge of weight w, all suffixes of the two classes have exactly w words in common across, so two
positions p < q that become neighbours in the united class begin a stretch of period q - p that ends w words after q
and can't be carried on to the right. Neighbours have no position between them that would show a smaller period, and
a stretch of at least four periods is missed by no class: every run is found where its first two periods meet, and
only there is the word before it different. Light edges can't give a run and are left out.

Words of all texts of a part are numbered together; the suffix order comes from prefix doubling, where suffixes that
differ from all others leave the next round.

Defined results: null text, and text without a word, has no runs and an empty collapsed text; rows without id, repeated
rows and equal texts are treated like others; an empty table gives an empty table; a text of any length is one row's work;
ties of the longest run go to the smallest start, then period; further columns are not read.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import GAP, binaries, pick, small

WORDS = re.compile(rb"[^ \t-\r]+")
PERIODS = 4  # of a run, at least
LEAST = 6  # words of a run, at least
SIDE = 512  # positions in one list of an ordered set, at most twice as many


class Positions:
    """An ordered set of positions, in lists of bounded length."""

    def __init__(self, position: int):
        self.lists = [[position]]
        self.size = 1

    def __iter__(self) -> Iterator[int]:
        for part in self.lists:
            yield from part

    def add(self, position: int) -> tuple[int | None, int | None]:
        """Adds a position and gives its neighbours."""
        lists = self.lists
        # the last list that begins at or before the position
        low, high = 0, len(lists)
        while high - low > 1:
            middle = (low + high) // 2
            if lists[middle][0] <= position:
                low = middle
            else:
                high = middle
        part = lists[low]
        at = bisect_left(part, position)
        left = part[at - 1] if at else lists[low - 1][-1] if low else None
        right = part[at] if at < len(part) else lists[low + 1][0] if low + 1 < len(lists) else None
        insort(part, position)
        self.size += 1
        if len(part) > 2 * SIDE:
            lists[low : low + 1] = [part[:SIDE], part[SIDE:]]
        return left, right


def suffix_edges(codes: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbours in suffix order with at least ``least`` words in common: these weights, descending, and both positions.

    Numbers below 0 end a text and equal nothing, each other included.
    """
    n = len(codes)
    if not n:
        return (np.zeros(0, dtype=np.int64),) * 3
    # ranks of suffixes by their first 1, 2, 4, ... words: how many suffixes come before the class
    rank = np.where(codes < 0, codes.max() + np.cumsum(codes < 0), codes).astype(np.int64)
    sizes = np.bincount(rank)
    rank = (np.cumsum(sizes) - sizes)[rank]
    levels = [rank.astype(np.int32)]
    # suffixes that equal no other so far need no further round
    sharing = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
    candidates = sharing
    while len(sharing):
        step = 1 << (len(levels) - 1)
        if step <= least:
            candidates = sharing
        behind = np.minimum(sharing + step, n - 1)
        key = rank[sharing] * (n + 1) + np.where(sharing + step < n, rank[behind] + 1, 0)
        order = np.argsort(key, kind="stable")
        key, members = key[order], sharing[order]
        new = np.ones(len(key), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        starts = np.flatnonzero(new)
        old = rank[members[starts]]
        opening = np.ones(len(starts), dtype=bool)
        opening[1:] = old[1:] != old[:-1]
        # the members of an old class stand together: a new class begins as far behind it as it does here
        fresh = old + starts - np.maximum.accumulate(np.where(opening, starts, 0))
        counts = np.diff(np.append(starts, len(key)))
        rank[members] = np.repeat(fresh, counts)
        levels.append(rank.astype(np.int32))
        sharing = np.sort(members[np.repeat(counts > 1, counts)])
    if 1 << (len(levels) - 1) <= least:
        candidates = sharing
    candidates = candidates[np.argsort(rank[candidates], kind="stable")]
    a, b = candidates[:-1], candidates[1:]
    common = np.zeros(len(a), dtype=np.int64)
    for level in range(len(levels) - 1, -1, -1):
        x, y = a + common, b + common
        same = (x < n) & (y < n) & (levels[level][np.minimum(x, n - 1)] == levels[level][np.minimum(y, n - 1)])
        common += same.astype(np.int64) << level
    keep = np.flatnonzero(common >= least)
    keep = keep[np.argsort(-common[keep], kind="stable")]
    return common[keep], a[keep], b[keep]


def find_runs(codes: np.ndarray, periods: int = PERIODS, least: int = LEAST) -> np.ndarray:
    """Start, length and period of every run of the numbers, in this order; numbers below 0 end a text.

    A run has at least ``least`` words and ``periods`` (2 or more) times its period.
    """
    # words that a stretch of period p has in common with itself p further on
    lightest = min(max(least - p, (periods - 1) * p) for p in range(1, least + 1))
    edges = zip(*(c.tolist() for c in suffix_edges(codes, lightest)), strict=True)
    sets: dict[int, Positions] = {}
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent[root] != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    found = []

    def neighbours(p: int, q: int, common: int) -> None:
        period, length = q - p, q - p + common
        if length >= max(least, periods * period) and (p == 0 or codes[p - 1] != codes[q - 1]):
            found.append((p, length, period))

    for common, left, right in edges:
        for x in (left, right):
            if x not in parent:
                parent[x], sets[x] = x, Positions(x)
        a, b = find(left), find(right)
        if sets[a].size < sets[b].size:
            a, b = b, a
        large, few = sets[a], list(sets.pop(b))
        parent[b] = a
        # in ascending order: what is before a position stays there, what is after it may be parted by the next one
        for previous, x, following in zip([None, *few], few, [*few[1:], None], strict=False):
            before, after = large.add(x)
            if before is not None and before != previous:
                neighbours(before, x, common)
            if after is not None and (following is None or after < following):
                neighbours(x, after, common)
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 3)


RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = pa.schema([("id", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(RUN)), ("collapsed", pa.string())])


def _part(ids: pa.Array, texts: list[bytes | None], periods: int, least: int) -> pa.RecordBatch:
    words = [WORDS.findall(t or b"") for t in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    ends = np.cumsum(counts + 1)
    starts = ends - counts - 1
    numbers: dict[bytes, int] = {}
    codes = np.full(int(ends[-1]) if len(ends) else 0, -1, dtype=np.int64)
    for at, w in zip(starts.tolist(), words, strict=True):
        codes[at : at + len(w)] = np.fromiter((numbers.setdefault(x, len(numbers)) for x in w), np.int64, len(w))
    found = find_runs(codes, periods, least)
    text_of = np.searchsorted(ends, found[:, 0], side="right")
    # what a run holds after its first period goes
    change = np.zeros(len(codes) + 1, dtype=np.int64)
    np.add.at(change, found[:, 0] + found[:, 2], 1)
    np.add.at(change, found[:, 0] + found[:, 1], -1)
    kept = np.cumsum(change)[:-1] == 0
    collapsed = []
    touched = set(text_of.tolist())
    for k, (at, w) in enumerate(zip(starts.tolist(), words, strict=True)):
        collapsed.append(b" ".join(compress(w, kept[at : at + len(w)].tolist()) if k in touched else w))
    values = pa.StructArray.from_arrays(
        [pa.array(c) for c in (found[:, 0] - starts[text_of], found[:, 1], found[:, 2])], fields=list(RUN))
    offsets = np.concatenate([[0], np.cumsum(np.bincount(text_of, minlength=len(words)))]).astype(np.int32)
    return pa.RecordBatch.from_arrays([
        ids, pa.array(counts), pa.ListArray.from_arrays(pa.array(offsets), values, type=pa.list_(RUN)),
        pa.array(collapsed, pa.binary()).cast(pa.string()),
    ], schema=FOUND)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", periods: int = PERIODS, least: int = LEAST,
) -> DataFrame:
    """``id, n_words, runs, collapsed`` per row: all runs by start and period, and the text without their repetitions,
    one blank between words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches, size=2 << 20):
            yield _part(batch.column("id"), binaries(batch.column("text")), periods, least)

    rows = pick(docs, id_col, text_col).toDF("id", "text")
    return rows.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, from_arrow_schema(FOUND))


def with_planted_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col, text_col``; a tenth of the texts, by a checksum of the id, gets a tail that repeats a few of its words.

    Of these, word ``i >= a`` becomes word ``a + (i - a) % p``, with a and p from the checksum and the number of words."""
    checksum = F.crc32(F.col("id").cast("string"))
    g = F.floor(checksum / 10)
    words = F.filter(F.split("text", GAP), lambda w: w != "")

    def tail(w: Column) -> Column:
        n = F.size(w)
        a = (g % n).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        at = F.sequence(F.lit(0), n - 1)
        return F.when(n > 0, F.array_join(F.transform(
            at, lambda i: F.get(w, F.when(i < a, i).otherwise(a + (i - a) % p))), " ")).otherwise(F.lit(""))

    # the array around the words makes them a variable: they are split once
    edited = F.get(F.transform(F.array(words), tail), F.lit(0))
    rows = pick(docs, id_col, text_col).toDF("id", "text").select("id", F.col("text").cast("string").alias("text"))
    return rows.select(
        F.col("id").alias(id_col), F.when(checksum % 10 == 0, edited).otherwise(F.col("text")).alias(text_col))


def digests(found: DataFrame) -> DataFrame:
    """Per row of ``periodic_runs`` the longest run and checksums of all runs and of the collapsed text."""
    order = F.array_sort(F.transform("runs", lambda r: F.struct(
        (-r["length"]).alias("less"), r["start"].alias("start"), r["period"].alias("period"))))
    longest = F.get(order, F.lit(0))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    return found.select(
        "id", F.size("runs").cast("long").alias("n_runs"), longest.alias("longest"), "collapsed", lines.alias("lines"),
    ).select(
        "id", "n_runs", F.col("longest.start").alias("start"), (-F.col("longest.less")).alias("length"),
        F.col("longest.period").alias("period"),
        F.expr("-1000 * longest.less div longest.period").alias("exponent_milli"),
        F.sha2("lines", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
