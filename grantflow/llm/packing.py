"""Sequence packing by Karmarkar-Karp multiway differencing.

Documents become token ids plus an end id. Whole pieces of ``capacity`` tokens fill a sequence each; the rests are
dealt into groups of bounded size by a hash, and each group is packed on its own. Inside a group every rest starts
as a partial partition (one filled window, the others empty); the two partial partitions of the largest spread are
merged with opposing order - the fullest windows of one meet the emptiest of the other - until one is left with
near-equal windows. Where a window exceeds the capacity, the window count rises (``cut=False``), or, where documents
may be cut freely, the overflow of that window is cut off and fills the room of others (``cut=True``; a group then
leaves less than one window empty).

Ids are those of ``tokenizers``. Texts of plain Latin script go through the merge ranks of the same vocabulary in
``tiktoken``, which gives the same ids several times faster; every other text (other scripts, marks of special tokens,
very long words or gaps, a vocabulary without a ranks file) goes through ``tokenizers`` itself.

Defined results: null text is an empty text (one end id); documents without id are packed too; repeated rows are
packed once each; an empty table gives no pieces; further columns are not read.
"""

from __future__ import annotations

import base64
import heapq
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import pick, small

CAPACITY = 1024
GROUP_DOCS = 1500  # rests packed together: work and memory of one group stay bounded at every size
_LONGS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
PIECES = pa.schema([(n, pa.int64()) for n in _LONGS] + [("ids", pa.binary()), ("slot", pa.int64())])
PACKED = pa.schema([(n, pa.int64()) for n in [*_LONGS, "sequence_id", "offset"]])
# printable ASCII and Latin letters, on which all Unicode versions agree; words and gaps of bounded length
PLAIN = re.compile("(?:[!-~\u00a1-\u024f]{0,400}[ \\t\\n\\r]{1,400})*+[!-~\u00a1-\u024f]{0,400}")


class Encoder:
    """Little-endian unsigned 32-bit ids of a text."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.marks = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        ranks = path.removesuffix(".json") + ".tiktoken"
        self.plain = None
        if os.path.exists(ranks):
            import tiktoken

            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.plain = tiktoken.Encoding(
                "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})

    def encode(self, text: str) -> bytes:
        if self.plain and PLAIN.fullmatch(text) and not any(m in text for m in self.marks):
            return self.plain.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
        ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()


def difference(sizes: np.ndarray, windows: int) -> np.ndarray:
    """Window of each size by multiway differencing; ties fall by position."""
    n = len(sizes)
    parent = np.arange(n)
    # a partial partition: sums of its non-empty windows, largest first, and an item that stands for each window
    heap = [(-int(s), i, np.array([s], dtype=np.int64), np.array([i])) for i, s in enumerate(sizes)]
    heapq.heapify(heap)
    for tick in range(n, 2 * n - 1):
        _, _, a, ai = heapq.heappop(heap)
        _, _, b, bi = heapq.heappop(heap)
        over = len(a) + len(b) - windows
        if over > 0:
            # the fullest windows of a meet the empty ones of b and the other way round; the rest meet in opposing order
            at = np.arange(len(a) - over, len(a))
            bt = np.arange(len(b) - 1, len(b) - 1 - over, -1)
            parent[bi[bt]] = ai[at]
            sums = np.concatenate([a[: len(a) - over], a[at] + b[bt], b[: len(b) - over]])
            items = np.concatenate([ai, bi[: len(b) - over]])
        else:
            sums, items = np.concatenate([a, b]), np.concatenate([ai, bi])
        order = np.argsort(-sums, kind="stable")
        sums, items = sums[order], items[order]
        if len(sums) == windows:
            spread = int(sums[0] - sums[-1])
        else:
            spread = int(sums[0])
        heapq.heappush(heap, (-spread, tick, sums, items))
    if not n:
        return parent
    items = heap[0][3]
    while True:
        up = parent[parent]
        if (up == parent).all():
            break
        parent = up
    place = np.full(n, -1)
    place[items] = np.arange(len(items))
    return place[parent]


def fill(sizes: np.ndarray, capacity: int, cut: bool) -> list[tuple[int, int, int, int]]:
    """``(item, from, length, window)`` that place every item; each window holds at most ``capacity``."""
    total = int(sizes.sum())
    windows = -(-total // capacity)
    while True:
        place = difference(sizes, windows) if len(sizes) else np.empty(0, dtype=np.int64)
        loads = np.bincount(place, weights=sizes, minlength=windows).astype(np.int64) if len(sizes) else np.empty(0)
        if cut or not len(sizes) or loads.max() <= capacity:
            break
        # the window count rises with what exceeds the capacity
        windows += max(1, int((np.maximum(loads - capacity, 0).sum()) // (4 * capacity)))
    pieces, loose = [], []
    held = np.zeros(windows, dtype=np.int64)
    for item in np.lexsort((-sizes, place)):
        size, window = int(sizes[item]), int(place[item])
        fits = min(size, capacity - int(held[window]))
        if fits:
            pieces.append((int(item), 0, fits, window))
            held[window] += fits
        if fits < size:
            loose.append((int(item), fits, size - fits))
    room = iter(np.argsort(held, kind="stable"))
    window = -1
    for item, start, size in loose:
        while size:
            while window < 0 or held[window] == capacity:
                window = int(next(room))
            fits = min(size, capacity - int(held[window]))
            pieces.append((item, start, fits, window))
            held[window] += fits
            start, size = start + fits, size - fits
    return pieces


def _pieces(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in small(batches):
            rows = []
            encoded = (encoder.encode(t or "") for t in batch.column("text").to_pylist())
            for doc, mark, ids in zip(
                batch.column("id").to_pylist(), batch.column("mark").to_pylist(), encoded, strict=True
            ):
                ids += bytes(4)
                count = len(ids) // 4
                for start in range(0, count, capacity):
                    part = ids[4 * start : 4 * (start + capacity)]
                    size = len(part) // 4
                    # two bytes an id where they fit; whole sequences need no ids any more
                    rest = None if size == capacity else _narrow(part)
                    rows.append((doc, start, size, zlib.crc32(part), count, rest, mark + start // capacity))
            yield pa.RecordBatch.from_pylist([dict(zip(PIECES.names, r, strict=True)) for r in rows], PIECES)
    return run


def _narrow(ids: bytes) -> bytes:
    wide = np.frombuffer(ids, "<u4")
    return (wide.astype("<u2") if wide.max() < 1 << 16 else wide).tobytes()


def _pack(capacity: int, cut: bool):
    def run(key: tuple, group: pa.Table) -> pa.Table:
        base = key[0].as_py() << 32
        group = group.sort_by([("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
        rows = group.select(PACKED.names[:5]).to_pylist()
        ids = group.column("ids").to_pylist()
        rests = [i for i, x in enumerate(ids) if x is not None]
        sizes = np.array([rows[i]["length"] for i in rests], dtype=np.int64)
        out, used = [], {}
        for item, start, size, window in fill(sizes, capacity, cut):
            row = dict(rows[rests[item]])
            if size != row["length"]:
                held = ids[rests[item]]
                part = np.frombuffer(held, "<u2" if len(held) == 2 * row["length"] else "<u4")[start : start + size]
                row |= {"start": row["start"] + start, "length": size, "ids_crc32": zlib.crc32(part.astype("<u4").tobytes())}
            offset = used.get(window, 0)
            used[window] = offset + size
            out.append(row | {"sequence_id": base + window, "offset": offset})
        after = base + max(used, default=-1) + 1
        whole = (i for i, x in enumerate(ids) if x is None)
        out += [rows[i] | {"sequence_id": after + n, "offset": 0} for n, i in enumerate(whole)]
        return pa.Table.from_pylist(out, PACKED)
    return run


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
    tokenizer: str = "byte_bpe_50k.json", cut: bool = True, group_docs: int = GROUP_DOCS,
) -> DataFrame:
    """One row per piece; see PACKED. ``tokenizer`` is a name of the public tokenizer files or a path."""
    path = tokenizer if "/" in tokenizer else public_tokenizers.path(tokenizer)
    groups = max(1, -(-docs.count() // group_docs))
    pieces = (
        pick(docs, id_col, text_col).toDF("id", "text")
        .select(
            F.col("id").cast("long").alias("id"), "text",
            # spreads documents, also those without id, and the pieces of a long one
            F.expr("shiftrightunsigned(xxhash64(id, text), 2)").alias("mark"),
        )
        .mapInArrow(_pieces(path, capacity), from_arrow_schema(PIECES))
    )
    return (
        pieces.select(F.pmod("slot", F.lit(groups)).alias("grp"), *PIECES.names[:-1])
        .groupBy("grp").applyInArrow(_pack(capacity, cut), from_arrow_schema(PACKED))
    )
