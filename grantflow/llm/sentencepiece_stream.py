"""SentencePiece encoding and decoding as a stream.

The model is a merge (BPE) model, whose segmentation isn't the one with the best sum of scores; but it has a
dynamic program of its own. Merging never looks across a boundary that it leaves, so a sequence of pieces is the
encoding of its text exactly if every piece encodes to itself and every two neighbours encode to themselves. Hence the
encoding of each prefix has one last piece, found from the prefixes that end within the longest piece before it: a
Viterbi recursion in which an admissible path survives instead of the best one.

The encoder reads text in parts of any size and keeps back pointers for a window of at most twice the longest piece. It
commits ids where the paths of all prefixes that a later piece can start from meet in one boundary: when the window is
full, and wherever no piece can cross a boundary (before a blank that follows something else, say), as all paths meet
there. The ids of the units between such boundaries are kept in a bounded table.

Characters without a piece are written as bytes. Decoding reverses all of it.

Defined results: null and empty text has no ids; blanks, line ends and marks of special pieces in a text are ordinary
text; rows without id and repeated rows are encoded like others; an empty table gives an empty table; further
columns are not read.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import pick, small

BLANK = "▁"
TABLE = 300_000  # units, and pairs of pieces, kept at once in a task
LETTER = re.compile(r"[^\W\d_]")


class Vocabulary:
    """Pieces of a model: ids, merge order, byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        special = {i for i in ids if model.is_control(i) or model.is_unknown(i) or model.is_unused(i)}
        self.bytes = {int(model.id_to_piece(i)[1:-1], 16): i for i in ids if model.is_byte(i)}
        self.ids = {model.id_to_piece(i): i for i in ids if i not in special and not model.is_byte(i)}
        self.score = {piece: model.get_score(i) for piece, i in self.ids.items()}
        self.longest = max(map(len, self.ids))
        self.starts = {p[:k] for p in self.ids for k in range(1, len(p))}
        self.unit = self._unit_pattern()
        self.text = [b"" if i in special else None for i in ids]
        for value, i in self.bytes.items():
            self.text[i] = bytes([value])
        for piece, i in self.ids.items():
            self.text[i] = piece.replace(BLANK, " ").encode("utf-8", "surrogatepass")

        # merge order of each piece, single characters before all
        order = sorted({s for p, s in self.score.items() if len(p) > 1}, reverse=True)
        place = {s: i for i, s in enumerate(order)}
        self.order = {p: place[s] if len(p) > 1 else -1 for p, s in self.score.items()}
        self.halves: dict[str, tuple[str, str] | None] = {}
        self.codes = {p: i.to_bytes(4, "little") for p, i in self.ids.items()}
        self.sure: dict[str, bool | None] = dict.fromkeys(self.order)  # whether a piece encodes to itself, once known

    def _unit_pattern(self) -> re.Pattern | None:
        """Cuts text where no piece crosses: before blanks, around line ends without a piece, and between a letter and
        a mark that follows no letter in any piece. None if pieces go on after a blank."""
        if any(BLANK in p.lstrip(BLANK) for p in self.ids):
            return None
        after = {b for p in self.ids for a, b in zip(p, p[1:]) if LETTER.match(a)}
        m = re.escape("".join(c for c in string.punctuation if c not in after))
        e = re.escape("".join(c for c in "\n\t\r" if c not in self.ids))
        more = f"(?:(?<!{LETTER.pattern})[{m}]|[^{BLANK}{m}{e}])*" if m else f"[^{BLANK}{e}]*"
        return re.compile(f"{BLANK}*[^{BLANK}{e}]{more}" + (f"|{BLANK}*[{e}]+" if e else "") + f"|{BLANK}+")

    def merged(self, text: str, until: int = 1) -> list[str]:
        """Merging by definition: the pair with the best score first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > until:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = self.score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if at < 0:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, piece: str) -> tuple[str, str] | None:
        """The two pieces whose merge makes ``piece``; None if merging its characters doesn't lead to it."""
        if piece not in self.halves:
            parts = self.merged(piece, 2)
            self.halves[piece] = tuple(parts) if len(parts) == 2 and piece in self.order else None
        return self.halves[piece]

    def code(self, piece: str) -> bytes:
        """The id of a piece, or those of the bytes of a character without one, four bytes each."""
        known = self.codes.get(piece)
        if known is None:
            known = self.codes[piece] = np.array(
                [self.bytes[b] for b in piece.encode("utf-8", "surrogatepass")], dtype="<u4").tobytes()
        return known

    def itself(self, piece: str) -> bool:
        return len(piece) == 1 or piece in self.order and self.split(piece) is not None

    def neighbours(self, a: str, b: str) -> bool:
        """Whether ``a + b`` is encoded as these two pieces: undo their merges, the later one first, and see whether the
        pieces that face each other would have been merged before. Of equal merges the left one comes first."""
        order, limit = self.order, 2 * len(self.order)
        while True:
            joined = order.get(a + b)
            if joined is not None and 2 * joined < limit:
                return False
            # a character without a piece merges with nothing
            made_a, made_b = order.get(a, -1), order.get(b, -1)
            if made_a < 0 and made_b < 0:
                return True
            if made_a > made_b:
                limit, a = 2 * made_a, self.split(a)[1]
            else:
                limit, b = 2 * made_b + 1, self.split(b)[0]


class Stream:
    """Encodes text fed in parts; ``commits`` counts boundaries, ``widest`` the most characters held back."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.pairs: dict[tuple[str, str], bool] = {}
        self.table: dict[str, bytes] = {}
        self.commits = self.widest = 0
        self.reset()

    def reset(self) -> None:
        self.window = ""  # text after the last commit
        self.last: list[str] = [""]  # last piece of each prefix of the window
        self.before = ""  # last committed piece

    def _neighbours(self, a: str, b: str) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) > TABLE:
                self.pairs.clear()
            known = self.pairs[a, b] = self.v.neighbours(a, b)
        return known

    def _extend(self, window: str, last: list[str], begin: int) -> None:
        """The last pieces of the prefixes of ``window`` that end after ``begin``. Exactly one is admissible for each, and
        short ones are the likely ones."""
        sure, pairs, longest = self.v.sure, self.pairs, self.v.longest
        for end in range(begin + 1, len(window) + 1):
            for start in range(end - 1, end - longest - 1 if end > longest else -1, -1):
                piece = window[start:end]
                fits = sure.get(piece, start == end - 1)
                if fits is None:
                    fits = sure[piece] = self.v.itself(piece)
                if fits:
                    previous = last[start] if start else self.before
                    if previous:
                        fits = pairs.get((previous, piece))
                        if fits is None:
                            fits = self._neighbours(previous, piece)
                    if fits:
                        last.append(piece)
                        break
            else:
                raise ValueError(f"no path to {window!r}")

    def push(self, text: str) -> list[str]:
        """More characters; gives the pieces that are certain by now. The paths are followed back at the end of the text and
        whenever the window is twice as long as the longest piece."""
        certain, full = [], 2 * self.v.longest
        at = 0
        while at < len(text):
            begin = len(self.window)
            self.window += text[at : at + full - begin]
            at += full - begin
            self._extend(self.window, self.last, begin)
            self.widest = max(self.widest, len(self.window))
            certain += self._commit()
        return certain

    def _commit(self) -> list[str]:
        """Follow back the paths of all prefixes that a later piece can start from until they meet."""
        end = len(self.window)
        ends = {end}
        ends.update(e for e in range(max(0, end - self.v.longest + 1), end) if self.window[e:] in self.v.starts)
        while len(ends) > 1:
            far = max(ends)
            ends.discard(far)
            ends.add(far - len(self.last[far]))
        return self._take(ends.pop())

    def _take(self, boundary: int) -> list[str]:
        pieces = []
        at = boundary
        while at > 0:
            pieces.append(self.last[at])
            at -= len(self.last[at])
        if pieces:
            pieces.reverse()
            self.before = pieces[-1]
            self.window, self.last = self.window[boundary:], [""] + self.last[boundary + 1 :]
            self.commits += 1
        return pieces

    def finish(self) -> list[str]:
        pieces = self._take(len(self.window))
        self.reset()
        return pieces

    def _bytes(self, pieces: Iterable[str]) -> bytes:
        return b"".join(map(self.v.code, pieces))

    def _ids(self, pieces: Iterable[str]) -> list[int]:
        return np.frombuffer(self._bytes(pieces), dtype="<u4").tolist()

    def learn(self, units: Iterable[str]) -> None:
        """Ids of units into the table. They come sorted, so that the window of one is good for the next as far as both
        begin alike."""
        window, last, full, code = "", [""], 2 * self.v.longest, self.v.code
        for unit in sorted(units):
            if len(unit) >= full:
                self.table[unit] = self._bytes(self.push(unit) + self.finish())
                continue
            same = 0
            for x, y in zip(window, unit, strict=False):
                if x != y:
                    break
                same += 1
            del last[same + 1 :]
            window = unit
            self._extend(window, last, same)
            # all paths meet at its end: commit
            pieces, at = [], len(unit)
            while at:
                pieces.append(code(last[at]))
                at -= len(last[at])
            self.commits += 1
            pieces.reverse()
            self.table[unit] = b"".join(pieces)

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of texts, unit by unit where the model allows that: at the end of a unit all paths meet. Finished units are
        kept, a bounded number."""
        marked = [BLANK + t.replace(" ", BLANK) if t else "" for t in texts]
        if not self.v.unit:
            return [self._streamed(m) for m in marked]
        rows = [self.v.unit.findall(m) for m in marked]
        if len(self.table) > TABLE:
            self.table.clear()
        self.learn(set().union(*rows).difference(self.table))
        return [np.frombuffer(b"".join(map(self.table.__getitem__, units)), dtype="<u4") for units in rows]

    def _streamed(self, marked: str) -> np.ndarray:
        parts = [self._bytes(self.push(marked[at : at + 4096])) for at in range(0, len(marked), 4096)]
        return np.frombuffer(b"".join([*parts, self._bytes(self.finish())]), dtype="<u4")

    def encode_array(self, text: str) -> np.ndarray:
        return self.encode_all([text])[0]

    def encode(self, text: str) -> Iterator[int]:
        return iter(self.encode_array(text).tolist())


def decode(ids: Iterable[int], v: Vocabulary) -> str:
    """Text of ids; the blank in front that encoding adds goes, bytes that are no UTF-8 become U+FFFD."""
    data = b"".join([v.text[i] for i in ids])
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


ENCODED = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("ids", pa.list_(pa.int32()))])
ROUND_TRIP = pa.schema([
    ("id", pa.int64()), ("n_chars", pa.int64()), ("n_ids", pa.int64()), ("n_byte_ids", pa.int64()),
    ("ids_crc32", pa.int64()), ("round_trip", pa.bool_())])


def _path(model: str) -> str:
    return model if "/" in model else public_tokenizers.path(model)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model") -> DataFrame:
    """``id, n_chars, ids`` per row."""
    path = _path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(Vocabulary(path))
        for batch in small(batches):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(t) for t in texts], pa.int64()),
                pa.array([ids.astype(np.int32) for ids in stream.encode_all(texts)], pa.list_(pa.int32())),
            ], schema=ENCODED)

    return _rows(docs, id_col, text_col).mapInArrow(run, from_arrow_schema(ENCODED))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = "piece_bpe_32k.model") -> DataFrame:
    """Encode and decode every row: counts and checksum of the ids, and whether the text came back."""
    path = _path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = Vocabulary(path)
        stream = Stream(v)
        in_bytes = np.zeros(len(v.text), dtype=bool)
        in_bytes[list(v.bytes.values())] = True
        for batch in small(batches):
            rows = []
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for doc, text, ids in zip(batch.column("id").to_pylist(), texts, stream.encode_all(texts), strict=True):
                rows.append((doc, len(text), len(ids), int(in_bytes[ids].sum()), zlib.crc32(ids.tobytes()),
                             decode(ids.tolist(), v) == text))
            yield pa.RecordBatch.from_pylist([dict(zip(ROUND_TRIP.names, r, strict=True)) for r in rows], ROUND_TRIP)

    return _rows(docs, id_col, text_col).mapInArrow(run, from_arrow_schema(ROUND_TRIP))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return pick(docs, id_col, text_col).toDF("id", "text").select(F.col("id").cast("long").alias("id"), "text")
