"""BPE encoding and decoding by a traversal of a trie of words.

Merging never looks across a boundary that it leaves. So a sequence of tokens is the encoding of its text exactly if each
token, and each two neighbours, encode to themselves; and the encoding of a prefix, without its last token, is that of a
shorter prefix. The state of a prefix is its last token: of the tokens that end there, exactly one follows the last token
of the prefix before it. Distinct words are inserted into a trie of symbols; a depth-first walk carries the states of the
path along, so a prefix that words share is encoded once, and a word's tokens are read off by going back along the path.
The last symbol of a word is marked as such, so it is a symbol of its own.

Around it: special tokens are cut out of the text first; the rest is normalised (NFC, lower case), split into words and
written in bytes, each byte as a character, as the tokenizer's file says. Words of common scripts are split by patterns of
their own; texts with other characters, about which versions of Unicode differ, by the tokenizer library's normaliser and
splitter. Ids equal the library's.

Decoding joins the tokens with blanks, marks of word ends included: the file names no decoder.

Defined results: null and empty text has no ids and decodes to an empty text; rows without id, repeated rows and equal
texts are treated like others; an empty table gives an empty table; words and texts of any length are encoded whole;
further columns are not read.
"""

from __future__ import annotations

import json
import math
import re
import struct
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import pick, small

MODEL = "word_bpe_49k.json"
TABLE = 300_000  # finished words, and pairs of tokens, kept at once in a task
# Characters on which all versions of Unicode in use agree: Latin to Arabic, punctuation, kana, Han, Hangul.
FAMILIAR = re.compile(  # a character that is none of these
    "[^\x00-\u036f\u0384-\u052f\u0531-\u0556\u0561-\u0586\u05d0-\u05ea\u0620-\u064a\u2000-\u206f\u20a0-\u20b9"
    "\u2190-\u23cf\u2500-\u27bf\u3000-\u30ff\u4e00-\u9fa5\uac00-\ud7a3\U0001f300-\U0001f5ff]")
# On all others the classes of both pattern libraries agree.
UNLIKE = re.compile("[^\t-\r -~\u00c0-\u024f\u0391-\u03c9\u0400-\u0481\u2010-\u2027\u2030-\u205e]")
LAST = 0x1000  # from a symbol to the one that ends a word


def byte_characters() -> list[str]:
    """The character that stands for each byte: itself where it is visible, else one from 256 on, in order."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


class Node:
    """A place in the trie: the symbols that lead to it, those that follow, and the word that ends here."""

    __slots__ = ("following", "label", "word")

    def __init__(self, label: str, word: str | None = None):
        self.label, self.word = label, word
        self.following: dict[str, Node] = {}


def insert(root: Node, symbols: str, word: str) -> None:
    """Adds a word; an edge is parted where the word leaves it."""
    node, at = root, 0
    while at < len(symbols):
        child = node.following.get(symbols[at])
        if child is None:
            node.following[symbols[at]] = Node(symbols[at:], word)
            return
        label = child.label
        if not symbols.startswith(label, at):
            same = 1
            while at + same < len(symbols) and label[same] == symbols[at + same]:
                same += 1
            upper = Node(label[:same])
            upper.following[label[same]] = child
            child.label = label[same:]
            node.following[symbols[at]] = child = upper
        node, at = child, at + len(child.label)
    node.word = word


class Edges(NamedTuple):
    """What stands at an end of a token while it is merged from symbols, and the rank of the merge that ends that."""

    parts: list[str]
    until: list[float]


class Bpe:
    """Encodes texts; keeps a bounded table of finished words."""

    def __init__(self, path: str, table: int = TABLE):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.end = model["end_of_word_suffix"]
        # in symbols: a character for each byte, another one at the end of a word
        self.ids = {self._symbols(token): i for token, i in model["vocab"].items()}
        merges = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        self.rank = {(self._symbols(x), self._symbols(y)): k for k, (x, y) in enumerate(merges)}
        self.longest = max(map(len, self.ids))
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: t for t, i in [*model["vocab"].items(), *self.special.items()]}
        self.names = [tokens.get(i, "") for i in range(max(tokens) + 1)]
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.split = regex.compile(pattern)
        self.split_simple = re.compile(
            pattern.replace(r"^\s\p{L}\p{N}", r"^\s\w").replace(r"[^\s\w]+", r"(?:[^\s\w]|_)+")
            .replace(r"[\p{L}]", r"[^\W\d_]").replace(r"[\p{N}]", r"\d"))
        self.bytes = byte_characters()
        self.path, self.library = path, None
        self.table = table
        self.words: dict[str, bytes] = {}
        self.follows: dict[tuple[str, str], bool] = {}
        self.edges: dict[str, tuple[Edges, Edges] | None] = {}

    def _symbols(self, token: str) -> str:
        """A token, or a word with the mark of its end, in symbols."""
        if not token.endswith(self.end) or token == self.end:
            return token
        last = token[-len(self.end) - 1]
        return token[: -len(self.end) - 1] + chr(ord(last) + LAST)

    def _edges(self, token: str) -> tuple[Edges, Edges] | None:
        """Both ends of a token as it is merged: always the pair of lowest rank, the first one. None if other tokens come
        out."""
        if token not in self.edges:
            parts, rank = list(token), self.rank
            first, last = Edges([parts[0]], []), Edges([parts[-1]], [])
            while len(parts) > 1:
                best, at = min((rank.get(pair, math.inf), k) for k, pair in enumerate(pairwise(parts)))
                if best == math.inf:
                    break
                if at == 0:
                    first.until.append(best)
                    first.parts.append(parts[0] + parts[1])
                if at == len(parts) - 2:
                    last.until.append(best)
                    last.parts.append(parts[-2] + parts[-1])
                parts[at : at + 2] = [parts[at] + parts[at + 1]]
            for edge in (first, last):
                edge.until.append(math.inf)
            self.edges[token] = (first, last) if len(parts) == 1 else None
        return self.edges[token]

    def _neighbours(self, left: str, right: str) -> bool:
        """Whether two tokens (the left one may be missing) stay as they are next to each other: at no time is the pair
        across their border the one to be merged. A pair's rank is above those of the merges that made its parts."""
        known = self.follows.get((left, right))
        if known is not None:
            return known
        if len(self.follows) > 4 * self.table:
            self.follows.clear()
        ends = self._edges(right)
        known = ends is not None
        if known and left:
            a, b = self._edges(left)[1], ends[0]
            i = j = 0
            while True:
                rank = self.rank.get((a.parts[i], b.parts[j]), math.inf)
                # of equal pairs the first is merged: one inside the left token comes before that across the border
                if rank < a.until[i] and rank <= b.until[j] and rank < math.inf:
                    known = False
                    break
                if a.until[i] == b.until[j] == math.inf:
                    break
                if a.until[i] <= b.until[j]:
                    i += 1
                else:
                    j += 1
        self.follows[left, right] = known
        return known

    def add(self, words: Iterable[str]) -> None:
        """Encodes words that aren't in the table."""
        root = Node("")
        for word in words:
            chars = word if word.isascii() and word.isprintable() else "".join([self.bytes[b] for b in word.encode("utf-8")])
            insert(root, self._symbols(chars + self.end), word)
        # along the path: symbols, and the last token of each prefix
        path, last = "", []
        ids, follows, longest = self.ids, self.follows, self.longest
        stack = [(child, 0) for child in root.following.values()]
        while stack:
            node, depth = stack.pop()
            path = path[:depth] + node.label
            del last[depth:]
            for end in range(depth + 1, len(path) + 1):
                for start in range(end - 1, max(0, end - longest) - 1, -1):
                    token = path[start:end]
                    if token in ids:
                        pair = (last[start - 1] if start else "", token)
                        fits = follows.get(pair)
                        if fits or fits is None and self._neighbours(*pair):
                            last.append(token)
                            break
                else:
                    raise ValueError(f"no token ends {path[max(0, end - longest):end]!r}")
            if node.word is not None:
                tokens, at = [], len(path)
                while at:
                    token = last[at - 1]
                    tokens.append(ids[token])
                    at -= len(token)
                self.words[node.word] = struct.pack(f"<{len(tokens)}I", *reversed(tokens))
            stack += [(child, len(path)) for child in node.following.values()]

    def _library_words(self, text: str) -> list[str]:
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_file(self.path)
        value = {c: b for b, c in enumerate(self.bytes)}
        normal = self.library.normalizer.normalize_str(text)
        return [bytes([value[c] for c in word]).decode("utf-8") for word, _ in self.library.pre_tokenizer.pre_tokenize_str(normal)]

    def _words(self, text: str) -> list[str]:
        """The words of a text without special tokens."""
        if not text.isascii():
            if FAMILIAR.search(text):
                return self._library_words(text)
            # the lower case of a sigma doesn't depend on its place here
            text = unicodedata.normalize("NFC", text).replace("\u03a3", "\u03c3")
        return (self.split if UNLIKE.search(text) else self.split_simple).findall(text.lower())

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, little-endian, four bytes each."""
        if len(self.words) > self.table:
            self.words.clear()
        rows: list[list[list[str] | bytes]] = []
        for text in texts:
            pieces = self.cut.split(text) if "<|" in text else [text]
            rows.append([self.special[p].to_bytes(4, "little") if p in self.special else self._words(p) for p in pieces if p])
        new = set().union(*(piece for row in rows for piece in row if isinstance(piece, list))).difference(self.words)
        if new:
            self.add(new)
        word = self.words.__getitem__
        return [b"".join([p if isinstance(p, bytes) else b"".join(map(word, p)) for p in row]) for row in rows]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included."""
        return " ".join(map(self.names.__getitem__, ids.tolist()))


ENCODED = pa.schema([("id", pa.int64()), ("ids", pa.list_(pa.int32()))])
CODED = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_bytes", pa.binary()), ("decoded", pa.string())])


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = pick(docs, id_col, text_col).toDF("id", "text")
    return rows.select(F.col("id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))


def _path(model: str) -> str:
    return model if "/" in model else public_tokenizers.path(model)


def encode(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``id, ids`` per row."""
    path = _path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        for batch in small(batches, size=2 << 20):
            data = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
            offsets = np.cumsum([0, *(len(d) // 4 for d in data)]).astype(np.int32)
            ids = pa.array(np.frombuffer(b"".join(data), dtype="<i4"))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), ids)], schema=ENCODED)

    return _rows(docs, id_col, text_col).mapInArrow(run, from_arrow_schema(ENCODED))


def round_trip(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str = MODEL) -> DataFrame:
    """``id, n_tokens, ids_bytes, decoded`` per row: the ids as little-endian 32-bit numbers, and the text of them."""
    path = _path(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = Bpe(path)
        for batch in small(batches, size=2 << 20):
            data = bpe.encode([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_arrays([
                batch.column("id"), pa.array([len(d) // 4 for d in data], pa.int64()), pa.array(data, pa.binary()),
                pa.array([bpe.decode(np.frombuffer(d, dtype="<u4")) for d in data], pa.string()),
            ], schema=CODED)

    return _rows(docs, id_col, text_col).mapInArrow(run, from_arrow_schema(CODED))
