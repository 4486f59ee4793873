"""Phrases of words that belong together: multikey three-way quicksort of suffix pointers, down to the longest phrase.

A pointer stands for the words from one position to the end of its piece (text between marks of punctuation), of which
the first three count. Partitioning the pointers of a block by their first word (less, equal, more), the equal part by
the second word and so on puts equal beginnings together: the size of an equal part is the count of its phrase.

1. Each task deals the pointers of a block of its documents by their first words, sorts them and writes, for each route
   (a share of the first words), the words and sizes of the equal parts, staged as Parquet.
2. The rows are routed by their leading words: by the first; where that has very many suffixes, by the first two; and
   where one pair has that many as well, by all three. The lists of such beginnings are complete and bounded. Only rows
   of routes that such a beginning stands in are written anew.
3. Each task sorts the rows of each route, weighted, in blocks that end between routes, and abandons every part that stays
   below the least count: all its occurrences are there. A route longer than a block is sorted in parts that end between
   first words, inside a longer word between second ones and so on. One longer than ``HELD`` blocks is sorted in several
   of them, where nothing is abandoned. The sizes of equal parts of all blocks add up to the counts.
4. Cuts, scores and the phrases that a longer one holds are joins of the counted phrases.

Defined results: null text has no words; null language is ``und``; rows without id, repeated rows and equal texts count
like others; an empty table gives an empty table; texts and pieces of any length are cut into blocks that overlap by the
words of a phrase; ties are ordered by count and phrase; further columns are not read.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Callable, Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from grantflow.llm.common import binaries, pick, small, staged, trim

LONGEST = 3  # words of a phrase
LEAST = 10  # occurrences of a phrase
TOP = 2000  # phrases of a language
BLOCK = 2 << 20  # bytes of text sorted at once; a sixth as many suffixes of routes
ROUTES = 1024  # shares of the first words in which a block is written
ROUTE = 2_000_000  # rows of one first word, or pair of words, that one route may hold
HELD = 8  # blocks of one route that a task holds as numbers
SHARE = 10_000  # ... or this part of all rows, so that the lists of heavy beginnings stay bounded
MARK = b"."  # all marks that end a piece
BREAK = re.compile(rb"[ \t.,;:!?\n-\r]")
TOKEN = re.compile(rb"[^ \t.,;:!?\n-\r]+|[.,;:!?\n-\r]")
PLAIN = bytes.maketrans(
    string.ascii_uppercase.encode() + b",;:!?\n\x0b\x0c\r", string.ascii_lowercase.encode() + 9 * MARK)
ENDED = -1  # the word after the last of a piece


class Parts(NamedTuple):
    """Equal parts, in order: how many keys are equal, one of the pointers, the weight."""

    depth: np.ndarray
    pointer: np.ndarray
    weight: np.ndarray


def _stretches(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The numbers of stretches, one after the other."""
    return np.arange(int(sizes.sum())) + np.repeat(starts - (np.cumsum(sizes) - sizes), sizes)


def multikey_quicksort(
    columns: list[Callable[[np.ndarray], np.ndarray]], pointers: np.ndarray, sizes: np.ndarray,
    weights: np.ndarray | None = None, least: tuple[int, ...] | None = None, suffixes: bool = False,
) -> Parts:
    """Equal parts of pointers; ``columns`` give the first, second, ... key of pointers.

    ``sizes`` are those of the parts that the pointers come in; each is sorted by itself. All open parts are partitioned
    at once, each around the key of its middle pointer, into less, equal and more; the equal ones wait for the next key,
    and a key of ``ENDED`` ends a suffix. ``least`` holds the least weight of a part with so many equal keys: lighter ones
    are abandoned, and their further keys never asked for. With ``suffixes`` only parts of whole suffixes are given, else
    those at every depth. Parts come in the order of their keys, longer beginnings after shorter.
    """
    bounds = least or (1,) * (len(columns) + 1)
    weights = weights if weights is not None else np.ones(len(pointers), dtype=np.int64)
    found: list[tuple[np.ndarray, ...]] = []

    def note(hit: np.ndarray, depth: int) -> None:
        found.append((places[hit], np.full(len(hit), depth), pointers[starts[hit]], mass[hit]))

    def only(chosen: np.ndarray) -> tuple[np.ndarray, ...]:
        stay = np.repeat(chosen, sizes)
        return pointers[stay], key[stay], weights[stay], sizes[chosen], places[chosen]

    places = np.cumsum(sizes) - sizes
    for depth, column in enumerate(columns):
        deepest = depth == len(columns) - 1
        starts = np.cumsum(sizes) - sizes
        mass = np.add.reduceat(weights, starts) if len(sizes) else sizes
        key = np.zeros(len(pointers), dtype=np.int32)
        pointers, key, weights, sizes, places = only(mass >= bounds[depth + 1])
        key = column(pointers)
        waiting = []
        while len(pointers):
            starts = np.cumsum(sizes) - sizes
            pivots = key[starts + sizes // 2]
            around = np.repeat(pivots, sizes)
            sides = [key < around, key == around, key > around]
            counts = np.stack([np.add.reduceat(side, starts, dtype=np.int64) for side in sides], axis=1)
            begins = starts[:, None] + np.cumsum(counts, axis=1) - counts
            order = np.empty(len(pointers), dtype=np.int64)
            for k, side in enumerate(sides):
                order[_stretches(begins[:, k], counts[:, k])] = np.flatnonzero(side)
            pointers, key, weights = pointers[order], key[order], weights[order]
            # three parts of each, without the empty ones
            some = np.flatnonzero(counts.ravel())
            places = (places - starts)[some // 3] + begins.ravel()[some]
            starts, sizes = begins.ravel()[some], counts.ravel()[some]
            mass = np.add.reduceat(weights, starts)
            equal, ended = some % 3 == 1, pivots[some // 3] == ENDED
            if suffixes:
                note(np.flatnonzero(equal & (ended | deepest) | (sizes == 1)), depth + 1)
            else:
                note(np.flatnonzero(equal & (mass >= bounds[depth + 1])), depth + 1)
            more = (sizes > 1) if suffixes else np.ones(len(sizes), dtype=bool)
            if not deepest:
                waiting.append(only(equal & ~ended & more & (mass >= bounds[depth + 2])))
            pointers, key, weights, sizes, places = only(~equal & more & (mass >= bounds[depth + 1]))
        if deepest or not waiting:
            break
        pointers, key, weights, sizes, places = (np.concatenate(c) for c in zip(*waiting, strict=True))
    if not found:
        return Parts(*[np.zeros(0, dtype=np.int64)] * 3)
    place, depth, pointer, mass = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.lexsort((depth, place))
    return Parts(depth[order], pointer[order], mass[order])


def _unchecked(values: pa.Array | pa.ChunkedArray) -> pa.Array:
    return pc.cast(values, options=pc.CastOptions(target_type=pa.string(), allow_invalid_utf8=True))


def _numbered(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Numbers of texts, and the distinct ones."""
    coded = values.dictionary_encode()
    distinct = np.empty(len(coded.dictionary), dtype=object)
    distinct[:] = coded.dictionary.cast(pa.binary()).to_pylist()
    return coded.indices.to_numpy(zero_copy_only=False), distinct


class Block:
    """Texts with their languages, and the number of words at the end of each that begin no suffix here."""

    def __init__(self) -> None:
        self.texts: list[bytes] = []
        self.langs: list[str] = []
        self.idle: list[int] = []
        self.size = 0

    def add(self, lang: str, text: bytes, idle: int = 0) -> None:
        self.texts.append(text.translate(PLAIN).replace(MARK, b" " + MARK + b" ") + b" " + MARK)
        self.langs.append(lang)
        self.idle.append(idle)
        self.size += len(text)

    def sort(self, routes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Words, languages, and for each distinct suffix its count and the numbers of language, route and words, in order."""
        split = pc.ascii_split_whitespace(_unchecked(pa.array(self.texts, pa.binary())))
        codes, words = _numbered(split.flatten())
        langs = list(dict.fromkeys(self.langs))
        lengths = split.value_lengths().to_numpy(zero_copy_only=False)
        lang = np.repeat(np.array([langs.index(x) for x in self.langs], dtype=np.int32), lengths)
        # the mark at the end comes after the words that begin nothing
        left = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(codes)) - 1
        begins = left > np.repeat(self.idle, lengths)
        real = words[codes] != b""
        codes, lang, begins = codes[real], lang[real], begins[real]
        codes = np.where((words == MARK)[codes], ENDED, codes).astype(np.int32)
        at = np.flatnonzero((codes != ENDED) & begins)
        codes = np.concatenate([codes, np.full(LONGEST, ENDED, dtype=np.int32)])
        route = np.array([zlib.crc32(w) % routes for w in words.tolist()], dtype=np.int32)
        rows = [lang[at], route[codes[at]], codes[at]]
        for k in range(1, LONGEST):
            rows.append(np.where(rows[-1] == ENDED, ENDED, codes[at + k]))
        # dealt by language, route and first word, sorted by the others
        first = (rows[0].astype(np.int64) * routes + rows[1]) * len(words) + rows[2]
        order = np.argsort(first, kind="stable")
        sizes = np.diff(np.append(_runs(first[None, order]), len(order)))
        keys = np.stack(rows)
        parts = multikey_quicksort([k.take for k in rows[3:]], order, sizes, suffixes=True)
        # the last word stands for ENDED
        return np.append(words, b""), np.array(langs, dtype=object), keys[:, parts.pointer], parts.weight


def filled(texts: Iterable[tuple[str, bytes]], size: int) -> Iterator[Block]:
    """Blocks of some ``size`` bytes of texts. Where a text is cut, between words, the words of a phrase from there on
    are looked at in both blocks and begin suffixes in the second."""
    block = Block()
    for lang, text in texts:
        at = 0
        while at < len(text):
            after = BREAK.search(text, at + max(1, size - block.size))
            end = after.start() if after else len(text)
            ahead, to = [], end
            while len(ahead) < LONGEST - 1 and (token := TOKEN.search(text, to)):
                ahead.append(token.group())
                to = token.end()
            block.add(lang, text[at:end] + b" " + b" ".join(ahead), len(ahead))
            at = end
            if block.size >= size:
                yield block
                block = Block()
    if block.texts:
        yield block


# suffixes of a route, or (without ``following``) the number of them that begin with a word or pair of words
SUFFIXES = pa.schema([
    ("lang", pa.string()), ("route", pa.int64()), ("weight", pa.int64()), ("n_rows", pa.int64()),
    ("following", pa.binary()), ("first", pa.binary()), ("second", pa.binary())])
ROUTED = pa.schema([
    ("lang", pa.string()), ("kind", pa.int32()), ("route", pa.int64()), ("n_rows", pa.int64()), ("following", pa.binary())])
COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("count", pa.int64())])
ROW = 500  # suffixes written in one row, so that Arrow's batches of rows stay small
# Kinds of routes: by the first word; of a heavy word, by the second; of a heavy pair, by the third.
BY_FIRST, BY_SECOND, BY_THIRD = range(3)


def _runs(keys: np.ndarray, most: int | None = None) -> np.ndarray:
    """Starts of the runs of equal columns; with ``most``, longer runs are cut."""
    new = np.ones(keys.shape[1], dtype=bool)
    new[1:] = (keys[:, 1:] != keys[:, :-1]).any(axis=0)
    if most:
        starts = np.flatnonzero(new)
        since = np.arange(len(new)) - np.repeat(starts, np.diff(np.append(starts, len(new))))
        new |= since % most == 0
    return np.flatnonzero(new)


def _packed(words: list[np.ndarray], weight: np.ndarray, cuts: np.ndarray) -> list[bytes]:
    """The suffixes of each stretch from one cut to the next as words and counts, blanks between them."""
    flat = np.empty((len(weight), FIELDS), dtype=object)
    for k, column in enumerate(words):
        flat[:, k] = column
    flat[:, LONGEST] = DIGITS[np.minimum(weight, len(DIGITS) - 1)]
    for k in np.flatnonzero(weight >= len(DIGITS)).tolist():
        flat[k, LONGEST] = b"%d" % weight[k]
    fields = flat.ravel().tolist()
    ends = [*cuts[1:].tolist(), len(weight)]
    return [b" ".join(fields[FIELDS * a : FIELDS * b]) for a, b in zip(cuts.tolist(), ends, strict=True)]


FIELDS = LONGEST + 1
DIGITS = np.array([b"%d" % n for n in range(1000)], dtype=object)


def _unpacked(following: pa.Array, most: int | None = None) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Numbers of the words of suffixes (``ENDED`` for none), weights, and the words; with ``most``, texts are split for
    so many rows at a time."""
    coded = pa.chunked_array([
        pc.split_pattern(_unchecked(following.slice(at, most or len(following))), " ").flatten().dictionary_encode()
        for at in range(0, len(following), most or len(following))]).unify_dictionaries()
    words = np.empty(len(coded.chunk(0).dictionary), dtype=object)
    words[:] = coded.chunk(0).dictionary.cast(pa.binary()).to_pylist()
    codes = np.concatenate([c.indices.to_numpy(zero_copy_only=False) for c in coded.chunks])
    digits, place = np.unique(codes[LONGEST::FIELDS], return_inverse=True)
    codes = np.where((words == b"")[codes], ENDED, codes).astype(np.int32)
    return [codes[k::FIELDS] for k in range(LONGEST)], words[digits].astype("S20").astype(np.int64)[place], words


def sorted_suffixes(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Equal suffixes of blocks of documents (``lang, text``), a row for each route. Rows without ``following`` count the
    suffixes of a word, or of a pair of words, that has many in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def texts() -> Iterator[tuple[str, bytes]]:
            for batch in small(batches):
                yield from zip(batch.column("lang").to_pylist(), binaries(batch.column("text")), strict=True)

        for block in filled(texts(), size):
            words, langs, keys, weight = block.sort(ROUTES)
            if not len(weight):
                continue
            cuts = _runs(keys[:2], ROW)
            nothing = pa.nulls(len(cuts), pa.binary())
            yield pa.RecordBatch.from_arrays([
                pa.array(langs[keys[0, cuts]], pa.string()), pa.array(keys[1, cuts]), pa.array(np.add.reduceat(weight, cuts)),
                pa.array(np.diff(np.append(cuts, len(weight)))),
                pa.array(_packed([words[k] for k in keys[2:]], weight, cuts), pa.binary()), nothing, nothing], schema=SUFFIXES)
            for of in (3, 4):
                starts = _runs(keys[:of])
                n = np.diff(np.append(starts, len(weight)))
                many = n * 2 * SHARE >= len(weight)
                at, nothing = starts[many], pa.nulls(int(many.sum()), pa.binary())
                yield pa.RecordBatch.from_arrays([
                    pa.array(langs[keys[0, at]], pa.string()), pa.array(keys[1, at]), pa.array(np.zeros(len(at), dtype=np.int64)),
                    pa.array(n[many]), nothing, pa.array(words[keys[2, at]], pa.binary()),
                    pa.array(words[keys[3, at]], pa.binary()) if of == 4 else nothing], schema=SUFFIXES)
            trim()

    return docs.select("lang", "text").mapInArrow(run, from_arrow_schema(SUFFIXES))


def _found(wanted: list, values: pa.Array) -> np.ndarray:
    """Where each of the ``wanted`` stands among distinct ``values``, -1 for those that don't."""
    return pc.fill_null(pc.index_in(pa.array(wanted, values.type), value_set=values), -1).to_numpy().astype(np.int64)


class Heavy:
    """Beginnings with many suffixes: ``words`` (language, first) and ``pairs`` (language, first, second), each with a number."""

    def __init__(self, beginnings: list[tuple], numbers: list[int]):
        self.columns = [list(c) for c in zip(*beginnings, strict=True)]
        self.numbers = np.array(numbers, dtype=np.int64)

    def of(self, langs: pa.Array, words: pa.Array, codes: list[np.ndarray]) -> np.ndarray:
        """The number of each suffix, given by the places of its language and words among ``langs`` and ``words``; 0 for
        suffixes that begin otherwise."""
        if not self.columns:
            return np.zeros(len(codes[0]), dtype=np.int64)
        mine = [_found(c, words if k else langs) for k, c in enumerate(self.columns)]
        there = np.flatnonzero(np.all([m >= 0 for m in mine], axis=0))
        # first (language, first) are numbered, then those with the second, so that no product is too large
        keys, own = codes[0].astype(np.int64), mine[0][there]
        for column, other in zip(codes[1:], mine[1:], strict=True):
            own = own * (len(words) + 1) + other[there]
            listed = np.unique(own)
            keys = _at(listed, keys * (len(words) + 1) + column)
            own = np.searchsorted(listed, own)
        number = np.zeros(len(there) + 1, dtype=np.int64)
        number[own] = self.numbers[there]
        return number[keys]


def _at(listed: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The places of ``keys`` among ascending numbers, -1 for those that aren't there."""
    if not len(listed):
        return np.full(len(keys), -1, dtype=np.int64)
    place = np.minimum(np.searchsorted(listed, keys), len(listed) - 1)
    return np.where(listed[place] == keys, place, -1)


def routed(suffixes: DataFrame, route: int = ROUTE, size: int = BLOCK // 6) -> DataFrame:
    """The suffixes with the route of each: by the first word; where that has many, by the second; and where a pair has
    many, by the third, so that such pairs are counted in several routes. Where the shares of the first words are larger
    than ``HELD`` blocks of ``size``, they are dealt to more routes.

    What blocks don't report of a beginning is less than half of the limit in all, so the lists hold every beginning above
    the limit, and at most 2 ``SHARE`` words and as many pairs."""
    total = suffixes.where("following is not null").agg(F.sum("n_rows")).first()[0] or 0
    limit = max(route, total // SHARE)
    reported = suffixes.where("following is null").groupBy("lang", "route", "first", "second").agg(F.sum("n_rows").alias("n_rows"))
    heavy = reported.where(F.col("n_rows") * 2 >= limit).collect()
    pairs = Heavy([(r.lang, bytes(r.first), bytes(r.second)) for r in heavy if r.second is not None],
                  [1 for r in heavy if r.second is not None])
    routes = Heavy([(r.lang, bytes(r.first)) for r in heavy if r.second is None],
                   [-(-2 * r.n_rows // limit) for r in heavy if r.second is None])
    rows = suffixes.where("following is not null").select(
        "lang", F.lit(BY_FIRST).alias("kind"), "route", "n_rows", "following")
    shares = -(-total // (ROUTES * HELD * size))
    if not routes.columns and shares <= 1:
        return rows
    places = sorted({(r.lang, r.route) for r in heavy})
    listed = F.broadcast(suffixes.sparkSession.createDataFrame(places, "lang string, route long"))

    def dealt(rows: pa.Table) -> pa.RecordBatch:
        """Rows of suffixes that lie together, dealt anew."""
        of = np.repeat(np.arange(rows.num_rows), rows.column("n_rows").to_numpy())
        coded = rows.column("lang").combine_chunks().dictionary_encode()
        lang = coded.indices.to_numpy(zero_copy_only=False)[of].astype(np.int64)
        (first, second, third), weight, words = _unpacked(rows.column("following").combine_chunks())
        words = np.append(words, b"")
        sums = np.array([zlib.crc32(w) for w in words.tolist()], dtype=np.int64)
        langs, distinct = coded.dictionary, pa.array(words[:-1], pa.binary())
        several = routes.of(langs, distinct, [lang, first])
        kind = np.where(several > 0, BY_SECOND, BY_FIRST)
        kind[(several > 0) & (second != ENDED) & (pairs.of(langs, distinct, [lang, first, second]) > 0)] = BY_THIRD
        # a heavy word has routes of its own
        usual = rows.column("route").to_numpy()[of] + ROUTES * (sums[first] // ROUTES % max(1, shares))
        by = sums[second] + np.where(kind == BY_THIRD, 7 * sums[third], 0)
        to = np.where(several > 0, sums[first] * 1_000 + by % np.maximum(several, 1), usual)
        order = np.lexsort((to, lang * 3 + kind))
        kind, to, lang = kind[order], to[order], lang[order]
        cuts = _runs(np.stack([lang, kind, to]), ROW)
        return pa.RecordBatch.from_arrays([
            langs.take(pa.array(lang[cuts])), pa.array(kind[cuts].astype(np.int32)), pa.array(to[cuts]),
            pa.array(np.diff(np.append(cuts, len(order)))),
            pa.array(_packed([words[k[order]] for k in (first, second, third)], weight[order], cuts), pa.binary())],
            schema=ROUTED)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in small(batches):
            held.append(batch)
            n += pc.sum(batch.column("n_rows")).as_py()
            if n >= size:
                yield dealt(pa.Table.from_batches(held))
                held, n = [], 0
        if held:
            yield dealt(pa.Table.from_batches(held))

    if shares > 1:
        return rows.mapInArrow(split, from_arrow_schema(ROUTED))
    apart = rows.join(listed, ["lang", "route"]).select(*ROUTED.names).mapInArrow(split, from_arrow_schema(ROUTED))
    return rows.join(listed, ["lang", "route"], "left_anti").select(*ROUTED.names).unionByName(apart)


def counted(routed_rows: DataFrame, least: int = LEAST, size: int = BLOCK // 6) -> DataFrame:
    """``lang, phrase, count`` of phrases of one to three words; parts of a count may come from several blocks."""
    # least weights of a part with 0, 1, 2, 3 equal words: where a route has all of them, lighter ones are abandoned
    bounds = {
        BY_FIRST: (1, least, least, least), BY_SECOND: (1, 1, least, least), BY_THIRD: (1, 1, 1, least), LONGEST: (1, 1, 1, 1)}

    def told(rows: pa.Table, parts: Parts, keys: list[np.ndarray], words: np.ndarray, row_of: np.ndarray) -> pa.RecordBatch:
        numbers = np.stack([k[parts.pointer] for k in keys], axis=1)
        real = numbers[np.arange(len(numbers)), parts.depth - 1] != ENDED
        names = words[numbers[real]].tolist()
        return pa.RecordBatch.from_arrays([
            rows.column("lang").combine_chunks().take(pa.array(row_of[parts.pointer[real]])),
            pa.array([b" ".join(n[:d]) for n, d in zip(names, parts.depth[real].tolist(), strict=True)], pa.binary()),
            pa.array(parts.weight[real])], schema=COUNTED)

    def count(rows: pa.Table) -> pa.RecordBatch:
        """Rows of one kind, of whole routes."""
        sizes = rows.column("n_rows").to_numpy()
        keys, weight, words = _unpacked(rows.column("following").combine_chunks())
        parts = multikey_quicksort(
            [k.take for k in keys], np.arange(len(weight)), np.add.reduceat(sizes, np.flatnonzero(_borders(rows))), weight,
            bounds[rows.column("kind")[0].as_py()])
        return told(rows, parts, keys, words, np.repeat(np.arange(len(sizes), dtype=np.int32), sizes))

    def count_long(rows: pa.Table, whole: bool) -> Iterator[pa.RecordBatch]:
        """Rows of one route, in parts of ``size``; only of a ``whole`` route light parts are abandoned."""
        kind = rows.column("kind")[0].as_py()
        most = rows.num_rows * size // pc.sum(rows.column("n_rows")).as_py()
        keys, weight, words = _unpacked(rows.column("following").combine_chunks(), max(1, most))
        row_of = np.zeros(len(weight), dtype=np.int32)
        for pointers, alike in _by_words(keys, np.arange(len(weight)), size):
            parts = multikey_quicksort(
                [k.take for k in keys], pointers, np.array([len(pointers)]), weight[pointers],
                bounds[max(kind, alike) if whole else LONGEST])
            yield told(rows, parts, keys, words, row_of)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        n, cut = 0, None  # the route that was cut
        for batch in small(batches):
            held.append(batch)
            n += pc.sum(batch.column("n_rows")).as_py()
            if n < size:
                continue
            one = _route(held[0], 0) == _route(batch, -1)  # all rows are of one route, as rows come sorted
            if one and n < HELD * size:
                continue
            rows = pa.Table.from_batches(held)
            # up to the last route that begins here; a longer one is cut
            end = rows.num_rows if one else int(np.flatnonzero(_borders(rows))[-1])
            yield from several(rows.slice(0, end), None if one else cut, not one)
            cut = _route(rows, 0) if one else None
            held = rows.slice(end).to_batches()
            n = sum(pc.sum(b.column("n_rows")).as_py() for b in held)
            trim()
        if n:
            yield from several(pa.Table.from_batches(held), cut, True)

    def several(rows: pa.Table, cut: tuple | None, whole: bool) -> Iterator[pa.RecordBatch]:
        """Routes one after the other; of the route ``cut``, rows were counted before, and unless ``whole`` more follow."""
        starts = np.flatnonzero(_borders(rows))
        sizes = np.add.reduceat(rows.column("n_rows").to_numpy(), starts)
        ends = np.append(starts[1:], rows.num_rows)
        lone = sizes > size
        lone[0] |= not whole or _route(rows, 0) == cut
        # stretches of short routes, and long ones alone
        for k in _runs(np.stack([np.cumsum(lone), lone])):
            if lone[k]:
                yield from count_long(rows.slice(starts[k], ends[k] - starts[k]), whole and not (k == 0 and _route(rows, 0) == cut))
            else:
                last = k + int(np.argmax(np.append(lone[k:], True))) - 1
                for part in _by_kind(rows.slice(starts[k], ends[last] - starts[k])):
                    yield count(part)

    rows = routed_rows.repartition("lang", "kind", "route")
    # by kind and route, as one number, which is sorted faster than texts
    place = F.shiftrightunsigned(F.xxhash64("lang", "route"), 3) + F.col("kind") * F.lit(1 << 61)
    return rows.sortWithinPartitions(place, "kind", "lang", "route").mapInArrow(run, from_arrow_schema(COUNTED))


def _by_words(keys: list[np.ndarray], pointers: np.ndarray, size: int, alike: int = 0) -> Iterator[tuple[np.ndarray, int]]:
    """Pointers in parts of at most ``size`` that end between words, and the number of leading words that a part shares
    with others; only suffixes that are equal from the first word to the last may be more."""
    if len(pointers) <= size or alike == len(keys):
        yield pointers, alike
        return
    key = keys[alike][pointers]
    order = np.argsort(key, kind="stable")
    starts = _runs(key[None, order])
    sizes = np.diff(np.append(starts, len(order)))
    pointers = pointers[order]
    at = k = 0
    while k < len(starts):
        # as many words as fit, or a longer one
        end = max(k + 1, int(np.searchsorted(starts + sizes, starts[k] + size, side="right")))
        part = pointers[starts[k] : starts[end - 1] + sizes[end - 1]]
        if len(part) > size:
            yield from _by_words(keys, part, size, alike + 1)
        else:
            yield part, alike
        k = end


def _route(rows: pa.Table | pa.RecordBatch, at: int) -> tuple:
    return tuple(rows.column(rows.schema.get_field_index(c))[at].as_py() for c in ("lang", "kind", "route"))


def _borders(rows: pa.Table) -> np.ndarray:
    """Where a route begins."""
    new = np.ones(rows.num_rows, dtype=bool)
    new[1:] = False
    for c in ("lang", "kind", "route"):
        values = rows.column(c).combine_chunks()
        new[1:] |= pc.not_equal(values[1:], values[:-1]).to_numpy(zero_copy_only=False)
    return new


def _by_kind(rows: pa.Table) -> Iterator[pa.Table]:
    """The rows of each kind of routes, which come one after the other."""
    ends = np.cumsum(np.bincount(rows.column("kind").to_numpy(), minlength=3)).tolist()
    for start, end in zip([0, *ends], ends, strict=False):
        if end > start:
            yield rows.slice(start, end - start)


def phrase_counts(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, size: int = BLOCK, route: int = ROUTE,
) -> tuple[DataFrame, DataFrame]:
    """Words of each language (``lang, n``), and the phrases of one to three words that occur ``least`` times
    (``lang, phrase, count``)."""
    rows = pick(docs, lang_col, text_col).toDF("lang", "text").where("text is not null")
    rows = rows.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    suffixes = staged(sorted_suffixes(rows, size), "suffixes")
    totals = suffixes.groupBy("lang").agg(F.sum("weight").alias("n"))
    parts = counted(routed(suffixes, route, max(1, size // 6)), least, max(1, size // 6))
    phrases = parts.groupBy("lang", F.col("phrase").cast("string").alias("phrase")).agg(F.sum("count").alias("count"))
    return totals, staged(phrases.where(F.col("count") >= least), "phrases")


def collocations(
    docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, top: int = TOP, held: int = 50,
    size: int = BLOCK, route: int = ROUTE,
) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language.

    ``a`` is the count of the phrase, ``l`` and ``r`` those of its parts at the cut with the least score,
    floor(1000000 a a / (l r)); ``n`` the words of the language. A phrase is left out where one of a word more holds
    it in at least ``held`` percent of its occurrences.
    """
    # every part of a phrase occurs at least as often as the phrase, so its count is there
    totals, counts = phrase_counts(docs, lang_col, text_col, least, size, route)
    word = F.split("phrase", " ")
    phrases = counts.where(F.size(word) > 1)
    cut = F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - 1), lambda k: F.struct(
        k.alias("k"), F.array_join(F.slice("words", F.lit(1), k), " ").alias("left"),
        F.array_join(F.slice("words", k + 1, F.size("words") - k), " ").alias("right"))))
    cuts = phrases.select("lang", "phrase", F.col("count").alias("a"), word.alias("words")).select(
        "lang", "phrase", "a", cut.alias("cut")).select("lang", "phrase", "a", "cut.*")
    for side, name in (("left", "l"), ("right", "r")):
        cuts = cuts.join(counts.select("lang", F.col("phrase").alias(side), F.col("count").alias(name)), ["lang", side])
    exact = [F.col(c).cast("decimal(18,0)").alias(c) for c in ("a", "l", "r")]
    cuts = cuts.select("lang", "phrase", "k", *exact).withColumn("score", F.expr("(a * a * 1000000) div (l * r)"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r")).alias("best")).select(
        "lang", "phrase", "best.*")
    longer = phrases.where(F.size(word) == LONGEST).select("lang", F.col("count").alias("longer"), word.alias("words"))
    longer = longer.select("lang", "longer", F.explode(F.array(
        F.array_join(F.slice("words", 1, LONGEST - 1), " "), F.array_join(F.slice("words", 2, LONGEST - 1), " "))).alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    free = scored.join(longer, ["lang", "phrase"], "left").where(
        F.coalesce(F.col("longer") * 100 < F.col("a") * held, F.lit(True)))
    # the best of 128 shares of a language first, so that no task orders all of its phrases
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    share = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(128))).orderBy(*best)
    firsts = free.withColumn("rank", F.row_number().over(share)).where(F.col("rank") <= top)
    ranked = firsts.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    longs = [F.col(c).cast("long").alias(c) for c in ("rank", "a", "l", "r", "n", "score")]
    return ranked.join(totals, "lang").select("lang", "phrase", *longs)


# ``documents`` whole; HUGEINT products
ORACLE_SQL = r"""
with pieces as (
    select coalesce(lang, 'und') as lang,
           unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[.,;:!?
-
]')) as piece
    from documents where text is not null),
split as (select lang, regexp_extract_all(piece, '[^ 	]+') as w from pieces),
spans as (
    select lang, size, unnest([array_to_string(w[i:i + size - 1], ' ') for i in range(1, len(w) - size + 2)]) as phrase
    from split, (select unnest([1, 2, 3]) as size)),
counts as (select lang, size, phrase, count(*) as f from spans group by all),
totals as (select lang, sum(f)::bigint as n from counts where size = 1 group by lang),
candidates as (
    select lang, size, phrase, f as a, string_split(phrase, ' ') as w from counts where size > 1 and f >= 10),
cuts as (select *, unnest(range(1, size)) as k from candidates),
scored as (
    select c.lang, c.size, c.phrase, c.a, c.k, x.f as l, y.f as r,
           ((1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f)) as score
    from cuts c
    join counts x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
    join counts y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:c.size], ' ')),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1),
longer as (
    select lang, phrase, max(a) as longer from (
        select lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) as phrase
        from candidates where size = 3) group by all),
free as (
    select b.* from best b left join longer g using (lang, phrase) where g.longer is null or 100 * g.longer < 50 * b.a),
ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from free)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
       score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""
