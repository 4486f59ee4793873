"""Collocations, periodic runs and trie encoding: against brute force and the tokenizer library, and on odd rows."""

import hashlib
import itertools
import random
import re
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from grantflow.llm import collocations as col
from grantflow.llm import queries, runs, trie_bpe

FOLDER = "/root/testdata/sf0.001"
NUL = 0x10000  # code points at most that a test goes through


def sha(text):
    return hashlib.sha256(text.encode() if isinstance(text, str) else text).hexdigest()


# ---------------------------------------------------------------- collocations


def phrases_by_counting(rows, least=10, top=2000):
    f, n = defaultdict(Counter), Counter()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in (("und" if x is None else x, t) for x, t in rows):
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(lower)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f[lang].update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = set()
    for lang, c in f.items():
        found = {p: a for p, a in c.items() if len(p) > 1 and a >= least}
        longer = Counter()
        for p, a in found.items():
            if len(p) == 3:
                for part in (p[:2], p[1:]):
                    longer[part] = max(longer[part], a)
        best = []
        for p, a in found.items():
            if 100 * longer[p] >= 50 * a and longer[p]:
                continue
            score, k = min((1000000 * a * a // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
            best.append((-score, -a, " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(best)[:top], 1):
            out.add((lang, rank, p.decode(), -a, left, right, n[lang], -s))
    return out


def as_set(df):
    return {(r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect()}


@pytest.mark.parametrize("size, route", [(3 << 20, 200_000), (900, 40), (90, 5)])
def test_collocations(spark, size, route, monkeypatch):
    if route < 100:
        monkeypatch.setattr(col, "SHARE", 20)
        monkeypatch.setattr(col, "ROUTES", 3 * route // 5)  # few and large, so that they are dealt further
    rng = random.Random(size)
    words = ["the", "The", "of", "harbour", "boat", "é", "日本", "x" * 300, "a|b", "\x00", "\x1c"]
    rows = []
    for i in range(120):
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?"]) for _ in range(40))
        rows.append((["en", None, "und", ""][i % 4], text))
    # a pair that a third of all suffixes begin with, one long piece, no text
    rows += [("en", " ".join(f"new york w{rng.randrange(60)}" for _ in range(500))), ("en", None), (None, ""), ("de", " \t")]
    docs = spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], "lang string, text string, phrase int").repartition(3)
    assert as_set(col.collocations(docs, size=size, route=route)) == phrases_by_counting(rows)
    assert as_set(col.collocations(docs, size=size, route=route, top=3)) == phrases_by_counting(rows, top=3)


def test_collocations_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.lang, r.text) for r in odd_docs.collect()]
    assert as_set(col.collocations(odd_docs)) == phrases_by_counting(rows)
    assert col.collocations(no_docs).count() == 0


def test_long_routes_are_not_written_anew(spark, monkeypatch):
    monkeypatch.setattr(col, "ROUTES", 3)
    rng = random.Random(7)
    rows = [("en", " ".join(f"w{int(rng.paretovariate(0.6)) % 90}" for _ in range(120))) for _ in range(40)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    suffixes = col.staged(col.sorted_suffixes(docs, 1200), "suffixes")
    # routes of some seven blocks, in none of which a word has as many suffixes as a route may hold
    blocks = col.routed(suffixes, 100_000, 200)
    assert blocks.count() == suffixes.where("following is not null").count()
    found = [(r.phrase.decode(), r["count"]) for r in col.counted(blocks, 10, 200).collect()]
    words = [w for _, t in rows for w in [t.split()]]
    phrases = Counter(" ".join(w[i : i + n]) for w in words for n in (1, 2, 3) for i in range(len(w) - n + 1))
    total = Counter()
    for p, n in found:
        total[p] += n
    assert {p: n for p, n in total.items() if n >= 10} == {p: n for p, n in phrases.items() if n >= 10}
    # parts of a beginning that stands in one part of a route are abandoned if light
    assert sum(n < 10 for _, n in found) < 0.05 * len(phrases)


def test_parts_end_between_words():
    rng = np.random.default_rng(3)
    keys = [np.minimum(rng.geometric(0.4, 2000), 6) - 2 for _ in range(3)]
    pointers = np.arange(100, 2000)
    parts = list(col._by_words(keys, pointers, 50))
    assert sorted(np.concatenate([p for p, _ in parts])) == pointers.tolist()
    words = np.stack(keys)
    for n in range(3):
        # a beginning of more words than its part shares with others stands in no other part
        seen = Counter(b for p, alike in parts if alike <= n for b in {tuple(x) for x in words[: n + 1, p].T.tolist()})
        assert not seen or max(seen.values()) == 1
    assert all(len(p) <= 50 or alike == 3 for p, alike in parts)


def test_heavy_beginnings():
    pairs = [("en", b"a", b"b"), ("de", b"a", b"c"), ("en", b"c", b"a"), ("fr", b"a", b"b"), ("en", b"x", b"b")]
    langs, words = pa.array(["de", "en"]), pa.array([b"a", b"b", b"c"])
    codes = [np.array(c) for c in zip(*itertools.product((0, 1), (0, 1, 2), (-1, 0, 1, 2)), strict=True)]
    for n in (2, 3):
        listed = {p[:n]: k + 1 for k, p in enumerate(pairs)}
        heavy = col.Heavy(list(listed), list(listed.values()))
        spelled = [(langs[a].as_py(), words[b].as_py(), words[c].as_py() if c >= 0 else None) for a, b, c in zip(*codes, strict=True)]
        assert heavy.of(langs, words, codes[:n]).tolist() == [listed.get(s[:n], 0) for s in spelled]
    assert not col.Heavy([], []).of(langs, words, codes).any()


def test_quicksort_sizes():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 4, (3, 500))
    weight = rng.integers(1, 4, 500)
    cut = np.array([200, 300])  # two parts, each sorted by itself
    for least in (None, (1, 20, 20, 20)):
        parts = col.multikey_quicksort([k.take for k in keys], np.arange(500), cut, weight, least)
        got = {(p >= 200, *keys[:d, p].tolist()): w for d, p, w in zip(*parts, strict=True)}
        counts = Counter()
        for p in range(500):
            for d in (1, 2, 3):
                counts[(p >= 200, *keys[:d, p].tolist())] += int(weight[p])
        assert got == {k: c for k, c in counts.items() if least is None or c >= 20}
        order = [(p >= 200, *keys[:d, p].tolist()) for d, p, _ in zip(*parts, strict=True)]
        assert order == sorted(order)
    whole = col.multikey_quicksort([k.take for k in keys], np.arange(500), cut, suffixes=True)
    assert [(p >= 200, *keys[:, p].tolist()) for p in whole.pointer] == sorted(c for c in counts if len(c) == 4)
    assert whole.weight.sum() == 500


def test_collocations_exact_beyond_64_bits(spark):
    big = 3_000_000_000
    a, l, r = (F.lit(x).cast("decimal(18,0)") for x in (big, big + 1, big + 7))
    row = spark.range(1).select(a.alias("a"), l.alias("l"), r.alias("r")).selectExpr("(a * a * 1000000) div (l * r) AS s").first()
    assert row.s == 1000000 * big * big // ((big + 1) * (big + 7))


# ---------------------------------------------------------------- periodic runs


def runs_by_trying(w, periods=4, least=6):
    n, out = len(w), []
    for q in range(1, n // 2 + 1):
        s = 0
        while s + q < n:
            if w[s] != w[s + q]:
                s += 1
                continue
            e = s
            while e + q < n and w[e] == w[e + q]:
                e += 1
            size = e + q - s
            if size >= max(least, periods * q):
                part = w[s : s + size]
                if not any(part[d:] == part[: size - d] for d in range(1, q)):
                    out.append((s, size, q))
            s = e + 1
    return sorted(out)


def test_runs_equal_trying():
    rng = random.Random(3)
    for _ in range(1500):
        texts = []
        for _ in range(rng.randrange(1, 4)):
            n, k = rng.randrange(60), rng.choice([1, 2, 3])
            w = [rng.randrange(k) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = 1 + (n - a) // rng.randrange(3, 9)
                w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
            texts.append(w)
        periods = rng.choice([2, 3, 4])
        codes, expected = [], []
        for w in texts:
            expected += [(len(codes) + s, size, q) for s, size, q in runs_by_trying(w, periods)]
            codes += [*w, -1]
        assert [tuple(r) for r in runs.find_runs(np.array(codes), periods).tolist()] == expected


def test_runs_of_one_word_and_ordered_sets():
    assert runs.find_runs(np.zeros(200_000, dtype=np.int64)).tolist() == [[0, 200_000, 1]]
    rng = random.Random(4)
    values = rng.sample(range(10**6), 5_000)
    known, kept = runs.Positions(values[0]), [values[0]]
    for v in values[1:]:
        before, after = known.add(v)
        assert before == max((k for k in kept if k < v), default=None)
        assert after == min((k for k in kept if k > v), default=None)
        kept.append(v)
    assert list(known) == sorted(kept) and known.size == len(kept)


def runs_by_contract(doc_id, text):
    w = re.findall("[^ \t-\r]+", text or "")
    n = len(w)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = runs_by_trying(w)
    gone = {i for s, size, q in found for i in range(s + q, s + size)}
    best = min(((-size, s, q) for s, size, q in found), default=None)
    first = (None,) * 4 if best is None else (best[1], -best[0], best[2], 1000 * -best[0] // best[2])
    return (doc_id, len(found), *first, sha("".join(f"{s},{size},{q}\n" for s, size, q in found)),
            sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def test_runs_query(spark, odd_docs, no_docs):
    rng = random.Random(6)
    rows = [(i, " ".join(rng.choice("abc") for _ in range(rng.randrange(80)))) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for df in (docs, odd_docs.select("doc_id", "text", "lang", F.col("n_chars").alias("runs")), no_docs):
        got = [tuple(r) for r in runs.digests(runs.periodic_runs(runs.with_planted_tails(df))).collect()]
        assert sorted(map(repr, got)) == sorted(repr(runs_by_contract(r.doc_id, r.text)) for r in df.collect())


def test_runs_whole_table(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").where(F.length("text") < 6_000).collect()
    got = {r.doc_id: tuple(r) for r in queries.op12_periodic_runs(spark, FOLDER).collect()}
    assert len(got) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert [got[d.doc_id] for d in docs] == [runs_by_contract(d.doc_id, d.text) for d in docs]


# ---------------------------------------------------------------- BPE


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path(trie_bpe.MODEL))


@pytest.fixture(scope="module")
def bpe():
    return trie_bpe.Bpe(public_tokenizers.path(trie_bpe.MODEL))


def same_as_library(bpe, library, texts):
    for text, data, ref in zip(texts, bpe.encode(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = np.frombuffer(data, dtype="<u4")
        assert ids.tolist() == ref.ids, text[:100]
        assert bpe.decode(ids) == library.decode(ref.ids, skip_special_tokens=False)


def test_bpe_texts(bpe, library):
    rng = random.Random(7)
    letters = "aaabcdeefghiiklmnooprsttuvwxyzéßΣλжЖ日本 's 1.,-#²\u0345\U0001f642\u0301"
    same_as_library(bpe, library, ["".join(rng.choice(letters) for _ in range(200)) for _ in range(600)])
    same_as_library(bpe, library, [
        "", " ", "ΑΣ ΟΔΟΣ", "<|endoftext|>A<|startoftext|> b<|endoftext", "it's they'LL 're", "abc" * 40_000, "a\u0301 e\u0301",
        "İstanbul ǅ ﬁ Ꭰ \u1c89 \ua7dc", "\x00\x1c\x1f\x85\xa0", "z" * 70_000])


def test_bpe_every_character(bpe, library):
    chars = [chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000 and (c < NUL or c % 16 == 0)]
    same_as_library(bpe, library, [f"a{c}1{c}{c}'s" for c in chars])


def test_bpe_shares_prefixes(library):
    small_table = trie_bpe.Bpe(public_tokenizers.path(trie_bpe.MODEL), table=3)
    words = ["harbour", "harbours", "harbourmaster", "harp", "h", "ha", "boat", "boating"]
    for _ in range(3):  # the table is emptied in between
        same_as_library(small_table, library, [" ".join(words), *words])
    root = trie_bpe.Node("")
    for w in words:
        trie_bpe.insert(root, w, w)
    seen, stack = {}, [(root, "")]
    while stack:
        node, path = stack.pop()
        path += node.label
        if node.word is not None:
            seen[node.word] = path
        assert len({c.label[0] for c in node.following.values()}) == len(node.following)
        stack += [(c, path) for c in node.following.values()]
    assert seen == {w: w for w in words}


def test_bpe_query(spark, library, odd_docs, no_docs):
    def expected(rows):
        out = []
        for doc_id, text in rows:
            ids = library.encode(text or "", add_special_tokens=False).ids
            out.append((doc_id, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(library.decode(ids, skip_special_tokens=False))))
        return sorted(map(repr, out))

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    got = sorted(repr(tuple(r)) for r in queries.op13_trie_bpe(spark, FOLDER).collect())
    assert got == expected((r.doc_id, r.text) for r in docs.collect())
    odd = [(r.id, r.n_tokens, sha(bytes(r.ids_bytes)), sha(r.decoded)) for r in trie_bpe.round_trip(odd_docs).collect()]
    assert sorted(map(repr, odd)) == expected((r.doc_id, r.text) for r in odd_docs.collect())
    assert trie_bpe.round_trip(no_docs).count() == trie_bpe.encode(no_docs).count() == 0
    assert sum(len(r.ids) for r in trie_bpe.encode(odd_docs).collect()) == sum(o[1] for o in odd)
