"""Operators on documents: against brute force, and on odd rows."""

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from grantflow.llm import jaccard_join, packing, quality_rules, sentencepiece_stream, weighted_sampling
from grantflow.llm.components import components
from grantflow.llm.jaccard_join import Rule

SPACE = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in SPACE.split(text or "") if w]


# ---------------------------------------------------------------- quality rules


def test_quality_counts(spark, odd_docs, no_docs):
    got = {(r.id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed)
           for r in quality_rules.quality_rules(odd_docs).collect()}
    expected = set()
    for d in odd_docs.collect():
        w, text = words(d.text), d.text or ""
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
        lines = [line for line in text.split("\n") if words(line)]
        failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
        expected.add((d.doc_id, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text),
                      len(lines) - len(set(lines)), len(covered), failed))
    assert got == expected
    assert quality_rules.quality_rules(odd_docs).count() == odd_docs.count()
    assert quality_rules.quality_rules(no_docs).count() == 0


def test_repeated_words_equal_counting():
    rng = random.Random(1)
    for _ in range(200):
        w = [rng.randrange(3) for _ in range(rng.randrange(40))]
        windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
        covered = {k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
        assert quality_rules.repeated_words(np.array(w, dtype=np.int64)) == len(covered)


def test_boilerplate_lines(spark):
    rng = random.Random(2)
    unique = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    banner = "Subscribe to the harbour letter now and read on for free every single day"
    body = "\n".join(unique(12) for _ in range(8))
    rows = [(i, f"{unique(5)}\n{banner}\n{unique(30)}", "hot") for i in range(60)]
    rows += [(100 + i, f"{unique(2)}\n{banner.upper()}", "hot") for i in range(5)]  # depleted
    rows += [(200 + i, f"{unique(2)}\n{banner}", "other") for i in range(5)]  # rare on this host
    # near copies and exact copies share their lines, but in the same surroundings
    rows += [(300 + i, body.replace("w1", f"w1{i}", 1), "hot") for i in range(60)] + [(400 + i, body, "hot") for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    limits = quality_rules.Limits(docs=20)
    kept = {r.id: (r.kept, r.left_words) for r in quality_rules.quality_rules(docs, limits=limits).collect()}
    assert {i for i, (k, _) in kept.items() if not k} == {100, 101, 102, 103, 104}
    assert kept[0] == (True, 35) and kept[100][1] == 2
    good = quality_rules.keep_good(docs, limits=limits)
    assert good.columns == docs.columns and good.count() == len(rows) - 5


def test_boilerplate_in_any_place_and_number(spark):
    rng = random.Random(5)
    unique = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    first, block = unique(9), [unique(9) for _ in range(10)]
    footer, menu = unique(11), [unique(6) for _ in range(12)]
    # a line that opens the documents, a block of ten lines, a footer after one of a few others: 100 times the limit
    rows = [(i, "\n".join([first, unique(8), *block, unique(12), menu[i % 12], footer]), "big") for i in range(2_000)]
    # copies with an edit in any line, anywhere in it, are one group, however many there are
    body = [[f"b{i}x{j}" for j in range(12)] for i in range(9)]
    for i in range(10_000, 12_000):
        copy = [list(line) for line in body]
        edited = copy[rng.randrange(9)]
        at = rng.randrange(12)
        edited[at : at + rng.randrange(2)] = [unique(1)]
        rows.append((i, "\n".join(map(" ".join, copy)), "big"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.id: r for r in quality_rules.quality_rules(docs, limits=quality_rules.Limits(docs=20)).collect()}
    assert {(r.left_words, r.kept) for i, r in out.items() if i < 10_000} == {(20, False)}
    assert all(r.kept and r.left_words == r.n_words for i, r in out.items() if i >= 10_000)


# ---------------------------------------------------------------- Jaccard join


def shingle_set(text, n=4):
    w = [bytes(x).lower() for x in (text or "").encode().split()]
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(rows, rule):
    sets = [shingle_set(t, rule.shingle) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= rule.percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[find(i)].append(rows[i][0])
    out = []
    for i, (doc, _) in enumerate(rows):
        ids = [d for d in members[find(i)] if d is not None]
        out.append((doc, len(sets[i]), (min(ids) if ids else None) if sets[i] else doc))
    return sorted(out, key=repr)


def edited(rng, w, edits):
    w = list(w)
    for _ in range(edits):
        k = rng.randrange(len(w))
        w[k : k + rng.choice([0, 1])] = [f"e{rng.randrange(10**6)}"] if rng.random() < 0.7 else []
    return w


def crowd(rng):
    """Groups of near copies around the threshold, chains, and unrelated texts that share a long passage."""
    passage = [f"p{i}" for i in range(60)]
    rows = []
    for _ in range(25):
        base = [f"v{rng.randrange(10**6)}" for _ in range(rng.choice([3, 5, 8, 20, 60, 150]))]
        for _ in range(rng.randrange(1, 9)):
            base = edited(rng, base, rng.randrange(0, 3)) or ["x"]
            rows.append(" ".join(base))
    for _ in range(60):
        own = [f"u{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 90))]
        rows.append(" ".join(own[:5] + passage + own[5:]))
    base = [f"c{i}" for i in range(120)]
    rows += [" ".join(edited(rng, base, 2)) for _ in range(70)]
    return list(enumerate(rows))


@pytest.mark.parametrize("region_docs,rule", [(4000, Rule()), (6, Rule()), (4000, Rule(5, 80))])
def test_jaccard_equals_brute_force(spark, monkeypatch, region_docs, rule):
    monkeypatch.setattr(jaccard_join, "CHUNK", 10)
    monkeypatch.setattr(jaccard_join, "MIXED", 4)
    rows = crowd(random.Random(region_docs + rule.percent))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = jaccard_join.jaccard_classes(docs, rule=rule, region_docs=region_docs).collect()
    assert sorted([tuple(r) for r in got], key=repr) == brute_components(rows, rule)


def test_large_groups_lose_no_copies_over_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "CHUNK", 12)
    rng, rule = random.Random(17), Rule()
    base = [f"w{rng.randrange(900)}" for _ in range(90)]
    rows = [(k, " ".join(edited(rng, base, rng.randrange(5)))) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "7"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = jaccard_join.jaccard_classes(docs, rule=rule, region_docs=20).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sorted([tuple(r) for r in got], key=repr) == brute_components(rows, rule)


def test_region_join_alone(spark):
    rng = random.Random(9)
    rule = Rule()
    rows = crowd(rng)
    shingler = jaccard_join.Shingler(4)
    arrays = list({a.tobytes(): a for a in (shingler.shingles(t) for _, t in rows) if len(a)}.values())
    sets, groups, links = jaccard_join.Sets(arrays), jaccard_join.Groups(len(arrays)), []
    jaccard_join.join_region(sets, np.arange(len(arrays)), groups, rule, links, small=8)
    plain = jaccard_join.Groups(len(arrays))
    for i in range(len(arrays)):
        common = sets.common(i, np.arange(len(arrays)))
        for j in np.flatnonzero(rule.linked(common, sets.sizes, sets.sizes[i])):
            plain.join(i, int(j))
    assert [groups.find(i) for i in range(len(arrays))] == [plain.find(i) for i in range(len(arrays))]


def test_linked_sets_share_a_first_region():
    """The slices of any two sets within the radius agree somewhere, also across size classes."""
    rng = random.Random(4)
    for _ in range(400):
        n = rng.randrange(1, 200)
        base = [rng.getrandbits(64) for _ in range(n)]
        most = int(n * 0.15 / 0.85)
        drop = rng.randrange(0, most + 1)
        other = base[drop:] + [rng.getrandbits(64) for _ in range(rng.randrange(0, most - drop + 1))]
        a, b = (np.unique(np.array(x, dtype=np.uint64)) for x in (base, other))
        common = len(np.intersect1d(a, b))
        if 100 * common >= 85 * (len(a) + len(b) - common) and not np.array_equal(a, b):
            assert set(jaccard_join.region_hashes(a, Rule())) & set(jaccard_join.region_hashes(b, Rule()))


def test_jaccard_odd_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    got = [tuple(r) for r in jaccard_join.jaccard_classes(odd_docs).collect()]
    assert sorted(got, key=repr) == brute_components(rows, Rule())
    assert jaccard_join.jaccard_classes(no_docs).count() == 0
    kept = jaccard_join.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    texts = [r.text for r in kept.collect()]
    assert sum(t is not None and t.lower().startswith("the quay") for t in texts) == 2  # one edit is too far at 85 %
    assert texts.count("one") == 1 and None in texts and jaccard_join.keep_one(no_docs).count() == 0


def test_components_equal_union_find(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(i, i + 1) for i in range(1000, 1200)]
    edges += [(5000, 5001 + i) for i in range(300)] + [(7, 7), (None, 1)]
    groups = jaccard_join.Groups(6000)
    for a, b in edges:
        if a is not None:
            groups.join(a, b)
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    seen = {x for e in edges if e[0] is not None for x in e}
    assert set(got) == seen
    by_ours, by_theirs = defaultdict(set), defaultdict(set)
    for node in seen:
        by_ours[got[node]].add(node)
        by_theirs[groups.find(node)].add(node)
    assert sorted(map(sorted, by_ours.values())) == sorted(map(sorted, by_theirs.values()))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---------------------------------------------------------------- packing


def check_packed(docs, rows, capacity):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r.doc_id, r.doc_tokens].append(r)
        sequences[r.sequence_id].append(r)
    expected = Counter()
    for doc, text in docs:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        expected[doc, len(ids)] += 1
        mine = Counter((r.start, r.length, r.ids_crc32) for r in pieces[doc, len(ids)])
        for (start, length, crc) in mine:
            part = np.array(ids[start : start + length], dtype="<u4").tobytes()
            assert len(part) == 4 * length and zlib.crc32(part) == crc
    for (doc, size), times in expected.items():
        covered = Counter(k for r in pieces[doc, size] for k in range(r.start, r.start + r.length))
        assert covered == {k: times for k in range(size)}
    for parts in sequences.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= capacity
    return sum(r.length for r in rows) / capacity / max(1, len(sequences))


@pytest.mark.parametrize("cut", [True, False])
def test_packing(spark, odd_docs, no_docs, cut):
    rows = packing.pack(odd_docs, capacity=128, cut=cut, group_docs=6).collect()
    docs = [(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()]
    assert check_packed(docs, rows, 128) > 0.8
    assert packing.pack(no_docs).count() == 0


def test_differencing_is_near_equal():
    rng = np.random.default_rng(1)
    for windows in (1, 2, 7, 40):
        sizes = rng.integers(1, 100, 200)
        place = packing.difference(sizes, windows)
        loads = np.bincount(place, weights=sizes, minlength=windows)
        assert len(loads) == windows and loads.sum() == sizes.sum() and loads.max() - loads.min() <= 100 / 4 + 1
    # the window count rises with what doesn't fit
    pieces = packing.fill(np.array([6, 6, 6]), 10, cut=False)
    assert len({w for *_, w in pieces}) == 3 and len(packing.fill(np.array([6, 6, 6]), 10, cut=True)) == 4
    assert packing.fill(np.array([], dtype=np.int64), 10, True) == []


def test_encoder_equals_the_library():
    from tokenizers import Tokenizer
    path = public_tokenizers.path("byte_bpe_50k.json")
    tokenizer, encoder = Tokenizer.from_file(path), packing.Encoder(path)
    rng = random.Random(3)
    parts = [" ", "  ", "\n", "\t", "a", "b's", "é", "日本", " foo", "<|endoftext|>", "12", "!!", "\xa0", "\x1c", "　",
             "'", "…", "​", "\x85", "\U0001f642", "İ", "z" * 500]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        assert encoder.encode(text) == np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


# ---------------------------------------------------------------- weighted sampling


def generalised_jaccard(a, b):
    a, b = Counter(w for w in words(a.lower())), Counter(w for w in words(b.lower()))
    both = set(a) | set(b)
    return sum(min(a[w], b[w]) for w in both) / max(1, sum(max(a[w], b[w]) for w in both))


def test_fingerprints(spark):
    import hashlib
    rng = random.Random(8)
    vocabulary = [f"v{i}" for i in range(60)]
    texts = [" ".join(rng.choice(vocabulary[: rng.choice([5, 60])]) for _ in range(rng.randrange(1, 80))) for _ in range(120)]
    rows = sorted(((i * 3, t) for i, t in enumerate(texts)), reverse=True)
    out = {r.id: r for r in weighted_sampling.fingerprints(
        spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    off = []
    for k, (doc, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edit = text[: len(text) - third] + following[:third]
        r = out[doc]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edit.encode()).hexdigest())
        off += [r.near_edited - generalised_jaccard(text, edit), r.near_next - generalised_jaccard(text, following)]
        a, b = r.fingerprint, out[rows[(k + 1) % len(rows)][0]].fingerprint
        assert r.near_next == sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 256, 4)) / 64
    # 64 samples: a standard error of 0.0625 at most each
    assert abs(np.mean(off)) < 0.02 and np.std(off) < 0.07


def test_fingerprints_odd_rows(spark, odd_docs, no_docs):
    out = weighted_sampling.fingerprints(odd_docs).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.near_next <= 1 and 0 <= r.near_edited <= 1 for r in out)
    by_id = defaultdict(set)
    for r in out:
        by_id[r.id].add(r.fingerprint)
    assert by_id[5] == by_id[6] and by_id[0] == by_id[1] == by_id[2] and all(len(v) == 1 for k, v in by_id.items() if k)
    assert weighted_sampling.fingerprints(no_docs).count() == 0
    alone = weighted_sampling.fingerprints(odd_docs.where("doc_id = 8")).collect()
    assert [r.near_next for r in alone] == [1.0]


def test_gamma_quantiles():
    import math
    for u in (0.001, 0.1, 0.5, 0.9, 0.999):
        x = weighted_sampling.gamma_quantile(u)
        assert 1 - (1 + x) * math.exp(-x) == pytest.approx(u, abs=1e-9)


# ---------------------------------------------------------------- SentencePiece


def test_sentencepiece_equals_the_library():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    v = sentencepiece_stream.Vocabulary(path)
    stream = sentencepiece_stream.Stream(v)
    rng = random.Random(6)
    parts = [" ", "  ", "\n", "a", "b", "the", "ing", "é", "être", "日", " foo", "<s>", "12", "!!", "▁", "\U0001f642", "tion",
             "er", "     ", ",", "s.", "***", "ret", "x" * 70]
    for k in range(1500):
        text = "".join(rng.choice(parts) for _ in range(rng.randrange(14)))
        ids = library.encode(text)
        assert list(stream.encode(text)) == ids
        if k % 3 == 0 and text:  # character by character, as a stream
            out = []
            for c in "▁" + text.replace(" ", "▁"):
                out += stream._ids(stream.push(c))
            assert out + list(stream._ids(stream.finish())) == ids
        if "▁" not in text:
            assert sentencepiece_stream.decode(ids, v) == text
    # the window stays bounded by the longest piece, however long the text
    stream.widest = stream.commits = 0
    for c in "abc" * 3000:
        stream.push(c)
    stream.finish()
    assert stream.widest <= 2 * v.longest and stream.commits > 1000


def test_sentencepiece_commits_on_a_table():
    import pyarrow.parquet as pq
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    texts = [t or "" for t in pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()][:60]
    stream = sentencepiece_stream.Stream(sentencepiece_stream.Vocabulary(path))
    ids = [i.tolist() for i in stream.encode_all(texts)]
    assert stream.commits > 100 and stream.commits >= len(stream.table)
    assert ids == sentencepiece.SentencePieceProcessor(model_file=path).encode(texts)


def test_sentencepiece_rows(odd_docs, no_docs):
    import sentencepiece
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    texts = {r.doc_id: r.text or "" for r in odd_docs.collect()}
    for r in sentencepiece_stream.encode(odd_docs).collect():
        assert list(r.ids) == library.encode(texts[r.id])
    assert all(r.round_trip for r in sentencepiece_stream.round_trip(odd_docs).collect())
    assert sentencepiece_stream.round_trip(no_docs).count() == 0
    assert sentencepiece_stream.round_trip(odd_docs).where(F.col("n_chars") == 0).agg(F.max("n_ids")).first()[0] == 0


def test_shared_passages_put_nothing_into_regions(spark, monkeypatch):
    rng = random.Random(5)
    words = lambda n: " ".join(f"w{rng.randrange(10**9)}" for _ in range(n))
    passages = [words(60) for _ in range(20)]
    texts = [f"{passages[i // 6]} {words(140)}" for i in range(120)]
    texts += [f"{texts[0]} more", f"{texts[60]} more words"]
    written = {}
    plain = jaccard_join.staged
    monkeypatch.setattr(jaccard_join, "staged", lambda df, name: written.update({name: plain(df, name)}) or written[name])
    monkeypatch.setattr(jaccard_join, "discard", lambda *dfs: None)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.id: r.component_id for r in jaccard_join._placed(docs.selectExpr("doc_id id", "doc_id mark", "text"), Rule(), 4000)
           .selectExpr("id", "component component_id").collect()}
    assert got[0] == got[120] and got[60] == got[121] and len(set(got.values())) == 120
    assert 4 <= written["members"].count() <= 12


def test_places_that_meet_over_batches():
    rng = np.random.default_rng(3)
    rows = np.unique(rng.integers(0, 60, (90, 2)), axis=0)
    rows = np.repeat(rows, rng.integers(1, 3, len(rows)), axis=0)
    several = {r for r, _ in rows.tolist() if len({k for q, k in rows.tolist() if q == r}) > 1}
    for size in (1, 2, 7, 1000):
        batches = (pa.RecordBatch.from_arrays([pa.array(c) for c in rows[i : i + size].T], names=["region", "key"])
                   for i in range(0, len(rows), size))
        got = [tuple(r.values()) for b in jaccard_join._met(batches) for r in b.to_pylist()]
        assert got == sorted({(r, k) for r, k in rows.tolist() if r in several})


def test_partners_meet_in_as_many_slices_as_they_need():
    rng = random.Random(8)
    for _ in range(400):
        n = rng.randrange(6, 300)
        a = np.unique(np.array([rng.randrange(1 << 63) for _ in range(n)], dtype=np.uint64))
        gone, more = rng.randrange(n // 6 + 1), rng.randrange(n // 6 + 1)
        b = np.unique(np.concatenate([a[gone:], np.array([rng.randrange(1 << 63) for _ in range(more)], dtype=np.uint64)]))
        if not Rule().linked(len(np.intersect1d(a, b)), len(a), len(b)) or len(a) == len(b) == len(np.intersect1d(a, b)):
            continue
        both = np.intersect1d(jaccard_join.region_hashes(a, Rule()), jaccard_join.region_hashes(b, Rule()))
        met = {int(c): int(k) for c, k in zip(*np.unique(both % np.uint64(jaccard_join.CLASSES), return_counts=True), strict=True)}
        least = [jaccard_join.needs(s, Rule()) for s in (a, b)]
        assert any(all(k >= (own if c == number else lower) for number, own, lower in least) for c, k in met.items())
