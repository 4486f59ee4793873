"""Pages, archives, models, conversations and the pipeline."""

import base64
import gzip
import hashlib
import html
import io
import os
import random
import time
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from grantflow.llm import html_blocks, language_id, quotations, recurrent, toxicity, warc
from grantflow.llm.queries import QUERIES

# ---------------------------------------------------------------- archives


@pytest.fixture(scope="module")
def odd_pages(spark):
    rows = [(1, "http://a.test/", "<p>x</p>"), (2, "http://b.test/ with blank", "<p>x</p>"), (3, None, None), (4, "http://c\r\nd", ""),
            (5, "http://é.test", "é" * 70_000), (None, "http://n.test", "<p>x</p>"), (None, None, "alone"), (7, "http://t", "\r\n\r\n"),
            (2, "http://b.test/ with blank", "<p>x</p>")]
    return spark.createDataFrame([(*r, "z", 0) for r in rows], "page_id long, url string, html string, payload string, revisit int")


def test_warc_round_trip(spark, odd_pages, tmp_path):
    rows = [tuple(r)[:3] for r in odd_pages.collect()]
    manifest = warc.write_warc(warc.deduplicated(odd_pages), f"file://{tmp_path}/archive", roll_bytes=300)
    assert manifest.agg(F.sum("records")).first()[0] == len(rows) and manifest.count() > 1
    got = warc.read_warc(spark, manifest).withColumn("page", warc.page_of("record_id")).withColumn(
        "target", warc.page_of("refers_to_id")).collect()
    keeper = {}
    for page, _, text in rows:
        payload = (text or "").encode()
        keeper[payload] = max((p for p in (keeper.get(payload), page) if p is not None), default=None)
    expected = []
    for page, url, text in rows:
        payload = (text or "").encode()
        revisit = keeper[payload] is not None and page != keeper[payload]
        expected.append((page, url, len(payload), base64.b32encode(hashlib.sha1(payload).digest()).decode(),
                         "revisit" if revisit else "response", keeper[payload] if revisit else None,
                         None if revisit else payload))
    ours = [(r.page, r.uri, r.payload_bytes, r.payload_digest, r.record_type, r.target,
             None if r.payload is None else bytes(r.payload)) for r in got]
    assert sorted(ours, key=repr) == sorted(expected, key=repr)
    assert all(r.digest_ok and r.error is None for r in got)
    # any gzip reader finds one member after the other
    files = [r.file.removeprefix("file://") for r in manifest.collect()]
    text = b"".join(gzip.open(f).read() for f in files)
    assert text.count(b"WARC/1.1\r\n") == len(rows)
    assert warc.archive_round_trip(spark, odd_pages.limit(0)).count() == 0


def test_broken_archives():
    good = [warc.encode_record(i, f"http://{i}", os.urandom(90_000), None, False) for i in range(3)]
    read = lambda data: list(warc.read_archive(io.BytesIO(data)))
    assert [r["error"] for r in read(b"".join(good))] == [None] * 3
    assert [r["position"] for r in read(b"".join(good))] == [0, len(good[0]), len(good[0]) + len(good[1])]
    for data in (good[0] + good[1][:-50_000], good[0] + b"junk", good[0] + gzip.compress(b"no record at all"),
                 good[0] + gzip.compress(gzip.decompress(good[1]) + b"more"),
                 good[0] + gzip.compress(gzip.decompress(good[1])[:-300])):
        rows = read(data)
        assert [bool(r["error"]) for r in rows] == [False, True], data[:20]
    changed = gzip.decompress(good[1]).replace(b"HTTP/1.1 200", b"HTTP/1.1 201")
    assert [r["digest_ok"] for r in read(gzip.compress(changed))] == [False]
    assert read(b"") == []


# ---------------------------------------------------------------- recurrent layers


@pytest.mark.parametrize("layer", [recurrent.Gru, recurrent.Lstm])
def test_gradients(layer):
    rng = np.random.default_rng(0)
    gx = rng.normal(size=(5, 2, layer.gates * 3, 4)).astype(np.float32)
    u = rng.normal(size=(2, layer.gates * 3, 3)).astype(np.float32) * 0.5
    goal = rng.normal(size=(5, 6, 4))
    loss = lambda: float((recurrent.flip(layer.forward(gx, u)[0]).astype(np.float64) * goal).sum())
    _, kept = layer.forward(gx, u, keep=True)
    d_gx, d_u = layer.backward(recurrent.unflip(goal.astype(np.float32)), u, kept)
    for array, gradient in ((gx, d_gx), (u, d_u)):
        for _ in range(12):
            at = tuple(rng.integers(n) for n in array.shape)
            before = array[at]
            array[at] = before + 1e-2
            up = loss()
            array[at] = before - 1e-2
            down = loss()
            array[at] = before
            assert (up - down) / 2e-2 == pytest.approx(gradient[at], rel=0.05, abs=0.02)


# ---------------------------------------------------------------- language, toxicity


def held_out(parts, part):
    return F.crc32(F.col("id").cast("string")) % parts == part


FOLDER = os.environ.get("TEST_LLM_DIR", "/root/testdata/sf0.01")
tables = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no tables here")


@tables
def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    out = language_id.identify(docs, held_out=held_out(4, 2))
    rows = out.join(docs.withColumnRenamed("doc_id", "id"), "id").collect()
    assert len(rows) == docs.count() and all(r.held_out == (zlib.crc32(str(r.id).encode()) % 4 == 2) for r in rows)
    test = [r for r in rows if r.held_out and len(r.text) > 50]
    assert np.mean([r.lang_pred == r.lang for r in test]) > 0.97
    assert all(0 <= r.score <= 1 for r in rows)


@tables
def test_toxicity_held_out_accuracy(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{n}.parquet") for n in ("documents", "labels"))
    out = toxicity.score_toxicity(docs, labels, held_out=held_out(5, 0))
    assert out.count() == docs.count()
    rows = out.join(labels.withColumnRenamed("doc_id", "id"), "id").where("held_out").collect()
    wrong = sum(r.predicted != r.toxic for r in rows)
    assert wrong <= 0.1 * len(rows) and any(r.predicted for r in rows)


def test_models_on_odd_rows(spark, odd_docs, no_docs):
    out = {(r.id, r.lang_pred, r.score) for r in language_id.identify(odd_docs).collect()}
    assert {(i, p) for i, p, _ in out if i in (0, 1, 2)} == {(0, "und"), (1, "und"), (2, "und")}
    assert language_id.identify(odd_docs).count() == odd_docs.count() and language_id.identify(no_docs).count() == 0
    unlabelled = language_id.identify(odd_docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}

    marks = spark.createDataFrame([(i, i % 2, 9) for i in range(4, 15)] + [(5, 1, 9), (None, 1, 9), (6, None, 9), (99, 1, 9)],
                                  "doc_id long, toxic int, score int")
    out = toxicity.score_toxicity(odd_docs, marks).collect()
    assert len(out) == odd_docs.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)
    assert {r.score for r in out if r.id in (0, 1, 2)} == {0.0}
    assert {r.score for r in toxicity.score_toxicity(odd_docs, marks.limit(0)).collect()} == {0.0}
    assert toxicity.score_toxicity(no_docs, marks).count() == 0
    kept = toxicity.keep_civil(odd_docs, marks.limit(0))
    assert kept.columns == odd_docs.columns and kept.count() == odd_docs.count()


def test_windows_cover_texts():
    for n in (0, 1, 8, 239, 256, 257, 1000):
        labelled = [k for a, b, first, last in language_id.windows(np.zeros(n)) for k in range(first, last)]
        assert labelled == list(range(n))
        assert all(a <= first and last <= b and b - a <= language_id.WINDOW for a, b, first, last in language_id.windows(np.zeros(n)))
    for n in (0, 1, 31, 32, 33, 48, 49, 500):
        x = toxicity.cut_windows(np.arange(n), -1)
        assert set(x.ravel()) - {-1} == set(range(n)) and x.shape[0] == toxicity.WINDOW


# ---------------------------------------------------------------- pages


def test_blocks():
    page = ("<!doctype html><title>T</title><script>var a='</p><p>no';</script><!-- <p>no</p> --><body><nav class='top-menu'><a href=x>One</a>"
            "</nav><div id=main><p>a &amp; b&nbsp;&lt;c <b>d<br>e</p><p>f<p>g</div>tail<style>x")
    blocks = html_blocks.read_blocks(page)
    assert [b.text for b in blocks] == ["T", "One", "a & b <c d e", "f", "g", "tail"]
    assert blocks[1].linked == 3 and ".menu" in blocks[1].path and blocks[4].last[-1] == "p"
    assert html_blocks.read_blocks(None) == html_blocks.read_blocks("") == []
    for odd in ("<", "<p", "<p class=\"" + "x" * 9000, "</p></div>", "<a " * 3000, "&#xZZ; &bogus; &am", "<p>" * 3000 + "deep"):
        html_blocks.read_blocks(odd)


def test_blocks_of_custom_elements_long_values_and_formulas():
    texts = lambda page: [b.text for b in html_blocks.read_blocks(page)]
    for name in ("svg-icon", "template-card", "select-box", "style:x"):
        assert texts(f"<header><{name} name='x'></{name}></header><article><p>Body text one.</p></article>") == ["Body text one."]
    assert texts("<svg\n><text>no</text></SVG ><select/><p>a<style>x</style x>b<!-- no") == ["ab"]
    for q in "\"'":
        value = "<p class=no>no</p> > " * 5_000
        page = f"<div data-props={q}{value}{q} class = 'main'>one</div><iframe srcdoc={q}</iframe>{value}/>{q}>no</iframe><p>two"
        blocks = html_blocks.read_blocks(page)
        assert [b.text for b in blocks] == ["one", "two"] and ".main" in blocks[0].path and ".no" not in blocks[0].path
    assert texts("<p>if <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then</p><object data=a><p>in words</p></object>"
                 "<canvas><p>a table</p></canvas>") == ["if x=1 then", "in words", "a table"]
    # quotes that don't delimit a value, or have no end
    assert texts("<p class=\"a\"\">one</p><p title=it's>two's</p><p title='a>three") == ["one", "two's", "three"]


@pytest.mark.parametrize("part", ["<a ", "<a x=\">\" ", "<a x='>\" ", "<!", "<a x=\"", "<a =\"'>", "<!-- >", "<svg ><svg-a>", "a=\"'<p ", "<p x=>\"'"])
def test_blocks_take_time_in_proportion(part):
    start = time.process_time()
    html_blocks.read_blocks("<p>" + part * (600_000 // len(part)))
    assert time.process_time() - start < 10


@pytest.fixture(scope="module")
def model():
    # real pages aren't needed: the grammar alone teaches
    return html_blocks.train([])


def test_labels_of_unseen_pages(model):
    grammar = html_blocks.Grammar([f"w{i}" for i in range(300)], seed=77)
    pages = [grammar.page() for _ in range(150)]
    labels = html_blocks.label([b for b, _ in pages], model, html_blocks.Features())
    found = np.concatenate([k == (y > 0) for k, (_, y) in zip(labels, pages, strict=True)])
    assert found.mean() > 0.95


@tables
def test_pages_exactly(spark):
    pages = spark.read.parquet(f"{FOLDER}/pages.parquet")
    out = {r.id: r for r in html_blocks.extract(pages).collect()}
    exact = 0
    for r in pages.collect():
        inner = r.html[r.html.index("<article>") + 9 : r.html.index("</article>")]
        for tag in ("<p>", "</p>", "<h1>", "</h1>"):
            inner = inner.replace(tag, "\n")
        parts = (" ".join(html.unescape(p.replace("<b>", "").replace("<br>", " ")).split()) for p in inner.split("\n"))
        text = "\n".join(p for p in parts if p)
        exact += out[r.page_id].text == text
        assert out[r.page_id].n_chars == len(out[r.page_id].text)
    assert exact >= 0.98 * len(out)


def test_pages_odd_rows(spark, odd_pages):
    out = html_blocks.extract(odd_pages).collect()
    assert len(out) == 9 and {r.text for r in out if r.id in (3, 4, 7)} == {""}
    assert html_blocks.extract(odd_pages.limit(0)).count() == 0


# ---------------------------------------------------------------- conversations


def test_quotations_equal_sql(spark, tmp_path):
    rng = random.Random(3)
    rows = []
    for conv in range(6):
        said = []
        for turn in range(14):
            lines = []
            if said and rng.random() < 0.8:
                if rng.random() < 0.5:
                    lines.append("On Monday, someone wrote:")
                for line in rng.choice(said).split("\n"):
                    if rng.random() < 0.8:
                        lines.append(rng.choice([">", "> ", ">> ", " > "]) + (line.upper() if rng.random() < 0.3 else line))
            lines += [rng.choice(["yes", "no", f"I think {rng.randrange(9)} boats", "", f"turn  {turn} of {conv}"]) for _ in range(3)]
            said.append("\n".join(lines))
            rows.append((conv, turn, rng.choice(["user", None]), said[-1]))
    rows += [(None, 1, "x", "> yes"), (3, None, "x", "> yes"), (9, 0, None, None), (9, 1, "x", "> > nothing")]
    docs = spark.createDataFrame([(*r, 0, "k") for r in rows], "conv_id long, turn long, role string, text string, level int, line string")
    docs.write.parquet(str(tmp_path / "c"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    theirs = con.execute(quotations.ORACLE_SQL)
    names = [d[0] for d in theirs.description]
    expected = sorted(map(repr, theirs.fetchall()))
    got = quotations.linked_messages(docs)
    assert sorted(names) == sorted(got.columns)
    ours = [tuple(r) for r in got.select(names).collect()]
    assert sorted(map(repr, ours)) == expected
    depth = names.index("depth")
    assert max(r[depth] for r in ours) > 3
    assert quotations.linked_messages(docs.limit(0)).count() == 0


# ---------------------------------------------------------------- pipeline


@tables
def test_pipeline(spark):
    kept = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = kept.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = kept
        kept = stage(spark, before, FOLDER)
        assert kept.columns == columns, name
        assert kept.join(before, columns).count() == kept.count() < before.count()
    # one document of each class stays: no two of them link
    from grantflow.llm.jaccard_join import Rule, jaccard_classes
    classes = jaccard_classes(kept, rule=Rule(5, 80))
    assert classes.groupBy("component_id").count().where("count > 1").count() == 0
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, FOLDER)
    assert pieces.select("doc_id").distinct().count() == kept.count()
    run = corpus_pipeline.run(spark, FOLDER)
    assert run.columns == pieces.columns and run.count() == pieces.count()


def test_every_operator_is_registered():
    assert sorted({int(n[2:].split("_")[0]) for n in QUERIES}) == list(range(1, 11))


def test_stages_on_odd_rows(spark, odd_docs, tmp_path):
    spark.createDataFrame([(5, 0, 1)], "doc_id long, toxic int, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    for docs in (odd_docs, odd_docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES:
            docs = stage(spark, docs, str(tmp_path))
        assert docs.columns[0] == "doc_id"
        docs.collect()
