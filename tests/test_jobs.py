import json
from datetime import datetime

from pyspark.sql import functions as F

from grantflow import schemas
from grantflow.operators.freshness import latest_per_key, newest_record_order
from grantflow.operators.upsert import upsert_changed, upsert_delta
from grantflow.plans.ingest_mail import download_requests, receive_mail
from grantflow.plans.ingest_registry import ingest_registry
from grantflow.plans.ingest_sheet import ingest_sheet
from grantflow.plans.maintain import FeedActive, purge_listing, purge_table
from grantflow.plans.publish import publish
from grantflow.records import registry_spec
from grantflow.sources import archives, items
from grantflow.sources.mail_text import parse_mail, read_mail
from grantflow.sources.registry_xml import parse_chunks
from grantflow.streaming import streams
from test_sources import HEADER, _row, _zip, document, forecast, synopsis
from xlsx import workbook

import pytest

FULL = (
    "<OpportunityNumber>N-1</OpportunityNumber><OpportunityCategory>D</OpportunityCategory>"
    "<PostDate>01012023</PostDate><CostSharingOrMatchingRequirement>No</CostSharingOrMatchingRequirement>"
)


def test_ingest_publish_purge(spark, tmp_path):
    root, work, out = (str(tmp_path / n) for n in ("prepared", "work", "events"))
    day1, day2, books = tmp_path / "d1", tmp_path / "d2", tmp_path / "books"
    for d in (day1, day2, books):
        d.mkdir()
    (day1 / "extract.xml").write_text(document(
        synopsis(1001, extra=FULL), synopsis(1002, extra=FULL), synopsis(1003, "2023-01-02", FULL), synopsis(12, extra=FULL),
        forecast(1004)))
    run = ingest_registry(spark, str(day1), root, work, "r1", 1_700_000_000_000, 1)
    assert {r.outcome: r.records for r in run["counts"].collect()} == {"created": 2, "failed": 2}
    first = items.read_snapshot(spark, root)
    assert sorted(r.grant_id for r in first.collect()) == ["1001", "1002"]
    reasons = spark.read.parquet(f"{root}/_quarantine").select("reason").collect()
    assert sorted(r.reason for r in reasons) == ["bad_date", "short_id"]

    # the same extract again changes nothing
    ingest_registry(spark, str(day1), root, work, "r1b", 1_700_000_500_000, 2)
    assert publish(spark, root, work, out, "p0", 1, 1, 2)["events"].count() == 0

    # an archive on the next day: one update, one duplicate key, one new
    (day2 / "archive.zip").write_bytes(_zip([("GrantsDBExtract.xml", document(
        synopsis(1001, "01032023", FULL + "<Version>a</Version>"), synopsis(1001, "01042023", FULL + "<Version>b</Version>"),
        synopsis(1002, extra=FULL), synopsis(1005, extra=FULL)))]))
    chunks = archives.archive_chunks(archives.unpack_archives(spark, str(day2)))
    run = ingest_registry(spark, "", root, work, "r2", 1_700_001_000_000, 3, chunks=chunks)
    assert {r.outcome: r.records for r in run["counts"].collect()} == {"updated": 2, "skipped": 1, "created": 1}

    (books / "a.xlsx").write_bytes(workbook(
        [["x"], [], HEADER, ["Some Act"], _row("10.1", 1), _row("10.2", 2)],
        {5: "https://grants.gov/search-results-detail/1002", 6: "https://grants.gov/search-results-detail/7777"}))
    ingest_sheet(spark, str(books), root, work, "s1", 1_700_002_000_000, 4)
    now = {r.grant_id: r for r in items.read_snapshot(spark, root).collect()}
    assert sorted(now) == ["1001", "1002", "1005", "7777"]
    assert (now["1001"].Version, now["1002"].Bill, now["7777"].Bill, now["7777"].Version) == ("b", "Some Act", "Some Act", None)

    done = publish(spark, root, work, out, "p1", 1_700_003_000_000, 1, 4)
    events = {r.seq: json.loads(r.detail) for r in done["events"].collect()}
    kinds = sorted((e["type"], e["versions"]["new"]["opportunity"]["id"]) for e in events.values())
    assert kinds == [("create", "1005"), ("update", "1001"), ("update", "1002")]
    assert [(r.key, r.reason) for r in done["rejected"].collect()] == [("7777", "invalid_new")]
    written = spark.read.json(f"{out}/run_id=p1")
    assert written.count() == 3 and set(written.columns) == {
        "source", "detail_type", "type", "detail", "seq", "event_time"}
    by_type = {r.tags["type"]: r.value for r in done["samples"].where("metric = 'event.published'").collect()}
    assert by_type == {"create": 1.0, "update": 2.0}

    with pytest.raises(FeedActive):
        purge_table(spark, root, 5, feed_active=True, registry=True)
    assert purge_table(spark, root, 5, dry_run=True).first()["items"] == 4
    purged = {r.grant_id: r for r in purge_table(spark, root, 5, sheet=True, keep_revision=True).collect()}
    assert purged["1002"].Bill is None and purged["1002"].revision == now["1002"].revision
    assert purge_table(spark, root, 6, everything=True).count() == 0
    assert items.read_snapshot(spark, root).count() == 0


def test_caps_in_ingest(spark, tmp_path):
    (tmp_path / "x").mkdir()
    (tmp_path / "x" / "extract.xml").write_text(document(*[synopsis(1000 + i) for i in range(10)],
                                                         *[forecast(2000 + i) for i in range(10)]))
    root = str(tmp_path / "p")
    ingest_registry(spark, str(tmp_path / "x"), root, str(tmp_path / "w"), "r", 1, 1, forecasts=True,
                    caps={"total": 5, "synopsis": 3})
    got = sorted(r.grant_id for r in items.read_snapshot(spark, root).collect())
    assert got == ["1000", "1001", "1002", "2000", "2001"]


GOOD_MAIL = "\r\n".join([
    "From: \"Lee, Kim\" <kim.lee@letters.test>", "Content-Type: text/plain", "Date: Mon, 5 Feb 2024 07:08:09 +0100",
    "Subject: Week seven", "Received-SPF: pass (relay of letters.test)", "X-SES-Spam-Verdict: PASS",
    "X-SES-Virus-Verdict: PASS", "", "The sheet is ready.", "",
])


def test_mail(spark, tmp_path):
    mails = {
        "good": GOOD_MAIL, "virus": GOOD_MAIL.replace("Virus-Verdict: PASS", "Virus-Verdict: FAIL"),
        "spam": GOOD_MAIL.replace("Spam-Verdict: PASS", "Spam-Verdict: FAIL"),
        "spf": GOOD_MAIL.replace("pass (", "fail ("), "sender": GOOD_MAIL.replace("letters.test", "other.test"),
        "nofrom": GOOD_MAIL.replace("From:", "X-From:"), "badfrom": GOOD_MAIL.replace("<kim.lee@letters.test>", ""),
        "nodate": GOOD_MAIL.replace("Date:", "X-Date:"), "baddate": GOOD_MAIL.replace("5 Feb", "one day"),
        "junk": "this is no mail\n\nat all", "cut": "From: a@b.c",
    }
    for name, text in mails.items():
        (tmp_path / f"{name}.eml").write_bytes(text.encode())
    out = receive_mail(read_mail(spark, str(tmp_path)), ["letters.test"])
    got = {r.path.rsplit("/", 1)[1][:-4]: (r.verdict, r.mail_key) for r in out.collect()}
    assert got.pop("good") == ("trusted", "sources/2024/02/05/ffis.org/raw.eml")
    assert {k: v[0] for k, v in got.items()} == {
        "virus": "virus", "spam": "spam", "spf": "spf", "sender": "sender", "nofrom": "sender", "badfrom": "sender",
        "nodate": "date", "baddate": "date", "junk": "message", "cut": "message"}
    parsed = parse_mail(read_mail(spark, str(tmp_path))).where("sender IS NOT NULL AND parse_error IS NULL")
    assert parsed.select("sent_at").first().sent_at == datetime(2024, 2, 5, 6, 8, 9)


def test_download_requests(spark):
    def mail(*parts, mark="=_week"):
        body = "".join(f"--{mark}\nContent-Type: {kind}\n\n{text}\n" for kind, text in parts)
        return f"Subject: week\nContent-Type: multipart/alternative; boundary=\"{mark}\"\n\n{body}--{mark}--\n"

    url = "https://mcusercontent.com/9f3c/files/week-07.xlsx"
    other = url.replace("07", "08")
    plain, page = ("text/plain", f"The sheet:\n{url}\nBye"), ("text/html", f"<a href={other}>sheet</a>")
    cases = {
        "url": [mail(page, plain), mail(plain), mail(plain, mark="a+b")], "none": [mail(("text/plain", "Bye"), page)],
        "multiple": [mail(("text/plain", f"{url}\nor\n{other}"))], "no_plaintext": [mail(page)],
        "not_multipart": [f"Content-Type: text/plain\n\n{url}"], "message": ["", "no header"],
    }
    rows = [(status, text, f"{n}/ffis.org/raw.eml") for status, texts in cases.items() for n, text in enumerate(texts)]
    df = spark.createDataFrame(rows, "expected string, text string, mail_key string")
    got = download_requests(df).collect()
    assert [r.status for r in got] == [r.expected for r in got] and len(got) == len(rows)
    for r in got:
        if r.status == "url":
            assert json.loads(r.message) == {"sourceFileKey": r.mail_key, "downloadUrl": url}
            assert r.download_key == r.mail_key.replace("raw.eml", "download.xlsx")
        else:
            assert r.message is None


def test_purge_listing(spark, tmp_path):
    for key in ("654/654321/ffis.org/v1.json", "654/654321/grants.gov/v2.OpportunitySynopsisDetail_1_0.xml", "654/x.txt"):
        path = tmp_path / key
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text("x")
    run = lambda **what: sorted(r.key for r in purge_listing(
        spark, str(tmp_path), strip=f"file:{tmp_path}/", **what).collect())
    assert run(sheet=True) == ["654/654321/ffis.org/v1.json"]
    assert run(globs=("654/*",)) == ["654/x.txt"] and len(run(everything=True)) == 3


def test_stream_upsert_equals_batch(spark, tmp_path):
    landing, root = tmp_path / "landing", str(tmp_path / "prepared")
    spec = registry_spec()
    order = lambda: newest_record_order(spec, "file", "split", "ord")

    def records(batch):
        return parse_chunks(streams.with_order(batch))[0]

    def drain():
        stream = streams.stream_route(spark, str(landing), "split_registry")
        q = streams.stream_upsert(stream, root, spec, str(tmp_path / "ck"), order(), records)
        assert q.awaitTermination(120)

    for day, doc in (("01", document(synopsis(1001), synopsis(1002))), ("02", document(synopsis(1002, "01052023"), synopsis(1003))),
                     ("03", document(synopsis(1002, "01032023"), synopsis(1001)))):
        path = landing / f"sources/2023/01/{day}/grants.gov"
        path.mkdir(parents=True)
        (path / "extract.xml").write_text(doc)
        (path / "archive.zip").write_bytes(b"x")
        drain()
    assert items.commits(spark, root) == [1, 2, 3]
    streamed = items.read_snapshot(spark, root).drop("id_prefix", "revision")
    before = items.read_snapshot(spark, root)
    drain()  # nothing new: no new snapshot
    assert items.commits(spark, root) == [1, 2, 3] and before.count() == 3

    chunks = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "extract.xml").option(
        "lineSep", "_1_0>").text(str(landing)).select(
        F.col("_metadata.file_path").alias("file"), F.lit(0).alias("split"),
        F.monotonically_increasing_id().alias("ord"), F.col("value").alias("chunk"))
    latest = latest_per_key(parse_chunks(chunks)[0], "grant_id", *order())
    batch = upsert_changed(items.empty_prepared(spark), latest, spec, F.lit(1)).drop("changed", "revision")
    assert sorted(streamed.collect(), key=str) == sorted(batch.select(streamed.columns).collect(), key=str)


def counted(spark, root):
    """Rows now stored, and dead letters by reason."""
    dead = spark.read.parquet(f"{root}/_quarantine").groupBy("reason").count().collect()
    return items.read_snapshot(spark, root).count(), {r.reason: r["count"] for r in dead}


def test_stream_on_a_table_with_snapshots(spark, tmp_path):
    """Every record of a stream is stored, skipped or in the quarantine: on a table that has commits already, after the
    checkpoint is lost, and with a second stream on the same table."""
    landing, other, root = tmp_path / "landing", tmp_path / "other", str(tmp_path / "prepared")
    books = tmp_path / "d0"
    books.mkdir()
    (books / "extract.xml").write_text(document(synopsis(1001), synopsis(1002)))
    ingest_registry(spark, str(books), root, str(tmp_path / "w"), "r0", 1_700_000_000_000, 1)
    with pytest.raises(ValueError):
        ingest_registry(spark, str(books), root, str(tmp_path / "w"), "r0", 1_700_000_000_000, 1)
    order = newest_record_order(registry_spec(), "file", "split", "ord")

    def records(batch):
        good, bad = parse_chunks(streams.with_order(batch))
        return good, bad.select(F.lit(None).cast("string").alias("key"), F.col("file").alias("seq"), "reason",
                                F.col("chunk").alias("payload"))

    def drain(place, checkpoint):
        stream = streams.stream_route(spark, str(place), "split_registry")
        q = streams.stream_upsert(stream, root, registry_spec(), str(tmp_path / checkpoint), order, records)
        assert q.awaitTermination(180) and q.exception() is None

    def put(place, day, doc):
        path = place / f"sources/2024/02/{day}/grants.gov"
        path.mkdir(parents=True)
        (path / "extract.xml").write_text(doc)
        odd = place / f"elsewhere/2024/02/{day}/grants.gov"  # no route leads here
        odd.mkdir(parents=True)
        (odd / "extract.xml").write_text(document(synopsis(9009)))

    put(landing, "01", document(
        synopsis(1002, "01052024"), synopsis(1003), synopsis(12), synopsis(1004, "2024-01-02"), synopsis(1001))
        + "<OpportunitySynopsisDetail_1_0><OpportunityID>1005</Opp")
    drain(landing, "c1")
    # 2 before; 1 updated, 1 created, 1 skipped, 3 failed
    assert counted(spark, root) == (3, {"short_id": 1, "bad_date": 1, "unclosed": 1})
    assert [(r.kind, r.version) for r in items.marks(spark, root).orderBy("version").collect()] == [("delta", 1), ("delta", 2)]
    # a lost checkpoint: the input is read again and changes nothing
    before = sorted(items.read_snapshot(spark, root).collect(), key=str)
    drain(landing, "c2")
    assert sorted(items.read_snapshot(spark, root).collect(), key=str) == before
    put(other, "02", document(synopsis(1001, "01062024"), synopsis(1006)))
    drain(other, "c3")
    assert sorted(r.grant_id for r in items.read_snapshot(spark, root).collect()) == ["1001", "1002", "1003", "1006"]


def test_deltas_follow_the_batch(spark, tmp_path):
    root = str(tmp_path / "t")
    spec = registry_spec()
    blank = {f.name: None for f in schemas.PREPARED.fields} | {"is_forecast": False}
    rows = [blank | {"grant_id": str(10_000 + i), "AgencyName": "a"} for i in range(300)]
    items.write_snapshot(spark.createDataFrame(rows, schemas.PREPARED), root, 1)
    for version, (name, ids) in enumerate((("b", (5, 6)), ("c", (6, 7, 900))), 2):
        table = items.read_snapshot(spark, root).drop("id_prefix")
        batch = spark.createDataFrame([blank | {"grant_id": str(10_000 + i), "AgencyName": name} for i in ids], schemas.PREPARED)
        changed = upsert_delta(table, batch, spec, F.lit(version))
        items.write_delta(changed.drop("changed"), root, version)
        assert items.newest(spark, root).parts[-1].rows == len(ids)
    now = {r.grant_id: r.AgencyName for r in items.read_snapshot(spark, root).collect()}
    assert len(now) == 301 and [now[str(10_000 + i)] for i in (4, 5, 6, 7, 900)] == ["a", "b", "c", "c", "c"]
    then = {r.grant_id: r.AgencyName for r in items.read_snapshot(spark, root, 2).collect()}
    assert len(then) == 300 and then["10006"] == "b"
    assert items.compact(spark, root, fanout=3) == 0 and items.compact(spark, root, fanout=2) == 1
    assert {r.grant_id: r.AgencyName for r in items.read_snapshot(spark, root).collect()} == now
    merged = items.newest(spark, root)
    assert [(p.kind, p.rows, p.level) for p in merged.parts] == [("base", 300, 0), ("delta", 4, 1)]


def test_stream_rollup_equals_batch(spark, tmp_path):
    rows = [(datetime(2024, 1, 1, h, m), "split", "record.created", float(h), {}) for h in range(5) for m in (0, 20, 40)]
    spark.createDataFrame(rows, schemas.METRIC_SAMPLE).coalesce(1).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schemas.METRIC_SAMPLE).parquet(str(tmp_path / "in"))
    out = streams.stream_rollup(stream, "1 hour", ["step"], {"total": F.sum("value")})
    q = out.writeStream.format("memory").queryName("rolled").outputMode("complete").trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted((r.bucket.hour, r.total) for r in spark.table("rolled").collect()) == [(h, 3.0 * h) for h in range(5)]


def test_stream_publish(spark, tmp_path):
    from test_operators import changes_table, item
    rows = [("INSERT", "1", None, item()), ("INSERT", "2", None, item(OpportunityID=""))]
    df = changes_table(spark, rows)
    df.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    q = streams.stream_publish(stream, str(tmp_path / "out"), str(tmp_path / "dead"), str(tmp_path / "ck"))
    assert q.awaitTermination(180)
    assert [r.seq for r in spark.read.schema("seq string").json(str(tmp_path / "out/*/batch=0")).collect()] == ["1"]
    assert spark.read.json(str(tmp_path / "dead/writer=*/batch=0")).first().reason == "invalid_new"
