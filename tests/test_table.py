"""Commits, pruned reads, merges by level, change feed and audit of the keyed table."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from grantflow import schemas
from grantflow.operators.diff import changed_prefixes
from grantflow.operators.upsert import feed_rows, upsert_delta
from grantflow.plans.ingest_registry import ingest_registry
from grantflow.plans.maintain import purge_table
from grantflow.plans.publish import audit_changes, feed_changes, publish
from grantflow.records import registry_spec
from grantflow.sources import items, manifest
from grantflow.streaming import retry, streams
from test_jobs import FULL
from test_sources import document, synopsis

BLANK = {f.name: None for f in schemas.PREPARED.fields} | {"is_forecast": False}


def table_of(spark, rows):
    return spark.createDataFrame([BLANK | {"grant_id": i, "AgencyName": a} for i, a in rows], schemas.PREPARED)


def put(spark, root, rows, millis, **how):
    """One upsert of (id, agency) rows."""
    batch = table_of(spark, rows).drop("revision", "Bill")
    start = items.next_version(spark, root)
    table = items.read_snapshot(spark, root, prefixes=items.prefixes_of(batch), last=start[0])
    table = items.empty_prepared(spark) if table is None else table.drop("id_prefix")
    changed = upsert_delta(table, batch, registry_spec(), F.lit(millis), images=True)
    return items.write_delta(feed_rows(changed, table.columns), root, start=start, **how)


def contents(spark, root, version=None):
    return {r.grant_id: r.AgencyName for r in items.read_snapshot(spark, root, version).select("grant_id", "AgencyName").collect()}


def opened(df):
    """Files that a plan reads."""
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = []
    for i in range(leaves.size()):
        if "FileSourceScan" in leaves.apply(i).getClass().getSimpleName():
            found += list(leaves.apply(i).relation().location().inputFiles())
    return found


def test_read_follows_the_batch(spark, tmp_path):
    root = str(tmp_path / "t")
    everyone = [(f"{p}{n}", "a") for p in range(100, 160) for n in range(20)]
    items.write_snapshot(table_of(spark, everyone), root)
    for k in range(3):
        put(spark, root, [(f"{100 + k}5", f"b{k}"), (f"{100 + k}99", "new")], 1_000 + k)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        whole = opened(items.read_snapshot(spark, root))
        few = opened(items.read_snapshot(spark, root, prefixes=["101", "140", "999"]))
        none = opened(items.read_snapshot(spark, root, prefixes=["999"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert {f.split("id_prefix=")[1][:3] for f in few} == {"101", "140"} and not none
    # of three deltas one holds a wanted prefix; the others aren't opened
    parts = {p.folder: p.kind for p in items.newest(spark, root).parts}
    touched = {next(p for p in parts if p in f) for f in few}
    assert sorted(parts[p] for p in touched) == ["base", "delta"] and len(whole) > 10 * len(few)
    now = contents(spark, root)
    assert len(now) == 1203 and (now["1015"], now["10199"], now["1016"]) == ("b1", "new", "a")
    part = items.read_snapshot(spark, root, prefixes=["101", "140"]).select("grant_id", "AgencyName").collect()
    assert {r.grant_id: r.AgencyName for r in part} == {k: v for k, v in now.items() if k[:3] in ("101", "140")}
    assert items.prefixes_of(table_of(spark, [("12", "x"), (None, "x"), ("1234", "x")])) == ["123", "short"]


def test_one_of_two_writers_wins(spark, tmp_path):
    root = str(tmp_path / "t")
    items.write_snapshot(table_of(spark, [("1001", "a")]), root)
    start = items.next_version(spark, root)
    put(spark, root, [("1002", "b")], 5)
    with pytest.raises(manifest.CommitConflict):
        items.write_delta(table_of(spark, [("1003", "c")]), root, start=start)
    with pytest.raises(ValueError):
        items.write_delta(table_of(spark, [("1003", "c")]), root, version=2)
    with pytest.raises(ValueError):
        items.write_snapshot(table_of(spark, []), root, version=7)
    assert contents(spark, root) == {"1001": "a", "1002": "b"}
    # many writers at once, each starting over when it comes second: nothing is lost
    lost = []

    def write(k):
        for _ in range(40):
            try:
                put(spark, root, [(f"20{k}0", str(k)), ("3000", str(k))], 100 + k)
                return
            except manifest.CommitConflict:
                continue
        lost.append(k)

    threads = [threading.Thread(target=write, args=(k,)) for k in range(5)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    now = contents(spark, root)
    assert not lost and {f"20{k}0" for k in range(5)} <= set(now) and len(now) == 8
    assert items.commits(spark, root) == list(range(1, 8))


def test_merges_keep_reads_short(spark, tmp_path):
    root = str(tmp_path / "t")
    items.write_snapshot(table_of(spark, [(f"5{n:03d}", "a") for n in range(200)]), root)
    expected = {f"5{n:03d}": "a" for n in range(200)}
    most = 0
    for k in range(30):
        rows = [(f"5{(7 * k + j) % 230:03d}", f"v{k}") for j in range(3)]
        put(spark, root, rows, 10 + k)
        expected |= dict(rows)
        items.compact(spark, root, fanout=3)
        most = max(most, len(items.newest(spark, root).parts))
        if k in (5, 14):
            then = (items.newest(spark, root).version, dict(expected))
    # 3 parts a level at most, and few levels, however many batches came
    assert most <= 1 + 3 * 3 and contents(spark, root) == expected
    assert contents(spark, root, then[0]) == then[1]
    assert {m.kind for m in items.marks(spark, root).collect()} == {"base", "delta", "merge"}
    # sums of the prefixes don't depend on how the rows are spread over parts
    states = items.prefix_states(spark, root)
    copy = str(tmp_path / "copy")
    items.write_snapshot(items.read_snapshot(spark, root).drop("id_prefix"), copy)
    assert items.prefix_states(spark, copy) == states
    before = items.newest(spark, root)
    gone = items.vacuum(spark, root, keep=2)
    assert gone and contents(spark, root) == expected
    assert len(items.commits(spark, root)) == 2 and items.newest(spark, root) == before


def test_audit_opens_changed_prefixes(spark, tmp_path):
    root = str(tmp_path / "t")
    items.write_snapshot(table_of(spark, [(f"{p}{n}", "a") for p in range(300, 320) for n in range(10)]), root)
    put(spark, root, [("3015", "b"), ("3159", "a"), ("31777", "c")], 50)  # changed, as it was, new
    put(spark, root, [("3015", "c")], 60)
    wanted = changed_prefixes(items.prefix_states(spark, root, 1), items.prefix_states(spark, root, 3))
    assert {"301", "317"} <= set(wanted) <= {"301", "315", "317"}
    net = {(r.op, r.new.grant_id, r.old.AgencyName if r.old else None, r.new.AgencyName)
           for r in audit_changes(spark, root, 1, 3).collect()}
    assert ("MODIFY", "3015", "a", "c") in net and ("INSERT", "31777", None, "c") in net
    fed = [(r.op, r.old.AgencyName if r.old else None, r.new.AgencyName) for r in feed_changes(spark, root, 1, 3).orderBy("seq").collect()
           if r.new.grant_id == "3015"]
    assert fed == [("MODIFY", "a", "b"), ("MODIFY", "b", "c")]
    assert audit_changes(spark, root, 3, 3).count() == 0
    items.write_delta(table_of(spark, [("3019", "z")]), root)  # without images: looked at, though its sums are unknown
    assert "301" in changed_prefixes(items.prefix_states(spark, root, 3), items.prefix_states(spark, root))
    assert feed_changes(spark, root, 3, 4) is None
    assert [r.new.grant_id for r in audit_changes(spark, root, 3, 4).collect()] == []  # its revision is as it was


def test_purge_above_a_delta(spark, tmp_path):
    root = str(tmp_path / "t")
    put(spark, root, [("1001", "a")], 1)
    put(spark, root, [("1002", "b")], 2)
    with pytest.raises(ValueError):
        purge_table(spark, root, 2, registry=True)
    assert purge_table(spark, root, registry=True).where("AgencyName IS NOT NULL").count() == 0
    put(spark, root, [("1001", "c")], 3)
    assert contents(spark, root) == {"1001": "c", "1002": None}


def test_feed_is_published_once(spark, tmp_path):
    root, out, dead, work = (str(tmp_path / n) for n in ("t", "out", "dead", "work"))

    def ingest(day, doc):
        folder = tmp_path / day
        folder.mkdir()
        (folder / "extract.xml").write_text(doc)
        ingest_registry(spark, str(folder), root, work, day, 1_700_000_000_000 + 1_000 * len(day))

    def drain(checkpoint):
        q = streams.stream_feed(spark, root, out, dead, str(tmp_path / checkpoint), versions_at_once=2)
        assert q.awaitTermination(180) and q.exception() is None
        return sorted((e["type"], e["versions"]["new"]["opportunity"]["id"]) for e in (
            json.loads(r.detail) for r in spark.read.json(out).collect()))

    ingest("d", document(synopsis(1001, extra=FULL), synopsis(1002, extra=FULL)))
    assert drain("c") == [("create", "1001"), ("create", "1002")]
    assert drain("c") == [("create", "1001"), ("create", "1002")]
    ingest("dd", document(synopsis(1001, "01052024", FULL), synopsis(1002, extra=FULL)))
    ingest("ddd", document(synopsis(1001, "01062024", FULL), synopsis(1003)))
    items.compact(spark, root, fanout=2)
    assert drain("c") == [("create", "1001"), ("create", "1002"), ("update", "1001"), ("update", "1001")]
    assert [r.key for r in spark.read.json(f"{dead}/writer=*").collect()] == ["1003"]
    # a batch job over the same versions publishes the same, and a new checkpoint replaces nothing of the old one
    done = publish(spark, root, work, str(tmp_path / "p"), "p", 1, None, items.newest(spark, root).version)
    assert done["events"].count() == 4
    got = {(r.metric, r.tags.get("change") or r.tags.get("type")): r.value for r in done["samples"].collect()}
    assert got[("invocation_batch_size", None)] == 5 and got[("record.failed", None)] == 1
    assert got[("item_image.build", "NewImage")] == 5 and got[("item_image.build", "OldImage")] == 2
    assert got[("grant_data.invalid", "NewImage")] == 1 and got[("event.published", "update")] == 2
    assert len(drain("other")) == 8 and spark.read.json(out).select("writer").distinct().count() == 2


def test_bad_rows_stand_alone(spark, tmp_path):
    """A row that breaks its batch leaves the others published; it is tried again, and dead after five times."""
    rows = spark.range(10_000).select("id", F.concat(F.lit("v"), "id").alias("v"))
    rows = rows.withColumn("v", F.when(F.col("id").isin(17, 4_711), "boom").otherwise(F.col("v")))
    calls = []

    def apply(part, name):
        calls.append(name)
        # fails while it runs, as a cast of an odd value would
        checked = part.withColumn("v", F.when(F.col("v") == "boom", F.raise_error(F.lit("odd value"))).otherwise(F.col("v")))
        checked.write.mode("overwrite").parquet(f"{tmp_path}/out/{name}")

    bad = retry.apply_halving(rows, str(tmp_path / "work"), apply)
    assert sorted(r.id for r in bad.collect()) == [17, 4_711] and "odd value" in bad.first().error
    assert spark.read.parquet(f"{tmp_path}/out").select("id").distinct().count() == 9_998 and len(calls) < 100
    retry.failures(bad).write.parquet(f"{tmp_path}/dead/generation=0")
    healed = []

    def better(part, name):
        healed.append(name)
        part.withColumn("v", F.when(F.col("id") == 17, F.raise_error(F.lit("still odd")))).write.mode("overwrite").parquet(
            f"{tmp_path}/again/{name}")

    for n in range(1, 5):
        kept = retry.redrive(spark, f"{tmp_path}/dead", f"r{n}", str(tmp_path / "work"), "id long, v string", better).collect()
        assert [(r.attempts, r.dead) for r in kept] == [(n + 1, n == 4)]
    before = len(healed)
    kept = retry.redrive(spark, f"{tmp_path}/dead", "r5", str(tmp_path / "work"), "id long, v string", better).collect()
    assert [(r.attempts, r.dead) for r in kept] == [(5, True)] and len(healed) == before + 1
    with pytest.raises(RuntimeError):  # what fails without any row is no matter of rows
        def broken(part, name):
            raise RuntimeError("no such folder")
        retry.apply_halving(rows.limit(0), str(tmp_path / "w2"), broken)
