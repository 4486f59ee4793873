import itertools
import json
from datetime import date, datetime, timezone

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow import dims, schemas
from grantflow.operators import (
    canonical,
    diff,
    events,
    freshness,
    lookup,
    metrics,
    monitors,
    purge,
    router,
    sheet,
    trust,
    upsert,
    validate,
)
from grantflow.records import RecordSpec, registry_spec, sheet_spec

CROCKFORD = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"


def revision(millis, tail="0123456789ABCDEF"):
    """A revision id made at ``millis``."""
    return "".join(CROCKFORD[millis >> 5 * k & 31] for k in range(9, -1, -1)) + tail


MADE, LATER = 1_707_000_123_456, 1_707_000_999_999
# A harbour's call for repairs: every list has more than one entry, texts that don't matter are left out.
GOOD = {
    "grant_id": "770013", "revision": revision(MADE), "is_forecast": False, "Version": "3", "Bill": "Harbour Act",
    "OpportunityID": "770013", "OpportunityNumber": "HRB-24-007", "OpportunityTitle": "Quay walls",
    "OpportunityCategory": "M", "Description": "Repair of \"old\" quay walls",
    "PostDate": "02052024", "CloseDate": "04302024", "ArchiveDate": "05302024", "LastUpdatedDate": "02062024",
    "AgencyCode": "HRB", "AgencyName": "Harbour Office", "GrantorContactText": "Ask the harbour master",
    "AwardFloor": "10000", "AwardCeiling": "250000", "EstimatedTotalProgramFunding": "1500000",
    "ExpectedNumberOfAwards": "12", "CostSharingOrMatchingRequirement": "Yes",
    "CategoryOfFundingActivity": ["AG", "EN"], "CFDANumbers": ["66.312", "11.300"],
    "EligibleApplicants": ["02", "12", "25"], "FundingInstrumentType": ["G"],
    "AdditionalInformationURL": "https://harbour.test/call",
}


def item(**changes):
    return {f.name: None for f in schemas.PREPARED.fields} | GOOD | changes


def prepared(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.PREPARED)


def stored(df, path):
    """What a job does between two upserts: write the snapshot and read it back."""
    df.write.parquet(str(path))
    return df.sparkSession.read.schema(df.schema).parquet(str(path))


# --- freshness -------------------------------------------------------------------------------

FRESH = RecordSpec(key="id", attrs=("v",), date_col="day")


def test_freshness_table(spark):
    stored = [("eq", "01022023"), ("gt", "01032023"), ("blank", ""), ("null", None), ("old", "01012023"),
              ("bad", "2023-01-01"), ("baddate", "01012023"), ("both", "x")]
    incoming = [(k, "01022023", 1) for k in ("eq", "gt", "blank", "null", "old", "bad", "new")]
    incoming += [("baddate", "01/02/06", 1), ("both", "x", 1), ("newbad", "", 1)]
    left = spark.createDataFrame(incoming, "id string, day string, v int")
    index = spark.createDataFrame(stored, "id string, day string")
    got = {r.id: (r.outcome, r.reason) for r in freshness.freshness(left, index, FRESH).collect()}
    assert got == {
        "eq": ("skipped", None), "gt": ("skipped", None), "blank": ("created", None), "null": ("created", None),
        "old": ("updated", None), "new": ("created", None), "bad": ("failed", "bad_stored_date"),
        "baddate": ("failed", "bad_date"), "both": ("failed", "bad_date"), "newbad": ("failed", "bad_date"),
    }
    counts = freshness.outcome_counts(freshness.freshness(left, index, FRESH)).collect()
    assert sum(r.records for r in counts) == len(incoming)


def test_freshness_reads_only_key_and_date_of_the_index(spark, tmp_path):
    prepared(spark, item()).write.parquet(str(tmp_path / "p"))
    index = spark.read.parquet(str(tmp_path / "p"))
    incoming = spark.createDataFrame([("1", "01022023")], "grant_id string, LastUpdatedDate string")
    plan = freshness.freshness(incoming, index, registry_spec())._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<grant_id:string,LastUpdatedDate:string>" in plan


# --- upsert ----------------------------------------------------------------------------------

def test_any_changed_needs_attributes():
    with pytest.raises(ValueError):
        upsert.any_changed([])


def test_upsert_is_idempotent_and_writes_only_changes(spark, tmp_path):
    spec = registry_spec()
    prev = prepared(spark, item(grant_id="1"), item(grant_id="2"), item(grant_id="9"))
    batch = [item(grant_id="1"), item(grant_id="2", AgencyName="Other"), item(grant_id="3")]
    incoming = prepared(spark, *batch).drop("revision", "Bill")
    out = stored(upsert.upsert_changed(prev, incoming, spec, F.lit(1_700_000_000_000)), tmp_path / "a")
    rows = {r.grant_id: r for r in out.collect()}
    assert {k: r.changed for k, r in rows.items()} == {"1": False, "2": True, "3": True, "9": False}
    assert rows["1"].revision == rows["9"].revision == GOOD["revision"]
    assert rows["2"].revision[:10] == rows["3"].revision[:10] != GOOD["revision"][:10]
    assert (rows["2"].Bill, rows["3"].Bill, rows["2"].AgencyName) == ("Harbour Act", None, "Other")
    again = stored(
        upsert.upsert_changed(out.drop("changed"), incoming, spec, F.lit(1_800_000_000_000)), tmp_path / "b")
    assert again.where("changed").count() == 0
    assert sorted(again.drop("changed").collect(), key=str) == sorted(out.drop("changed").collect(), key=str)


def test_upsert_forecast_then_synopsis_keeps_forecast_fields(spark, tmp_path):
    spec = registry_spec()
    forecast = item(is_forecast=True, FiscalYear="2016", CloseDate=None, CloseDateExplanation=None, GrantorContactText=None)
    synopsis = item(is_forecast=False, FiscalYear=None)
    drop = ("revision", "Bill")
    one = upsert.upsert_changed(prepared(spark), prepared(spark, forecast).drop(*drop), spec, F.lit(1)).drop("changed")
    one = stored(one, tmp_path / "one")
    two = upsert.upsert_changed(one, prepared(spark, synopsis).drop(*drop), spec, F.lit(2)).first()
    assert (two.is_forecast, two.FiscalYear, two.CloseDate, two.changed) == (False, "2016", "04302024", True)
    back = upsert.upsert_changed(
        spark.createDataFrame([two], T.StructType([*schemas.PREPARED.fields, T.StructField("changed", T.BooleanType())])).drop("changed"),
        prepared(spark, forecast).drop(*drop), spec, F.lit(3)).first()
    assert (back.is_forecast, back.FiscalYear, back.CloseDate) == (True, "2016", "04302024")


def test_blank_replaces_value_and_counts_as_change_against_absent(spark):
    spec = RecordSpec(key="k", attrs=("a",))
    prev = spark.createDataFrame([("1", "x", "r"), ("2", None, "r"), ("3", "", "r")], "k string, a string, revision string")
    inc = spark.createDataFrame([("1", ""), ("2", ""), ("3", "")], "k string, a string")
    rows = {r.k: (r.a, r.changed) for r in upsert.upsert_changed(prev, inc, spec).collect()}
    assert rows == {"1": ("", True), "2": ("", True), "3": ("", False)}


def test_order_of_the_two_sources_does_not_matter(spark, tmp_path):
    registry = prepared(spark, item(grant_id="1")).drop("revision", "Bill")
    bills = spark.createDataFrame([("1", "New Act"), ("2", "Other Act")], "grant_id string, Bill string")
    empty = prepared(spark)

    def run(name, *steps):
        table = empty
        for i, (spec, df) in enumerate(steps):
            table = upsert.upsert_changed(table, df, spec, F.lit(5)).drop("changed")
            table = stored(table, tmp_path / f"{name}{i}")
        return sorted(table.drop("revision").collect(), key=str)
    a, b = (registry_spec(), registry), (sheet_spec(), bills)
    assert run("x", a, b) == run("y", b, a)


def test_small_batch_is_broadcast_against_the_snapshot(spark, tmp_path):
    prepared(spark, *[item(grant_id=str(i)) for i in range(50)]).write.parquet(str(tmp_path / "p"))
    prev = spark.read.parquet(str(tmp_path / "p"))
    bills = spark.createDataFrame([("1", "New Act")], "grant_id string, Bill string")
    plan = upsert.upsert_changed(prev, bills.coalesce(1), sheet_spec(), F.lit(5))._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan


# --- snapshot diff ---------------------------------------------------------------------------

def test_diff(spark):
    old = prepared(spark, item(grant_id="1"), item(grant_id="2"), item(grant_id="3", revision=None), item(grant_id="4", revision=None))
    new = prepared(spark, item(grant_id="1"), item(grant_id="2", revision=revision(LATER)), item(grant_id="3"),
                   item(grant_id="5"))
    rows = {r.grant_id: r for r in diff.diff_snapshots(old, new, "grant_id", "revision").collect()}
    assert {k: r.op for k, r in rows.items()} == {"2": "MODIFY", "3": "MODIFY", "4": "REMOVE", "5": "INSERT"}
    assert rows["5"].old is None and rows["4"].new is None and rows["2"].old.grant_id == "2"
    assert diff.diff_snapshots(old, old, "grant_id", "revision").count() == 0


# --- canonical, validation, events -----------------------------------------------------------

def grant_of(spark, **changes):
    return canonical.to_canonical(prepared(spark, item(**changes))).select(
        "grant", "malformed", validate.grant_errors(F.col("grant")).alias("errors"),
        canonical.grant_json(F.col("grant")).alias("json")).first()


def test_good_item(spark):
    r = grant_of(spark)
    assert r.malformed == [] and r.errors == []
    doc = json.loads(r.json)
    assert doc["opportunity"] == {
        "id": GOOD["OpportunityID"], "number": GOOD["OpportunityNumber"], "title": GOOD["OpportunityTitle"],
        "description": GOOD["Description"], "category": {"name": "Mandatory", "code": "M"},
        "milestones": {"post_date": "2024-02-05", "close": {"date": "2024-04-30"}, "archive_date": "2024-05-30"},
        "last_updated": "2024-02-06"}
    made = datetime.fromtimestamp(MADE / 1000, timezone.utc)
    assert doc["revision"] == {"id": GOOD["revision"], "timestamp": made.strftime("%Y-%m-%dT%H:%M:%S.456Z")}
    assert doc["award"]["expected_number_of_awards"] == 12
    assert doc["cost_sharing_or_matching_requirement"] is True
    assert [e["code"] for e in doc["eligible_applicants"]] == GOOD["EligibleApplicants"]
    assert all(e["name"] == dims.APPLICANT[e["code"]] for e in doc["eligible_applicants"])
    assert doc["additional_information"] == {"url": GOOD["AdditionalInformationURL"]}
    assert list(doc) == ["funding_instrument_types", "cost_sharing_or_matching_requirement", "cfda_numbers", "bill",
                         "eligible_applicants", "additional_information", "agency", "award", "funding_activity",
                         "grantor", "metadata", "opportunity", "revision"]


def test_empty_item(spark):
    r = canonical.to_canonical(prepared(spark, {f.name: None for f in schemas.PREPARED.fields})).select(
        "malformed", validate.grant_errors(F.col("grant")).alias("errors"),
        canonical.grant_json(F.col("grant")).alias("json")).first()
    assert sorted(r.malformed) == ["CostSharingOrMatchingRequirement", "revision"]
    assert sorted(r.errors) == sorted([
        "invalid_opportunity_category", "missing_post_date", "empty_id", "empty_number", "empty_title",
        "missing_last_updated", "empty_revision"])
    doc = json.loads(r.json)
    assert doc["agency"] == {} and doc["grantor"] == {"email": {}} and "bill" not in doc
    assert doc["opportunity"] == {"category": {}, "milestones": {"close": {}}}
    assert doc["revision"] == {"id": "0" * 26, "timestamp": "1970-01-01T00:00:00Z"}


@pytest.mark.parametrize("changes,malformed,errors", [
    ({"OpportunityID": ""}, [], ["empty_id"]),
    ({"OpportunityNumber": None}, [], ["empty_number"]),
    ({"OpportunityTitle": ""}, [], ["empty_title"]),
    ({"LastUpdatedDate": ""}, [], ["missing_last_updated"]),
    ({"LastUpdatedDate": "2024-02-06"}, ["LastUpdatedDate"], ["missing_last_updated"]),
    ({"PostDate": "99"}, ["PostDate"], ["missing_post_date"]),
    ({"ArchiveDate": "x", "CloseDate": "y"}, ["ArchiveDate", "CloseDate"], []),
    ({"OpportunityCategory": ""}, [], ["invalid_opportunity_category"]),
    ({"OpportunityCategory": "Z"}, ["OpportunityCategory"], ["invalid_opportunity_category"]),
    ({"CategoryOfFundingActivity": []}, [], []),
    ({"CategoryOfFundingActivity": ["ST", "??", "??"]}, ["CategoryOfFundingActivity"] * 2, ["invalid_activity_category"] * 2),
    ({"FundingInstrumentType": ["x"]}, ["FundingInstrumentType"], ["invalid_instrument"]),
    ({"EligibleApplicants": ["03"]}, ["EligibleApplicants"], ["invalid_applicant"]),
    ({"CFDANumbers": ["66.3123", "11.300"]}, ["CFDANumbers"], ["invalid_cfda_number"]),
    ({"CFDANumbers": None}, [], []),
    ({"revision": "nope"}, ["revision"], ["empty_revision"]),
    ({"revision": "0" * 26}, [], ["empty_revision"]),
    ({"ExpectedNumberOfAwards": "-1"}, ["ExpectedNumberOfAwards"], []),
    ({"ExpectedNumberOfAwards": "many"}, ["ExpectedNumberOfAwards"], []),
    ({"CostSharingOrMatchingRequirement": "perhaps"}, ["CostSharingOrMatchingRequirement"], []),
])
def test_fields_and_rules(spark, changes, malformed, errors):
    r = grant_of(spark, **changes)
    assert sorted(r.malformed) == sorted(malformed) and sorted(r.errors) == sorted(errors)


def changes_table(spark, rows):
    image = T.StructType([*schemas.PREPARED.fields, T.StructField("unbuildable", T.BooleanType())])
    schema = T.StructType([
        T.StructField("op", T.StringType()), T.StructField("seq", T.StringType()),
        T.StructField("event_time", T.TimestampType()), T.StructField("old", image), T.StructField("new", image)])
    at = datetime(2024, 1, 1)
    full = lambda i: None if i is None else {"unbuildable": False} | i
    return spark.createDataFrame([(op, seq, at, full(old), full(new)) for op, seq, old, new in rows], schema)


def test_publish(spark):
    empty = {f.name: None for f in schemas.PREPARED.fields}
    rows = [
        ("INSERT", "1", None, item()),
        ("REMOVE", "2", item(), item()),
        ("MODIFY", "3", item(Bill=None), item(revision=revision(LATER))),
        ("INSERT", "4", None, empty),
        ("MODIFY", "5", item(OpportunityTitle=""), item()),
        ("MODIFY", "6", item() | {"unbuildable": True}, item()),
        ("INSERT", "7", None, item() | {"unbuildable": True}),
        ("INSERT", "8", None, None),
        ("MODIFY", "9", item() | {"unbuildable": True}, item(OpportunityID="")),
    ]
    published, rejected = events.publishable(changes_table(spark, rows))
    got = {r.seq: r for r in published.collect()}
    assert {s: r.type for s, r in got.items()} == {"1": "create", "2": "delete", "3": "update", "5": "update"}
    assert {r.seq: r.reason for r in rejected.collect()} == {
        "4": "invalid_new", "6": "unbuildable_old", "7": "unbuildable_new", "8": "no_version", "9": "invalid_new"}
    update = json.loads(got["3"].detail)
    assert update["type"] == "update" and "bill" not in update["versions"]["previous"]
    assert update["versions"]["new"]["bill"] == "Harbour Act"
    assert update["versions"]["previous"]["revision"]["id"] != update["versions"]["new"]["revision"]["id"]
    create, delete = json.loads(got["1"].detail), json.loads(got["2"].detail)
    assert create["versions"]["previous"] is None and delete["versions"]["new"] is None
    assert got["1"].event_time == datetime(2024, 1, 1) and got["1"].detail_type == "GrantModificationEvent"


def test_event_errors(spark):
    df = canonical.to_canonical(prepared(spark, item(OpportunityID="")))
    g, none = F.col("grant"), F.lit(None).cast(df.schema["grant"].dataType)
    r = df.select(validate.event_errors(F.lit("create"), none, g).alias("a"),
                  validate.event_errors(F.lit("x"), g, g).alias("b"),
                  validate.event_errors(F.lit(None).cast("string"), none, none).alias("c")).first()
    assert (r.a, r.b, r.c) == (["empty_id"], ["empty_id", "empty_id", "unknown_type"], ["unknown_type"])


def test_facets(spark):
    df = prepared(spark, item(), item(OpportunityTitle=" x", OpportunityNumber="n" * 41, EligibleApplicants=["abc"],
                                      AwardCeiling="none", AwardFloor="none", PostDate="13012020"))
    rows = df.select(validate.facet_errors(F.col, validate.REGISTRY_FACETS, schemas.LIST_FIELDS).alias("f")).collect()
    assert rows[0].f == []
    assert rows[1].f == ["OpportunityTitle", "OpportunityNumber", "EligibleApplicants", "PostDate", "AwardFloor"]


def test_prefix_until_failure(spark):
    df = spark.createDataFrame(
        [("a", 1, False), ("a", 2, True), ("a", 3, False), ("a", 4, True), ("b", 1, False)], "b string, s int, bad boolean")
    got = sorted((r.b, r.s, r.disposition) for r in events.prefix_until_failure(df, "b", "s", F.col("bad")).collect())
    assert got == [("a", 1, "published"), ("a", 2, "failed"), ("a", 3, "retry"), ("a", 4, "retry"), ("b", 1, "published")]


# --- lookups ---------------------------------------------------------------------------------

def test_code_and_name_lookups(one):
    got = one(lambda c: lookup.code_to_struct(c, dims.INSTRUMENT), ["CA", "zz", ""])
    assert [tuple(g) for g in got] == [("Cooperative Agreement", "CA"), ("", "zz"), ("", "")]
    got = one(lambda c: lookup.name_to_struct(c, dims.CATEGORY), ["Mandatory", "zz"])
    assert [tuple(g) for g in got] == [("Mandatory", "M"), ("zz", "")]


# --- sheet -----------------------------------------------------------------------------------

def test_short_rows_and_kinds(spark):
    rows = [("f", 0, ["CFDA"], None, None), ("f", 1, ["10.1"], "https://grants.gov/search-results-detail/1", None),
            ("f", 2, [], None, None), ("f", 3, ["10.1", "t", "a", "", "", "n"], "https://grants.gov/search-results-detail/5", None),
            ("f", 4, ["10.1", "t", "a", "3", "", "n"], None, None)]
    good, errors = sheet.parse_sheet(spark.createDataFrame(rows, schemas.CELLS))
    assert [(r.grant_id, r.bill, r.due_date, r.match) for r in good.collect()] == [(5, "", None, False)]
    assert [(r.row_idx, r.target) for r in errors.collect()] == [(3, "EstimatedFunding")]


# --- mail trust, routes, purge ---------------------------------------------------------------

def spellings(name, domain):
    """An address and other ways to write it: case, dots in the name, a suffix after a plus, blanks around."""
    for upper, dot, plus, blank in itertools.product((False, True), repeat=4):
        text = (name[:2] + "." + name[2:] if dot else name) + ("+spring.2024" if plus else "") + "@" + domain
        text = text.upper() if upper else text
        yield f" {text} " if blank else text


def test_allow_list(spark):
    # by the rule: an address matches an entry of the same name and domain, or of its very domain
    entries = {
        "its domain": (["harbour.test"], True), "its address": (list(spellings("kimlee", "harbour.test"))[5:6], True),
        "one of many": (["quay.test", "Harbour.Test "], True), "another name": (["kimlees@harbour.test"], False),
        "a parent domain": (["test"], False), "a domain below": (["old.harbour.test"], False),
        "name elsewhere": (["kimlee@quay.test", "quay.test"], False),
    }
    senders = list(spellings("kimlee", "harbour.test"))
    mails = spark.createDataFrame([(s,) for s in senders], "sender string")
    for case, (allow, expected) in entries.items():
        row = spark.range(1).select(*[trust.allowed(F.lit(s), allow).alias(f"c{i}") for i, s in enumerate(senders)]).first()
        assert set(row) == {expected}, case
        table = spark.createDataFrame([(e,) for e in allow], "entry string")
        assert trust.allowed_senders(mails, table).count() == (len(senders) if expected else 0), case


def test_routes(one):
    got = one(router.route, [
        "sources/2023/04/22/grants.gov/archive.zip", "sources/2023/04/22/grants.gov/extract.xml",
        "sources/2023/04/22/ffis.org/raw.eml", "sources/2023/04/22/ffis.org/download.xlsx",
        "tmp/sources/x/grants.gov/extract.xml", "123/1234/grants.gov/v2.xml",
        "123/1234/grants.gov/v2.OpportunityForecastDetail_1_0.xml", "123/1234/ffis.org/v1.json", "other"])
    assert got == ["extract_registry", "split_registry", "enqueue_sheet_download", "split_sheet", None,
                   "persist_registry", "persist_registry", "persist_sheet", None]


def test_purge_items(spark):
    df = prepared(spark, item())
    r = purge.purge_items(df).first()
    assert (r.revision, r.Bill, r.AgencyName) == (None, "Harbour Act", "Harbour Office")
    r = purge.purge_items(df, sheet=True, keep_revision=True).first()
    assert (r.revision, r.Bill, r.AgencyName) == (GOOD["revision"], None, "Harbour Office")
    r = purge.purge_items(df, registry=True).first()
    assert (r.grant_id, r.Bill, r.AgencyName, r.is_forecast) == ("770013", "Harbour Act", None, None)
    assert purge.purge_items(df, everything=True).count() == 0
    assert purge.purge_items(df, sheet=True, dry_run=True).first().items == 1
    assert purge.purge_items(df, sheet=True).schema == df.schema


def test_purge_matchers_need_one():
    with pytest.raises(ValueError):
        purge.purge_matchers()


# --- metrics and monitors --------------------------------------------------------------------

def samples(spark, rows):
    return spark.createDataFrame(
        [(datetime.fromisoformat(t), step, metric, float(v), tags) for t, step, metric, v, tags in rows], schemas.METRIC_SAMPLE)


def test_rollup_and_formula(spark):
    df = samples(spark, [
        ("2024-01-01 00:10:00", "split", "record.failed", 2, {}), ("2024-01-01 00:50:00", "split", "record.created", 5, {}),
        ("2024-01-01 01:10:00", "split", "opportunity.created", 1, {}), ("2024-01-01 01:20:00", "split", "record.created", 4, {})])
    out = metrics.formula(
        df, "1 hour", {"step": F.col("step")},
        {"made": metrics.metric_sum("record.created", "opportunity.created"), "bad": metrics.metric_sum("record.failed")},
        {"net": F.col("made") - F.col("bad")})
    assert [(r.bucket.hour, r.net) for r in out.orderBy("bucket").collect()] == [(0, 3.0), (1, 5.0)]
    tagged = samples(spark, [("2024-01-01 00:10:00", "p", "event.published", 1, {"type": "create"}),
                             ("2024-01-01 00:20:00", "p", "event.published", 2, {"type": "update"})])
    by = metrics.rollup(tagged, "1 hour", {"type": metrics.tag("type")}, {"n": F.sum("value")})
    assert sorted((r.type, r.n) for r in by.collect()) == [("create", 1.0), ("update", 2.0)]


def test_alerts(spark):
    now = F.lit("2024-01-02 00:15:00").cast("timestamp")
    df = samples(spark, [
        ("2024-01-01 15:00:00", "a", "errors", 2, {}), ("2024-01-01 15:00:00", "a", "invocations", 2, {}),
        ("2024-01-01 13:00:00", "a", "invocations", 9, {}),  # before the window
        ("2024-01-02 00:05:00", "a", "invocations", 9, {}),  # inside the evaluation delay
        ("2024-01-01 23:30:00", "b", "errors", 1, {}), ("2024-01-01 23:30:00", "b", "invocations", 2, {}),
        ("2024-01-01 23:30:00", "c", "errors", 0, {}), ("2024-01-01 23:30:00", "d", "invocations", 0, {})])
    of = lambda name: F.when(F.col("metric") == name, F.col("value"))
    ratio = {r.step: (r.ratio, r.alert) for r in monitors.alert_ratio(df, now, of("errors"), of("invocations")).collect()}
    assert ratio == {"a": (1.0, True), "b": (0.5, False), "c": (None, False), "d": (None, False)}
    total = {r.step: r.alert for r in monitors.alert_sum(df, now, F.coalesce(of("errors"), F.lit(0.0))).collect()}
    assert total == {"b": True, "c": False, "d": False}
    steps = spark.createDataFrame([("a",), ("b",), ("z",)], "step string")
    stale = {r.step: r.alert for r in monitors.alert_stale(df, steps, now, F.coalesce(of("errors"), F.lit(0.0))).collect()}
    assert stale == {"a": False, "b": False, "z": True}
    depth = samples(spark, [("2024-01-01 00:00:10", "q", "depth", 0, {}), ("2024-01-01 00:00:40", "q", "depth", 2, {}),
                            ("2024-01-01 00:30:00", "q", "depth", 3, {}), ("2024-01-01 01:00:00", "q", "depth", 0, {})])
    hours = {r.hour.hour: (r.depth, r.alert) for r in monitors.alert_depth(depth, F.col("value")).collect()}
    assert hours == {0: (1.0, True), 1: (0.0, False)}


def test_metric_names_are_unique_per_step():
    for names in metrics.METRICS.values():
        assert len(names) == len(set(names))
    assert sum(map(len, metrics.METRICS.values())) == 24


def test_dates_kept_as_given(spark):
    from grantflow.functions.keys import landing_key
    df = spark.createDataFrame([(date(2023, 4, 22),)], "d date")
    assert df.select(landing_key(F.col("d"), F.lit("ffis.org"), F.lit("raw.eml")).alias("k")).first().k == \
        "sources/2023/04/22/ffis.org/raw.eml"
