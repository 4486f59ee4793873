import io
import json
import zipfile
from datetime import date

from pyspark.sql import functions as F

from grantflow import schemas
from grantflow.operators.sheet import file_errors, parse_sheet
from grantflow.plans.maintain import backfill_manifest
from grantflow.sources import archives, items, landing, registry_xml, sheet_json, workbooks
from xlsx import workbook


def synopsis(i, day="01022023", extra=""):
    return (
        f"<OpportunitySynopsisDetail_1_0>\n <OpportunityID>{i}</OpportunityID>\n"
        f" <OpportunityTitle> A &amp; B &lt;br/&gt; </OpportunityTitle><AgencyCode></AgencyCode>\n"
        f" <EligibleApplicants>25</EligibleApplicants><EligibleApplicants>99</EligibleApplicants>\n"
        f" <LastUpdatedDate>{day}</LastUpdatedDate>{extra}\n</OpportunitySynopsisDetail_1_0>\n"
    )


def forecast(i, day="01022023"):
    return (
        f"<OpportunityForecastDetail_1_0><OpportunityID>{i}</OpportunityID><FiscalYear>2016</FiscalYear>"
        f"<LastUpdatedDate>{day}</LastUpdatedDate></OpportunityForecastDetail_1_0>\n"
    )


def document(*records):
    return '<?xml version="1.0"?>\n<Grants xmlns="urn:x">\n' + "".join(records) + "</Grants>\n"


def test_registry_records(spark, tmp_path):
    (tmp_path / "extract.xml").write_text(document(synopsis(1001), synopsis(1002), forecast(1003)))
    good, rejects = registry_xml.read_registry(spark, str(tmp_path))
    rows = good.orderBy("ord").collect()
    assert [r.grant_id for r in rows] == ["1001", "1002"]
    first = rows[0]
    assert first.OpportunityTitle == " A & B <br/> "
    assert first.EligibleApplicants == ["25", "99"] and first.CFDANumbers is None
    assert (first.AgencyCode, first.AgencyName, first.CloseDate, first.FiscalYear) == ("", "", "", None)
    assert rejects.count() == 0

    both, _ = registry_xml.read_registry(spark, str(tmp_path), forecasts=True)
    f = both.where("is_forecast").collect()
    assert len(f) == 1 and (f[0].FiscalYear, f[0].CloseDate, f[0].AgencyName) == ("2016", None, "")
    rowtag = registry_xml.read_registry_rowtag(spark, str(tmp_path)).collect()
    assert sorted(r.grant_id for r in rowtag) == ["1001", "1002", "1003"]


def test_registry_rejects_keep_the_rest(spark, tmp_path):
    cut = "<OpportunitySynopsisDetail_1_0><OpportunityID>1009</OpportunityID><Op"
    (tmp_path / "a.xml").write_text('<?xml version="1.0"?><Grants>' + synopsis(1008) + cut)
    (tmp_path / "b.xml").write_text(document(
        synopsis(1, extra="<Bad>"), synopsis(2), "<OpportunitySynopsisDetail_1_0><OpportunityID>3</OpportunityID>",
        synopsis(4)))
    (tmp_path / "c.xml").write_text("<invalidtoken")
    good, rejects = registry_xml.read_registry(spark, str(tmp_path))
    assert sorted(r.grant_id for r in good.collect()) == ["1008", "2", "4"]
    reasons = sorted((r.file[-5:], r.reason) for r in rejects.collect())
    assert reasons == [("a.xml", "unclosed"), ("b.xml", "unclosed"), ("b.xml", "undecodable"), ("c.xml", "unclosed")] \
        or reasons == [("a.xml", "unclosed"), ("b.xml", "undecodable"), ("b.xml", "unclosed"), ("c.xml", "unclosed")]


def test_comments_and_delimiters_in_text(spark, tmp_path):
    """A record in a comment is none, and a record that holds the delimiter in text or CDATA is one."""
    good = "<AgencyName>{}</AgencyName>"
    docs = {
        "a": document(f"<!-- {synopsis(1)} -->", synopsis(2), "<!-- x -->", synopsis(3), f"<!-- {synopsis(4)}{synopsis(5)} -->"),
        "b": document(synopsis(11, extra=good.format("p_1_0>q")), synopsis(12, extra=good.format("<![CDATA[<!-- a_1_0> ]] >]]>")),
                      synopsis(13, extra=good.format("<!-- <![CDATA[ -->t<!-- a_1_0> -->"))),
        "c": "<?xml version='1.0'?>" + document(synopsis(21), "<?pi a_1_0> <!-- ?>", synopsis(22)) + "<!-- tail _1_0> never closed",
        "d": document(synopsis(31)) + synopsis(32).replace("</OpportunityID>", "_1_0></OpportunityID>")[:-30],
        "e": document(),
    }
    for name, text in docs.items():
        (tmp_path / f"{name}.xml").write_text(text)
    records, rejects = registry_xml.read_registry(spark, str(tmp_path))
    got = {r.grant_id: r.AgencyName for r in records.collect()}
    assert sorted(got) == ["11", "12", "13", "2", "21", "22", "3", "31"]
    assert (got["11"], got["12"], got["13"]) == ("p_1_0>q", "<!-- a_1_0> ]] >", "t")
    assert sorted((r.file[-5:], r.reason) for r in rejects.collect()) == [("c.xml", "unclosed"), ("d.xml", "unclosed")]
    # however the file is cut into input splits
    text = docs["a"] + docs["b"] + docs["c"]
    pieces = text.split(registry_xml.DELIMITER)
    for width in (1, 2, 5):
        rows = [("f", i // width * 1_000, i, c) for i, c in enumerate(pieces)]
        chunks = spark.createDataFrame(rows, "file string, split long, ord long, chunk string").repartition(3)
        again = {r.grant_id for r in registry_xml.parse_chunks(chunks)[0].collect()}
        assert again == {"11", "12", "13", "2", "21", "22", "3"}


def test_registry_splits_one_file(spark, tmp_path):
    n = 3000
    (tmp_path / "extract.xml").write_text(document(*[synopsis(10000 + i) for i in range(n)]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    spark.conf.set("spark.sql.files.openCostInBytes", "1024")
    try:
        chunks = registry_xml.read_chunks(spark, str(tmp_path))
        assert chunks.select("split").distinct().count() > 5
        good, rejects = registry_xml.parse_chunks(chunks)
        ids = [r.grant_id for r in good.orderBy("file", "split", "ord").collect()]
        assert ids == [str(10000 + i) for i in range(n)] and rejects.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_registry_parses_each_record_once(spark, tmp_path):
    (tmp_path / "extract.xml").write_text(document(synopsis(1)))
    good, _ = registry_xml.read_registry(spark, str(tmp_path))
    assert good._jdf.queryExecution().optimizedPlan().toString().count("from_xml(") == 1


def test_decode_records(spark):
    docs = [synopsis(7), forecast(8), "", document(forecast(9), synopsis(10)), "<OpportunitySynopsisDetail_1_0><a>",
            "<OpportunitySynopsisDetail_1_0><a></OpportunitySynopsisDetail_1_0>"]
    df = spark.createDataFrame(list(enumerate(docs)), "n int, doc string")
    rows = registry_xml.decode_records(df, "doc").orderBy("n").collect()
    assert [(r.status, r.grant_id, r.is_forecast) for r in rows] == [
        ("ok", "7", False), ("ok", "8", True), ("no_record", "", None), ("ok", "9", True),
        ("undecodable", "", False), ("undecodable", "", False)]


def test_xml_round_trip(spark, tmp_path):
    (tmp_path / "extract.xml").write_text(document(synopsis(1001), forecast(1003)))
    good, _ = registry_xml.read_registry(spark, str(tmp_path), forecasts=True)
    again = registry_xml.decode_records(registry_xml.to_xml_text(good).select("grant_id", "xml")
                                        .withColumnRenamed("grant_id", "was"), "xml")
    fields = schemas.REGISTRY_FIELDS
    assert sorted(good.select(fields).collect(), key=str) == sorted(again.select(fields).collect(), key=str)
    assert again.where("status = 'ok' AND was = grant_id").count() == 2


def _zip(entries):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for name, text in entries:
            z.writestr(name, text)
    return out.getvalue()


def test_archives(spark, tmp_path):
    many = document(*[synopsis(20000 + i) for i in range(5000)])
    files = {
        "ok.zip": _zip([("GrantsDBExtract.xml", many)]),
        "extra.zip": _zip([("a.xml", document(synopsis(1))), ("b.txt", "x")]),
        "text.zip": _zip([("a.txt", "x")]),
        "none.zip": _zip([]),
        "junk.zip": b"this is no archive",
    }
    broken = bytearray(_zip([("a.xml", document(synopsis(1)) * 50)]))
    broken[60] ^= 0xFF
    files["broken.zip"] = bytes(broken)
    for name, content in files.items():
        (tmp_path / name).write_bytes(content)
    out = archives.unpack_archives(spark, str(tmp_path)).cache()
    status = {r.path.rsplit("/", 1)[1]: r.status for r in out.select("path", "status").distinct().collect()}
    assert status == {"ok.zip": "ok", "extra.zip": "extra_entry", "text.zip": "not_xml", "none.zip": "empty",
                      "junk.zip": "invalid", "broken.zip": "invalid"}
    good, rejects = registry_xml.parse_chunks(archives.archive_chunks(out))
    ids = [r.grant_id for r in good.orderBy("ord").collect()]
    assert ids == [str(20000 + i) for i in range(5000)] and rejects.count() == 0


HEADER = ["CFDA", "Title", "Agency", "Funding", "Awards", "Number", "S", "L", "T", "H", "N", "O", "Due", "Match"]


def _row(cfda, n, funding=1250000, due="5/11/23", marks=("N", "", "Invalid", "x", "X", None), match="N"):
    return [cfda, f"Call {n}", "Harbour Office", funding, "N/A", f"HRB-{n}", *marks, due, match]


def test_workbook_to_rows(spark, tmp_path):
    rows = [
        ["Update"], [None] * 13 + ["February 5, 2024"], ["Ignored before header"],
        HEADER, ["Harbour Act"], _row("66.312", 1), [], ["Light and Water Act"],
        _row("11.3+", 2, "N/A", ("date", 45057)), _row("7.45", 3, "5,000", "someday"), HEADER,
        _row("66.814", 4), _row("66.", 5), ["Farms & Fish"], _row("11.020", 6),
    ]
    links = {
        6: "https://www.grants.gov/view-opportunity.html?oppId=31337",
        9: "https://www.grants.gov/search-results-detail/40071",
        10: "https://grants.gov/search-results-detail/990001",
        12: "https://not.grants.gov/search-results-detail/9", 15: "https://grants.gov/search-results-detail/77",
    }
    (tmp_path / "a.xlsx").write_bytes(workbook(rows, links))
    (tmp_path / "b.xlsx").write_bytes(b"foobar")
    (tmp_path / "c.xlsx").write_bytes(workbook([["x"]], sheet="Other"))
    cells = workbooks.read_sheet_cells(spark, str(tmp_path)).cache()
    good, errors = parse_sheet(cells)
    got = good.orderBy("row_idx").collect()
    assert [(r.grant_id, r.cfda, r.bill) for r in got] == [
        (31337, "66.312", "Harbour Act"),
        (40071, "11.300", "Light and Water Act"), (990001, "07.450", "Light and Water Act"),
        (77, "11.020", "Farms & Fish")]
    first = got[0]
    assert first.estimated_funding == 1250000 and first.due_date == date(2023, 5, 11) and first.match is False
    assert first.eligibility.asDict() == {"higher_education": False, "local": False, "non_profits": True,
                                          "other": False, "state": False, "tribal": False}
    assert (first.expected_awards, first.opportunity_number, first.opportunity_agency) == ("N/A", "HRB-1", "Harbour Office")
    assert got[1].estimated_funding == 0 and got[1].due_date == date(2023, 5, 11)
    assert got[2].estimated_funding == 0 and got[2].due_date is None
    found = sorted((r.row_idx, r.target) for r in errors.collect())
    assert found == [(9, "DueDate"), (9, "EstimatedFunding"), (11, "GrantID")]
    assert sorted(r.file[-6:] for r in file_errors(cells).collect()) == ["b.xlsx", "c.xlsx"]

    manifest, bad = backfill_manifest(cells)
    assert [r.dest_key for r in manifest.collect()] == ["sources/2024/02/05/ffis.org/download.xlsx"]
    assert {r.reason for r in bad.collect()} == {"unreadable_workbook"}


def test_backfill_oldest_first(spark):
    row = lambda f, text: (f, 1, [""] * 13 + [text], None, None)
    cells = spark.createDataFrame(
        [row("b", "May 2, 2023"), row("a", "May 12, 2022"), row("c", "2023-05-02"), ("d", 0, ["x"], None, None)],
        schemas.CELLS)
    manifest, bad = backfill_manifest(cells)
    assert [r.source_path for r in manifest.collect()] == ["a", "b"]
    assert sorted((r.file, r.reason) for r in bad.collect()) == [("c", "publish_date"), ("d", "publish_date")]


def test_sheet_json(spark, tmp_path):
    docs = {
        "ok": '{"bill":"HR 1234","grant_id":123}', "extra": '{\n"bill":"HR 1","grant_id":1234,"other":[1]}',
        "cut": '{"bill":"HR', "nobill": '{"grant_id":5}', "noid": '{"bill":"x"}', "null": "null",
    }
    for name, text in docs.items():
        (tmp_path / f"{name}.json").write_text(text)
    good, rejects = sheet_json.read_sheet_json(spark, str(tmp_path))
    assert sorted((r.grant_id, r.bill) for r in good.collect()) == [(123, "HR 1234"), (1234, "HR 1")]
    reasons = {r.file.rsplit("/", 1)[1]: r.reason for r in rejects.collect()}
    assert reasons == {"cut.json": "undecodable", "nobill.json": "missing_bill", "noid.json": "missing_grant_id",
                       "null.json": "undecodable"}


def test_sheet_json_round_trip(spark, tmp_path):
    rows = [("a", 1, ["66.312", "T", "Ag", "5", "N/A", "N", "X"] + [""] * 5 + ["5/11/23", "X"],
             "https://grants.gov/search-results-detail/77", None),
            ("a", 0, ["CFDA"], None, None)]
    good, _ = parse_sheet(spark.createDataFrame(rows, schemas.CELLS))
    text = sheet_json.to_sheet_json(good).first().json
    assert json.loads(text)["due_date"] == "2023-05-11T00:00:00Z"
    out = sheet_json.decode_sheet_json(spark.createDataFrame([(text,)], "doc string"), "doc").first()
    assert out.rec.grant_id == 77 and out.rec.eligibility.state is True and out.reason == "missing_bill"


def test_snapshots(spark, tmp_path):
    root = str(tmp_path / "prepared")
    assert items.read_snapshot(spark, root) is None
    row = {f.name: None for f in schemas.PREPARED.fields} | {"grant_id": "12345", "Bill": "a"}
    df = spark.createDataFrame([row], schemas.PREPARED)
    items.write_snapshot(df, root, 1)
    items.write_snapshot(df.withColumn("Bill", F.lit("b")), root, 2)
    assert items.commits(spark, root) == [1, 2]
    assert items.read_snapshot(spark, root).first().Bill == "b"
    assert items.read_snapshot(spark, root, 1).first().Bill == "a"
    assert items.read_snapshot(spark, root).where("id_prefix = '123'").count() == 1


def test_listing_and_landing(spark, tmp_path):
    df = spark.createDataFrame([("12345", "2023-04-22", "x"), ("67890", "2023-04-23", "y")], "id string, d string, v string")
    landing.write_landing(df, F.col("d"), F.lit("ffis.org"), str(tmp_path / "landing"))
    back = spark.read.parquet(str(tmp_path / "landing"))
    assert back.where("dt = DATE'2023-04-22' AND source = 'ffis.org'").count() == 1
    landing.write_prepared(df, "id", F.lit("grants.gov"), str(tmp_path / "prepared"))
    assert spark.read.parquet(str(tmp_path / "prepared")).where("id_prefix = 123").count() == 1
    listed = items.list_objects(spark, str(tmp_path / "prepared"))
    assert listed.where("path LIKE '%id_prefix=123/source=grants.gov%parquet'").count() == 1
    assert "content" not in listed.columns


def test_typed_item(spark):
    doc = {"grant_id": {"S": "1"}, "Bill": {"NULL": True}, "AgencyName": {"B": "asdf"}, "CFDANumbers": {"L": [{"S": "10.1"}]},
           "is_forecast": {"BOOL": False}, "EligibleApplicants": {"NULL": True}}
    wrong = {"CFDANumbers": {"S": "x"}}
    df = spark.createDataFrame([(json.dumps(doc),), (json.dumps(wrong),)], "j string")
    a, b = [r.i for r in df.select(items.item_struct(items.decode_item(F.col("j"))).alias("i")).collect()]
    assert (a.grant_id, a.Bill, a.AgencyName, a.CFDANumbers, a.is_forecast, a.EligibleApplicants, a.unbuildable) == (
        "1", None, "asdf", ["10.1"], False, None, False)
    assert b.unbuildable is True


def test_objects_without_rows(spark, tmp_path):
    (tmp_path / "a.xml").write_text(document(synopsis(1)))
    (tmp_path / "b.xml").write_text("")
    (tmp_path / "c.xml").write_text(document())
    inventory = spark.createDataFrame([(f"file:{tmp_path}/{n}.xml",) for n in "abc"], "file string")
    good, _ = registry_xml.read_registry(spark, str(tmp_path))
    lost = items.objects_without_rows(inventory, good, "file")
    assert sorted(r.file[-5:] for r in lost.collect()) == ["b.xml", "c.xml"]


def test_quarantine_retention(spark, tmp_path):
    df = spark.createDataFrame([("k", "1", "bad", "{}")], "key string, seq string, reason string, payload string")
    landing.write_quarantine(df, "r1", "split", str(tmp_path / "q"))
    q = spark.read.parquet(str(tmp_path / "q"))
    assert landing.retained(q, F.current_timestamp()).count() == 1
    assert landing.retained(q, F.current_timestamp() + F.expr("INTERVAL 15 DAYS")).count() == 0


def test_stitching_reads_its_chunks_few_times(spark):
    from pyspark.sql import functions as F

    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(chunk):
        read.add(1)
        return chunk

    tag = "OpportunitySynopsisDetail"
    pieces = [f"<{tag}_1_0>", *[f"<OpportunityID>{i}</OpportunityID></{tag}_1_0>\n<{tag}_1_0>" for i in range(20)]]
    chunks = spark.createDataFrame(
        [("f", i // 7, i, c) for i, c in enumerate("".join(pieces).split("_1_0>"))],
        "file string, split int, ord int, chunk string").repartition(2)
    rows = chunks.count()
    chunks = chunks.withColumn("chunk", counted("chunk"))
    registry_xml.stitched(chunks).collect()
    assert 0 < read.value <= 3 * rows  # for the functions, for the pieces to be joined, for all the others


def test_xml_documents_of_a_compact_table_are_dealt_out(spark, tmp_path):
    from datetime import date

    from pyspark.sql import functions as F

    from grantflow.queries.documents import xml_records

    def write(name, rows, schema):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{tmp_path}/{name}.parquet")

    write("nation", [(1, "PERU")], "n_nationkey int, n_name string")
    write("customer", [(7, "C 7", "BUILDING", 1)], "c_custkey long, c_name string, c_mktsegment string, c_nationkey int")
    write("orders", [(i if i % 9 else None, 7, "F", "1-URGENT", date(2024, 1, 2), 10.0 + i) for i in range(200)],
          "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_orderdate date, o_totalprice double")
    out = xml_records(spark, str(tmp_path)).withColumn("part", F.spark_partition_id())
    parts = [r["count"] for r in out.groupBy("part").count().collect()]
    assert sum(parts) == 200 and len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions"))
