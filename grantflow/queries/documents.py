"""Canonical documents, validation, events, and the document formats."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow import schemas
from grantflow.frames import spread, stored, work_folder
from grantflow.functions import ulid
from grantflow.operators import canonical, events, validate
from grantflow.queries.base import joined, query, table
from grantflow.sources import items, registry_xml, sheet_json

# Every order as a stored record. Which fields are good or bad follows from the order's status
# and priority, its customer's segment and nation.
_BASE_SQL = """
WITH o AS (
  SELECT o_orderkey AS orderkey, o_custkey AS custkey, o_orderstatus AS st, o_orderpriority AS pr,
         CAST(o_orderdate AS DATE) AS day, CAST(floor(o_totalprice) AS BIGINT) AS price,
         c_name AS cname, c_mktsegment AS seg, n_name AS nation, n_nationkey AS nk
  FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
e AS (
  SELECT *, list_sort(list_filter([
    CASE WHEN st = 'P' THEN 'invalid_opportunity_category' END,
    CASE WHEN pr = '4-NOT SPECIFIED' THEN 'missing_post_date' END,
    CASE WHEN seg = 'BUILDING' THEN 'empty_title' END,
    CASE WHEN seg = 'MACHINERY' THEN 'missing_last_updated' END,
    CASE WHEN nk = 0 THEN 'empty_revision' END,
    CASE WHEN pr = '1-URGENT' AND st = 'F' THEN 'invalid_cfda_number' END,
    CASE WHEN seg = 'HOUSEHOLD' THEN 'invalid_applicant' END,
    CASE WHEN st = 'F' AND price % 2 = 0 THEN 'invalid_instrument' END], lambda x: x IS NOT NULL)) AS errs
  FROM o)
"""


def _records(spark: SparkSession, folder: str, spread_out: bool = False) -> DataFrame:
    nations = table(spark, folder, "nation").withColumnRenamed("n_nationkey", "c_nationkey")
    people = table(spark, folder, "customer").join(nations, "c_nationkey").select(
        F.col("c_custkey").alias("o_custkey"), "c_name", "c_mktsegment", "n_name", "c_nationkey"
    )
    o = table(spark, folder, "orders").join(people, "o_custkey")
    if spread_out:
        o = spread(o, "o_orderkey", "o_custkey", "o_totalprice")
    st, pr, seg = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("c_mktsegment")
    price = F.floor("o_totalprice").cast("bigint")
    day = F.date_format("o_orderdate", "MMddyyyy")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    texts = {
        "grant_id": F.col("o_orderkey").cast("string"),
        "revision": F.when(F.col("c_nationkey") == 0, "not an id").otherwise(
            ulid.revision_id(millis, F.col("o_orderkey"))
        ),
        "OpportunityID": F.col("o_orderkey").cast("string"),
        "OpportunityTitle": F.when(seg == "BUILDING", "").otherwise(F.col("c_name")),
        "OpportunityNumber": F.concat(F.lit("ON-"), F.col("o_custkey")),
        "OpportunityCategory": F.when(st == "F", "D").when(st == "O", "M").otherwise("Z"),
        "CostSharingOrMatchingRequirement": F.when(pr == "1-URGENT", "Yes").when(pr == "2-HIGH", "NO")
        .when(pr == "3-MEDIUM", "perhaps").otherwise(""),
        "PostDate": F.when(pr == "4-NOT SPECIFIED", "").otherwise(day),
        "LastUpdatedDate": F.when(seg == "MACHINERY", F.date_format("o_orderdate", "yyyy-MM-dd")).otherwise(day),
        "ExpectedNumberOfAwards": F.when(pr == "5-LOW", "-3").otherwise(price.cast("string")),
        "AgencyName": F.concat(F.col("n_name"), F.lit(" <R&D>")),
        "AgencyCode": F.col("c_nationkey").cast("string"),
        "AwardCeiling": price.cast("string"),
        "Version": F.lit("Synopsis 2"),
    }
    lists = {
        "EligibleApplicants": F.when(seg == "HOUSEHOLD", F.array(F.lit("00"), F.lit("XX")))
        .otherwise(F.array(F.lit("25"))),
        "CategoryOfFundingActivity": F.array(F.lit("AG"), F.lit("ENV")),
        "FundingInstrumentType": F.when(st == "F", F.when(price % 2 == 0, F.array(F.lit("G"), F.lit("ZZ")))
                                        .otherwise(F.array(F.lit("CA")))),
        "CFDANumbers": F.when((pr == "1-URGENT") & (st == "F"), F.array(F.lit("1234.567"))).otherwise(F.array(F.lit("10.727"))),
    }

    def column(f) -> Column:
        if f.name == "is_forecast":
            return F.lit(False).alias(f.name)
        c = texts.get(f.name, lists.get(f.name, F.lit(None).cast(f.dataType)))
        return c.alias(f.name)

    return o.select(
        F.col("o_orderkey").alias("orderkey"), pr.alias("pr"),
        *[column(f) for f in schemas.PREPARED.fields],
    )


@query(_BASE_SQL + """
SELECT orderkey, array_to_string(errs, ',') AS errors, len(errs) = 0 AS valid FROM e
""")
def validate_errors(spark, folder):
    docs = canonical.to_canonical(_records(spark, folder))
    errors = validate.grant_errors(F.col("grant"))
    return docs.select("orderkey", joined(errors).alias("errors"), (F.size(errors) == 0).alias("valid"))


@query(_BASE_SQL + """
SELECT field, count(*) AS n FROM (
  SELECT unnest(list_filter([
    CASE WHEN nk = 0 THEN 'revision' END,
    CASE WHEN pr NOT IN ('1-URGENT', '2-HIGH') THEN 'CostSharingOrMatchingRequirement' END,
    CASE WHEN pr = '5-LOW' THEN 'ExpectedNumberOfAwards' END,
    CASE WHEN st = 'P' THEN 'OpportunityCategory' END,
    CASE WHEN seg = 'MACHINERY' THEN 'LastUpdatedDate' END,
    CASE WHEN pr = '1-URGENT' AND st = 'F' THEN 'CFDANumbers' END,
    CASE WHEN seg = 'HOUSEHOLD' THEN 'EligibleApplicants' END,
    CASE WHEN st = 'F' AND price % 2 = 0 THEN 'FundingInstrumentType' END], lambda x: x IS NOT NULL)) AS field
  FROM e) GROUP BY field
""")
def malformed_fields(spark, folder):
    names = _records(spark, folder).select(F.explode(canonical.malformed_fields(F.col)).alias("field"))
    return names.groupBy("field").agg(F.count(F.lit(1)).alias("n"))


@query(_BASE_SQL + """
SELECT orderkey, CAST(orderkey AS VARCHAR) AS id, CASE WHEN seg <> 'BUILDING' THEN cname END AS title,
       CASE st WHEN 'F' THEN 'Discretionary' WHEN 'O' THEN 'Mandatory' ELSE '' END AS category,
       CASE WHEN pr <> '4-NOT SPECIFIED' THEN day END AS post_date,
       CASE WHEN seg <> 'MACHINERY' THEN day END AS last_updated,
       CASE pr WHEN '1-URGENT' THEN true WHEN '2-HIGH' THEN false END AS cost_sharing,
       CASE WHEN pr <> '5-LOW' AND price <> 0 THEN price END AS awards,
       nation || ' <R&D>' AS agency,
       CASE WHEN seg = 'HOUSEHOLD' THEN '00:State governments,XX:'
            ELSE '25:Others (see text field entitled "Additional Information on Eligibility" for clarification)'
       END AS applicants,
       'AG:Agriculture,ENV:Environment' AS activities,
       CASE WHEN st = 'F' AND price % 2 = 0 THEN 'G:Grant,ZZ:' WHEN st = 'F' THEN 'CA:Cooperative Agreement' END
         AS instruments
FROM e
""")
def canonical_grant(spark, folder):
    g = canonical.to_canonical(_records(spark, folder))
    shown = lambda c: F.array_join(
        F.transform(c, lambda e: F.concat_ws(":", e["code"], e["name"])), ","
    )
    return g.select(
        "orderkey", F.col("grant.opportunity.id").alias("id"), F.col("grant.opportunity.title").alias("title"),
        F.col("grant.opportunity.category.name").alias("category"),
        F.col("grant.opportunity.milestones.post_date").alias("post_date"),
        F.col("grant.opportunity.last_updated").alias("last_updated"),
        F.col("grant.cost_sharing_or_matching_requirement").alias("cost_sharing"),
        F.col("grant.award.expected_number_of_awards").alias("awards"),
        F.col("grant.agency.name").alias("agency"),
        shown(F.col("grant.eligible_applicants")).alias("applicants"),
        shown(F.col("grant.funding_activity.categories")).alias("activities"),
        shown(F.col("grant.funding_instrument_types")).alias("instruments"),
    )


def _changes(spark: SparkSession, folder: str) -> DataFrame:
    """Urgent orders are inserted, high ones removed, the others got a bill."""
    r = _records(spark, folder)
    names = [f.name for f in schemas.PREPARED.fields]
    op = F.when(F.col("pr") == "1-URGENT", "INSERT").when(F.col("pr") == "2-HIGH", "REMOVE").otherwise("MODIFY")
    new = F.struct(*[F.lit("Some Act").alias(n) if n == "Bill" else F.col(n) for n in names])
    return r.select(
        "orderkey", op.alias("op"), F.struct(*names).alias("old"), new.alias("new"),
        F.col("revision").alias("seq"), F.lit("2024-01-01 00:00:00").cast("timestamp").alias("event_time"),
    )


@query(_BASE_SQL + """
SELECT CASE WHEN pr = '2-HIGH' THEN 'delete' WHEN len(errs) > 0 THEN 'invalid_new'
            WHEN pr = '1-URGENT' THEN 'create' ELSE 'update' END AS outcome, count(*) AS changes
FROM e GROUP BY ALL
""")
def publish_outcomes(spark, folder):
    """Published events by type and quarantined changes by reason."""
    judged = events.judge_changes(_changes(spark, folder))
    return judged.groupBy(F.coalesce("reason", "type").alias("outcome")).agg(
        F.count(F.lit(1)).alias("changes")
    )


@query(_BASE_SQL + """
SELECT orderkey, 'grantflow' AS source, 'GrantModificationEvent' AS detail_type,
       CASE WHEN pr = '2-HIGH' THEN 'delete' WHEN pr = '1-URGENT' THEN 'create' ELSE 'update' END AS type,
       CASE WHEN pr <> '1-URGENT' THEN CAST(orderkey AS VARCHAR) END AS old_id,
       CASE WHEN pr <> '2-HIGH' THEN 'Some Act' END AS new_bill,
       CASE WHEN pr <> '2-HIGH' THEN strftime(day, '%Y-%m-%d') END AS new_post_date,
       CASE WHEN pr <> '2-HIGH' THEN 'AG' END AS new_activity,
       CASE WHEN pr <> '2-HIGH' THEN strftime(day, '%Y-%m-%d') || 'T00:00:00Z' END AS new_stamp
FROM e WHERE pr = '2-HIGH' OR len(errs) = 0
""")
def canonical_event(spark, folder):
    """Fields read back from the JSON of published events."""
    published, _ = events.publishable(_changes(spark, folder), carry=("orderkey",))
    at = lambda path: F.get_json_object("detail", f"$.versions.{path}")
    return published.select(
        "orderkey", "source", "detail_type", F.get_json_object("detail", "$.type").alias("type"),
        at("previous.opportunity.id").alias("old_id"), at("new.bill").alias("new_bill"),
        at("new.opportunity.milestones.post_date").alias("new_post_date"),
        at("new.funding_activity.categories[0].code").alias("new_activity"),
        at("new.revision.timestamp").alias("new_stamp"),
    )


@query(_BASE_SQL + """
SELECT change, field, count(*) AS n FROM (
  SELECT s.change AS change, unnest(list_filter([
    CASE WHEN nk = 0 THEN 'revision' END,
    CASE WHEN pr NOT IN ('1-URGENT', '2-HIGH') THEN 'CostSharingOrMatchingRequirement' END,
    CASE WHEN pr = '5-LOW' THEN 'ExpectedNumberOfAwards' END,
    CASE WHEN st = 'P' THEN 'OpportunityCategory' END,
    CASE WHEN seg = 'MACHINERY' THEN 'LastUpdatedDate' END,
    CASE WHEN pr = '1-URGENT' AND st = 'F' THEN 'CFDANumbers' END,
    CASE WHEN seg = 'HOUSEHOLD' THEN 'EligibleApplicants' END,
    CASE WHEN st = 'F' AND price % 2 = 0 THEN 'FundingInstrumentType' END], lambda x: x IS NOT NULL)) AS field
  FROM e, (VALUES ('OldImage'), ('NewImage')) s(change)
  WHERE (s.change = 'OldImage' AND pr <> '1-URGENT') OR (s.change = 'NewImage' AND pr <> '2-HIGH'))
GROUP BY ALL
""")
def malformed_by_image(spark, folder):
    return events.malformed_counts(events.judge_changes(_changes(spark, folder)))


_FACETS = [
    validate.Facet("text", max_length=4000),
    validate.Facet("source", pattern=r"src[0-9]"),
    validate.Facet("lang", max_length=2, pattern=r"en|de"),
]


@query("""
SELECT doc_id, array_to_string(list_sort(list_filter([
  CASE WHEN length(text) > 4000 THEN 'text' END,
  CASE WHEN source <> '' AND NOT regexp_full_match(source, 'src[0-9]') THEN 'source' END,
  CASE WHEN lang <> '' AND (length(lang) > 2 OR NOT regexp_full_match(lang, 'en|de')) THEN 'lang' END],
  lambda x: x IS NOT NULL)), ',') AS broken
FROM documents
""")
def facet_errors(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", joined(validate.facet_errors(F.col, _FACETS)).alias("broken")
    )


@query(_BASE_SQL + """
SELECT orderkey, 'ok' AS status, false AS is_forecast, CAST(orderkey AS VARCHAR) AS id,
       CASE WHEN seg <> 'BUILDING' THEN cname ELSE '' END AS title, nation || ' <R&D>' AS agency,
       CASE WHEN seg = 'HOUSEHOLD' THEN '00,XX' ELSE '25' END AS applicants,
       CASE WHEN st = 'F' AND price % 2 = 0 THEN 'G,ZZ' WHEN st = 'F' THEN 'CA' END AS instruments
FROM e
""")
def xml_records(spark, folder):
    """Records written as XML documents and decoded again."""
    # a compact table of orders is read by one task or two; documents are written and decoded by all
    docs = registry_xml.to_xml_text(_records(spark, folder, spread_out=True)).select("orderkey", "xml")
    out = registry_xml.decode_records(docs, "xml")
    return out.select(
        "orderkey", "status", "is_forecast", F.col("OpportunityID").alias("id"),
        F.col("OpportunityTitle").alias("title"), F.col("AgencyName").alias("agency"),
        F.array_join("EligibleApplicants", ",").alias("applicants"),
        F.array_join("FundingInstrumentType", ",").alias("instruments"),
    )


@query("""
SELECT o_orderkey AS orderkey,
       CASE WHEN o_orderpriority = '5-LOW' THEN 'undecodable' WHEN o_orderstatus = 'P' THEN 'forecast' ELSE 'synopsis' END AS kind,
       CASE WHEN o_orderpriority = '5-LOW' THEN '' WHEN o_orderpriority = '1-URGENT' THEN 'a_1_0> <b> & <!-- c'
            WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'x_1_0>y' ELSE o_orderstatus END AS title
FROM orders WHERE NOT (o_orderstatus = 'O' AND o_orderpriority = '2-HIGH')
""")
def xml_extract(spark, folder):
    """Extracts of the orders of each customer, cut at record tags: records of both kinds, some inside comments, some that
    hold the delimiter in CDATA or text, some that can't be decoded."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    title = (
        F.when(priority == "1-URGENT", "<![CDATA[a_1_0> <b> & <!-- c]]>").when(priority == "4-NOT SPECIFIED", "x_1_0>y")
        .otherwise(status))
    tag = F.when(status == "P", "OpportunityForecastDetail_1_0").otherwise("OpportunitySynopsisDetail_1_0")
    closing = F.when(priority == "5-LOW", "</OpportunityName>").otherwise("</OpportunityTitle>")
    record = F.concat(
        F.lit("\n<"), tag, F.lit("><OpportunityID>"), F.col("o_orderkey").cast("string"),
        F.lit("</OpportunityID><OpportunityTitle>"), title, closing, F.lit("</"), tag, F.lit(">"))
    hidden = F.concat(F.lit("<!-- old <![CDATA["), record, F.lit(" -->"))
    record = F.when((status == "O") & (priority == "2-HIGH"), hidden).otherwise(record)
    extracts = table(spark, folder, "orders").groupBy(F.col("o_custkey").cast("string").alias("file")).agg(
        F.array_sort(F.collect_list(F.struct("o_orderkey", record.alias("xml")))).alias("r"))
    text = F.concat(F.lit('<?xml version="1.0"?><Grants>'), F.array_join(F.transform("r", lambda x: x["xml"]), ""), F.lit("</Grants>"))
    pieces = extracts.select("file", F.posexplode(F.split(text, registry_xml.DELIMITER)).alias("at", "chunk"))
    # as a reader gives them: input splits, an order that grows inside each
    chunks = pieces.select(
        "file", F.floor(F.col("at") / 7).alias("split"), F.col("at").cast("long").alias("ord"), "chunk")
    # built once and parsed once, though read for borders and records, for records and rejects
    chunks = stored(spread(chunks, "file"), work_folder(spark, "chunks"))
    records, rejects = registry_xml.parse_results(
        stored(registry_xml.parse_all(chunks, forecasts=True), work_folder(spark, "parsed")))
    good = records.select(
        F.col("grant_id").cast("bigint").alias("orderkey"), F.when(F.col("is_forecast"), "forecast").otherwise("synopsis").alias("kind"),
        F.col("OpportunityTitle").alias("title"))
    bad = rejects.select(
        F.regexp_extract("chunk", r"<OpportunityID>(\d+)", 1).cast("bigint").alias("orderkey"), F.col("reason").alias("kind"),
        F.lit("").alias("title"))
    return good.unionByName(bad)


@query("""
SELECT c_custkey AS custkey, CAST(c_custkey AS VARCHAR) AS grant_id,
       CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS bill,
       CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name || ',' || c_nationkey END AS cfda,
       c_mktsegment = 'MACHINERY' AS unbuildable
FROM customer
""")
def typed_items(spark, folder):
    """Typed-attribute JSON decoded to a row image; a list attribute that is none is flagged."""
    name, nation = F.col("c_name"), F.col("c_nationkey")
    text = lambda c: F.concat(F.lit('{"S":"'), c, F.lit('"}'))
    bill = F.when(F.col("c_mktsegment") == "BUILDING", '{"NULL":true}').otherwise(text(F.col("c_mktsegment")))
    cfda = F.when(F.col("c_mktsegment") == "MACHINERY", text(name)).otherwise(
        F.concat(F.lit('{"L":['), text(name), F.lit(","), text(nation.cast("string")), F.lit("]}"))
    )
    json = F.concat(
        F.lit('{"grant_id":'), text(F.col("c_custkey").cast("string")), F.lit(',"Bill":'), bill,
        F.lit(',"CFDANumbers":'), cfda, F.lit("}"),
    )
    rows = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), items.decode_item(json).alias("item")
    ).withColumn("image", items.item_struct(F.col("item")))
    return rows.select(
        "custkey", F.col("image.grant_id").alias("grant_id"), F.col("image.Bill").alias("bill"),
        F.array_join("image.CFDANumbers", ",").alias("cfda"),
        F.col("image.unbuildable").alias("unbuildable"),
    )


@query("""
SELECT event_id,
       CASE event_type WHEN 'error' THEN 'undecodable' WHEN 'click' THEN 'missing_bill'
            WHEN 'view' THEN 'missing_grant_id' ELSE '' END AS reason,
       CASE WHEN event_type IN ('signup', 'purchase') THEN CAST(props->>'k' AS BIGINT) + 1 END AS grant_id
FROM events
""")
def json_required(spark, folder):
    """Documents that are cut off, lack the bill or lack the id."""
    kind = F.col("event_type")
    grant_id = (F.get_json_object("props", "$.k").cast("bigint") + 1).cast("string")
    full = F.concat(
        F.lit("{"), F.when(kind == "click", "").otherwise(F.concat(F.lit('"bill":"'), kind, F.lit('",'))),
        F.when(kind == "view", "").otherwise(F.concat(F.lit('"grant_id":'), grant_id, F.lit(","))),
        F.lit('"extra":true'), F.when(kind == "error", "").otherwise("}"),
    )
    docs = table(spark, folder, "events").select("event_id", full.alias("doc"))
    out = sheet_json.decode_sheet_json(docs, "doc")
    return out.select(
        "event_id", F.coalesce("reason", F.lit("")).alias("reason"),
        F.when(F.col("reason").isNull(), F.col("rec.grant_id")).alias("grant_id"),
    )


@query("""
SELECT CASE l_returnflag WHEN 'A' THEN true WHEN 'N' THEN false END AS flag, l_returnflag = 'R' AS malformed,
       count(*) AS n
FROM lineitem GROUP BY ALL
""")
def yes_no_flag(spark, folder):
    from grantflow.functions.numbers import yes_no

    text = F.when(F.col("l_returnflag") == "A", "YES").when(F.col("l_returnflag") == "N", "no").otherwise("perhaps")
    flags = table(spark, folder, "lineitem").select(yes_no(text).alias("flag"))
    return flags.groupBy("flag", F.col("flag").isNull().alias("malformed")).agg(F.count(F.lit(1)).alias("n"))
