"""Freshness, caps, upserts, diffs and revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.frames import work_folder
from grantflow.functions import ulid
from grantflow.operators import caps, diff, events, freshness, skew, upsert
from grantflow.queries.base import query, table
from grantflow.records import RecordSpec
from grantflow.sources import items

_ORDERS = RecordSpec(key="custkey", attrs=("status",), date_col="day")

# Incoming: every order, dated; urgent ones of status P carry a date in another layout.
# Stored: the last finished order of each customer; two segments have a blank or odd date.
_FRESHNESS_SQL = """
WITH incoming AS (
  SELECT o_orderkey AS orderkey, o_custkey AS custkey,
         CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '1-URGENT' THEN NULL
              ELSE CAST(o_orderdate AS DATE) END AS own
  FROM orders),
stored AS (
  SELECT c_custkey AS custkey, c_mktsegment AS seg, CAST(max(o_orderdate) AS DATE) AS day
  FROM customer JOIN orders ON o_custkey = c_custkey WHERE o_orderstatus = 'F'
  GROUP BY c_custkey, c_mktsegment),
judged AS (
  SELECT orderkey,
         CASE WHEN own IS NULL THEN 'bad_date'
              WHEN seg = 'MACHINERY' THEN 'bad_stored_date' END AS reason,
         CASE WHEN own IS NULL OR seg = 'MACHINERY' THEN 'failed'
              WHEN seg IS NULL OR seg = 'BUILDING' THEN 'created'
              WHEN day >= own THEN 'skipped' ELSE 'updated' END AS outcome
  FROM incoming LEFT JOIN stored USING (custkey))
"""


def _incoming(spark: SparkSession, folder: str) -> DataFrame:
    odd = (F.col("o_orderstatus") == "P") & (F.col("o_orderpriority") == "1-URGENT")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_custkey").alias("custkey"),
        F.col("o_orderstatus").alias("status"),
        F.when(odd, F.date_format("o_orderdate", "yyyy-MM-dd"))
        .otherwise(F.date_format("o_orderdate", "MMddyyyy")).alias("day"),
    )


def _judged(spark: SparkSession, folder: str) -> DataFrame:
    incoming = _incoming(spark, folder)
    last = (
        table(spark, folder, "orders").where("o_orderstatus = 'F'")
        .groupBy(F.col("o_custkey").alias("custkey")).agg(F.max("o_orderdate").alias("last"))
    )
    people = table(spark, folder, "customer").select(F.col("c_custkey").alias("custkey"), "c_mktsegment")
    index = people.join(last, "custkey").select(
        "custkey",
        F.when(F.col("c_mktsegment") == "BUILDING", "")
        .when(F.col("c_mktsegment") == "MACHINERY", F.date_format("last", "yyyyMMdd"))
        .otherwise(F.date_format("last", "MMddyyyy")).alias("day"),
    )
    return freshness.freshness(
        incoming, index, _ORDERS, hot=skew.hot_keys(incoming, "custkey")
    )


@query(_FRESHNESS_SQL + "SELECT outcome, count(*) AS records FROM judged GROUP BY outcome")
def freshness_outcomes(spark, folder):
    """How many records are created, updated, skipped and failed."""
    return freshness.outcome_counts(_judged(spark, folder))


@query(_FRESHNESS_SQL + "SELECT orderkey, outcome, coalesce(reason, '') AS reason FROM judged")
def freshness_records(spark, folder):
    return _judged(spark, folder).select(
        "orderkey", "outcome", F.coalesce("reason", F.lit("")).alias("reason")
    )


@query(_FRESHNESS_SQL + """
SELECT CASE WHEN reason = 'bad_date' THEN 'reading' ELSE 'processing' END AS kind, reason,
       count(*) AS errors
FROM judged WHERE reason IS NOT NULL GROUP BY ALL""")
def error_summary(spark, folder):
    failed = _judged(spark, folder).where("reason IS NOT NULL").withColumn(
        "kind", F.when(F.col("reason") == "bad_date", "reading").otherwise("processing")
    )
    return freshness.error_summary(failed)


@query("""
SELECT o_custkey AS custkey, o_orderkey AS orderkey, o_orderstatus AS status
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) = 1
""")
def latest_per_key(spark, folder):
    latest = freshness.latest_per_key(
        table(spark, folder, "orders"), "o_custkey", F.desc("o_orderdate"), F.desc("o_orderkey")
    )
    return latest.select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"),
    )


@query("""
WITH typed AS (
  SELECT event_id, CAST(ts AS DATE) AS file, event_type, row_number() OVER
         (PARTITION BY CAST(ts AS DATE), event_type ORDER BY event_id) AS nth
  FROM events),
kept AS (
  SELECT event_id, file, event_type FROM typed
  WHERE NOT (event_type = 'click' AND nth > 40) AND NOT (event_type = 'view' AND nth > 0))
SELECT event_id, event_type FROM kept
QUALIFY row_number() OVER (PARTITION BY file ORDER BY event_id) <= 200
""")
def record_caps(spark, folder):
    """First 200 events of a day, at most 40 clicks and no views."""
    days = table(spark, folder, "events").withColumn("file", F.to_date("ts"))
    kept = caps.cap_records(days, 200, {"click": 40, "view": 0, "error": -1}, "file", "event_type", "event_id")
    return kept.select("event_id", "event_type")


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    """Snapshot of all customers outside one segment."""
    return table(spark, folder, "customer").where("c_mktsegment <> 'AUTOMOBILE'").select(
        F.col("c_custkey").alias("custkey"), "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
        "c_acctbal", "c_mktsegment",
    )


def _renewed():
    balance = F.col("c_acctbal")
    return F.when(F.col("c_nationkey") < 5, F.round(balance + 1, 2)).otherwise(balance)


@query("""
WITH inc AS (
  SELECT c_custkey AS custkey, c_name,
         CASE WHEN c_nationkey < 5 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS c_acctbal,
         c_mktsegment
  FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders)),
prev AS (SELECT c_custkey AS custkey, * EXCLUDE (c_custkey) FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
SELECT coalesce(p.custkey, i.custkey) AS custkey, coalesce(i.c_name, p.c_name) AS c_name,
       CAST(p.c_nationkey AS BIGINT) AS c_nationkey,
       coalesce(i.c_acctbal, p.c_acctbal) AS c_acctbal,
       coalesce(i.c_mktsegment, p.c_mktsegment) AS c_mktsegment,
       i.custkey IS NOT NULL AND (p.custkey IS NULL OR p.c_acctbal <> i.c_acctbal) AS changed
FROM prev p FULL JOIN inc i ON p.custkey = i.custkey
""")
def upsert_changed(spark, folder):
    """Customers with orders arrive, some with a new balance; the nation is not theirs to write."""
    buyers = table(spark, folder, "orders").select(F.col("o_custkey").alias("custkey"))
    incoming = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), "c_name", _renewed().alias("c_acctbal"), "c_mktsegment"
    ).join(buyers, "custkey", "left_semi")
    spec = RecordSpec(key="custkey", attrs=("c_name", "c_acctbal", "c_mktsegment"))
    return upsert.upsert_changed(_stored(spark, folder), incoming, spec)


@query("""
SELECT c_custkey AS custkey, c_name,
       CASE WHEN c_nationkey < 5 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') THEN 'PARTIAL'
            ELSE c_mktsegment END AS c_mktsegment
FROM customer
WHERE c_mktsegment <> 'AUTOMOBILE' OR c_nationkey < 5 OR c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def upsert_delta(spark, folder):
    """A base and two deltas, each with the new and changed rows of its batch only, read as the current table."""
    names = ("custkey", "c_name", "c_acctbal", "c_mktsegment")
    spec = RecordSpec(key="custkey", attrs=names[1:])
    everyone = table(spark, folder, "customer").withColumnRenamed("c_custkey", "custkey")
    base = _stored(spark, folder).select(*names)
    renewed = everyone.where("c_nationkey < 5").withColumn("c_acctbal", _renewed()).select(*names)
    first = upsert.upsert_delta(base, renewed, spec).drop("changed").withColumn("_version", F.lit(1))
    partial = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("custkey"))
    then = everyone.join(partial, "custkey", "left_semi").withColumn("c_acctbal", F.when(
        F.col("c_nationkey") < 5, _renewed()).otherwise(F.col("c_acctbal"))).withColumn(
        "c_mktsegment", F.lit("PARTIAL")).select(*names)
    table_then = items.current_rows(base, first, "custkey")
    second = upsert.upsert_delta(table_then, then, spec).drop("changed").withColumn("_version", F.lit(2))
    return items.current_rows(base, first.unionByName(second), "custkey")


@query("""
WITH c AS (
  SELECT c_custkey AS custkey, c_acctbal AS old, CASE WHEN c_nationkey < 5 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS bal,
         c_mktsegment AS seg, c_nationkey < 5 AS renewed, c_mktsegment <> 'AUTOMOBILE' AS stored,
         c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') AS partial
  FROM customer)
SELECT CAST(2 AS BIGINT) AS version, custkey, CASE WHEN stored THEN 'MODIFY' ELSE 'INSERT' END AS op,
       CASE WHEN stored THEN old END AS old_balance, bal AS new_balance, CASE WHEN stored THEN seg END AS old_segment,
       seg AS new_segment
FROM c WHERE renewed
UNION ALL
SELECT CAST(3 AS BIGINT), custkey, CASE WHEN stored OR renewed THEN 'MODIFY' ELSE 'INSERT' END,
       CASE WHEN stored OR renewed THEN bal END, bal, CASE WHEN stored OR renewed THEN seg END, 'PARTIAL'
FROM c WHERE partial
""")
def feed_events(spark, folder):
    """A table of a base and two commits; the feed of the commits, from their deltas alone."""
    names = ("custkey", "c_name", "c_acctbal", "c_mktsegment")
    spec = RecordSpec(key="custkey", attrs=names[1:])
    everyone = table(spark, folder, "customer").withColumnRenamed("c_custkey", "custkey")
    root, schema = work_folder(spark, "feed"), everyone.select(*names).schema
    items.write_snapshot(_stored(spark, folder).select(*names), root, key="custkey")
    balance = F.when(F.col("c_nationkey") < 5, _renewed()).otherwise(F.col("c_acctbal"))
    partial = table(spark, folder, "orders").where("o_orderstatus = 'P'").select(F.col("o_custkey").alias("custkey"))
    batches = [
        everyone.where("c_nationkey < 5").withColumn("c_acctbal", balance),
        everyone.join(partial, "custkey", "left_semi").withColumn("c_acctbal", balance).withColumn("c_mktsegment", F.lit("PARTIAL")),
    ]
    for batch in batches:
        incoming, start = batch.select(*names), items.next_version(spark, root)
        previous = items.read_snapshot(
            spark, root, schema=schema, key="custkey", prefixes=items.prefixes_of(incoming, "custkey"), last=start[0])
        changed = upsert.upsert_delta(previous.select(*names), incoming, spec, images=True)
        items.write_delta(upsert.feed_rows(changed, list(names)), root, key="custkey", start=start)
    return items.read_changes(spark, root, [1, 2, 3], schema).select(
        "version", F.col("new.custkey").alias("custkey"), "op", F.col("old.c_acctbal").alias("old_balance"),
        F.col("new.c_acctbal").alias("new_balance"), F.col("old.c_mktsegment").alias("old_segment"),
        F.col("new.c_mktsegment").alias("new_segment"))


@query("""
WITH inc AS (
  SELECT o_custkey AS custkey, arg_max(o_orderpriority, o_orderkey) AS c_mktsegment
  FROM orders WHERE o_orderstatus = 'O' GROUP BY o_custkey),
prev AS (SELECT c_custkey AS custkey, * EXCLUDE (c_custkey) FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
SELECT coalesce(p.custkey, i.custkey) AS custkey, p.c_name, CAST(p.c_nationkey AS BIGINT) AS c_nationkey,
       p.c_acctbal, coalesce(i.c_mktsegment, p.c_mktsegment) AS c_mktsegment,
       i.custkey IS NOT NULL AND i.c_mktsegment IS DISTINCT FROM p.c_mktsegment AS changed
FROM prev p FULL JOIN inc i ON p.custkey = i.custkey
""")
def upsert_partial(spark, folder):
    """One attribute arrives, also for unknown keys, which become partial rows."""
    incoming = (
        table(spark, folder, "orders").where("o_orderstatus = 'O'")
        .groupBy(F.col("o_custkey").alias("custkey"))
        .agg(F.max_by("o_orderpriority", "o_orderkey").alias("c_mktsegment"))
    )
    spec = RecordSpec(key="custkey", attrs=("c_mktsegment",))
    return upsert.upsert_changed(_stored(spark, folder), incoming, spec)


@query("""
WITH inc AS (
  SELECT c_custkey AS custkey,
         CASE WHEN c_nationkey < 5 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS c_acctbal
  FROM customer),
prev AS (SELECT c_custkey AS custkey, c_acctbal FROM customer WHERE c_mktsegment <> 'AUTOMOBILE')
SELECT i.custkey, CASE WHEN p.custkey IS NULL THEN 'INSERT' ELSE 'MODIFY' END AS op,
       p.c_acctbal AS old_balance, i.c_acctbal AS new_balance
FROM inc i LEFT JOIN prev p USING (custkey)
WHERE p.custkey IS NULL OR p.c_acctbal <> i.c_acctbal
""")
def upsert_feed(spark, folder):
    """Old and new image of everything an upsert changed."""
    incoming = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"), _renewed().alias("c_acctbal")
    )
    spec = RecordSpec(key="custkey", attrs=("c_acctbal",))
    out = upsert.upsert_changed(_stored(spark, folder), incoming, spec, images=True)
    return upsert.change_feed(out).select(
        F.col("new.custkey").alias("custkey"), "op", F.col("old.c_acctbal").alias("old_balance"),
        F.col("new.c_acctbal").alias("new_balance"),
    )


@query("""
WITH old AS (SELECT c_custkey AS custkey, c_acctbal AS rev FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'),
new AS (
  SELECT c_custkey AS custkey,
         CASE WHEN c_nationkey < 5 THEN round(c_acctbal + 1, 2) ELSE c_acctbal END AS rev
  FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT coalesce(o.custkey, n.custkey) AS custkey, o.rev AS old_balance, n.rev AS new_balance,
       CASE WHEN o.custkey IS NULL THEN 'create' WHEN n.custkey IS NULL THEN 'delete' ELSE 'update' END AS type
FROM old o FULL JOIN new n ON o.custkey = n.custkey
WHERE o.custkey IS NULL OR n.custkey IS NULL OR o.rev IS DISTINCT FROM n.rev
""")
def snapshot_diff(spark, folder):
    old = _stored(spark, folder)
    new = (
        table(spark, folder, "customer").where("c_mktsegment <> 'BUILDING'")
        .select(F.col("c_custkey").alias("custkey"), "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
                _renewed().alias("c_acctbal"), "c_mktsegment")
    )
    return diff.diff_snapshots(old, new, "custkey", "c_acctbal").select(
        "custkey", F.col("old.c_acctbal").alias("old_balance"),
        F.col("new.c_acctbal").alias("new_balance"),
        diff.event_type(F.col("new"), F.col("old")).alias("type"),
    )


@query("""
WITH e AS (
  SELECT event_id, CAST(ts AS DATE) AS day, event_type = 'purchase' AND value > 70 AS failed FROM events),
f AS (SELECT day, min(event_id) AS first FROM e WHERE failed GROUP BY day)
SELECT day, CASE WHEN first IS NULL OR event_id < first THEN 'published'
                 WHEN event_id = first THEN 'failed' ELSE 'retry' END AS disposition, count(*) AS records
FROM e LEFT JOIN f USING (day) GROUP BY ALL
""")
def failure_prefix(spark, folder):
    """What a day's batch publishes before its first failing event."""
    days = table(spark, folder, "events").withColumn("day", F.to_date("ts"))
    failed = (F.col("event_type") == "purchase") & (F.col("value") > 70)
    out = events.prefix_until_failure(days, "day", "event_id", failed, skew.hot_keys(days, "day"))
    return out.groupBy("day", "disposition").agg(F.count(F.lit(1)).alias("records"))


@query("SELECT event_id, epoch_us(ts) // 1000 AS millis, true AS valid FROM events")
def ulid_time(spark, folder):
    """Ids built from event times and decoded again."""
    millis = F.unix_millis(F.col("ts").cast("timestamp"))
    rows = table(spark, folder, "events").select(
        "event_id", ulid.revision_id(millis, F.col("event_id"), F.col("event_type")).alias("id")
    )
    return rows.select(
        "event_id", ulid.ulid_millis(F.col("id")).alias("millis"), ulid.is_ulid(F.col("id")).alias("valid")
    )


@query("""
WITH d AS (
  SELECT o_orderkey AS orderkey, epoch_us(o_orderdate) // 1000 AS ms,
         sha256('{"c0":' || o_orderkey || ',"c1":"' || o_orderstatus || '"}') AS h,
         '0123456789ABCDEFGHJKMNPQRSTVWXYZ' AS a
  FROM orders),
n AS (
  SELECT *, CAST('0x' || h[1:10] AS BIGINT) AS h1, CAST('0x' || h[11:20] AS BIGINT) AS h2 FROM d)
SELECT orderkey,
       array_to_string([a[CAST((ms >> (5 * (9 - i))) & 31 AS INT) + 1] FOR i IN range(10)], '') ||
       array_to_string([a[CAST((h1 >> (5 * (7 - i))) & 31 AS INT) + 1] FOR i IN range(8)], '') ||
       array_to_string([a[CAST((h2 >> (5 * (7 - i))) & 31 AS INT) + 1] FOR i IN range(8)], '') AS revision
FROM n
""")
def revision_id(spark, folder):
    orders = table(spark, folder, "orders")
    millis = F.unix_millis(F.col("o_orderdate").cast("timestamp"))
    return orders.select(
        F.col("o_orderkey").alias("orderkey"),
        ulid.revision_id(millis, F.col("o_orderkey"), F.col("o_orderstatus")).alias("revision"),
    )
