"""Sheet rows and the parsing rules of their cells."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.functions import links, numbers
from grantflow.functions.dates import due_date
from grantflow.operators import sheet
from grantflow.plans.maintain import backfill_manifest
from grantflow.queries.base import query, table


@query("""
WITH e AS (
  SELECT *, min(CASE WHEN event_type = 'view' THEN event_id END) OVER (PARTITION BY user_id) AS head FROM events),
c AS (
  SELECT *, max(CASE WHEN event_type = 'signup' AND event_id > head THEN event_id END) OVER
            (PARTITION BY user_id ORDER BY event_id ROWS UNBOUNDED PRECEDING) AS heading
  FROM e)
SELECT event_id, user_id, coalesce('signup ' || heading, '') AS bill
FROM c WHERE event_id > head AND event_type IN ('click', 'purchase')
""")
def sheet_forward_fill(spark, folder):
    """A user's events as rows: the first view is the header, signups are headings, errors blank."""
    kind = (
        F.when(F.col("event_type") == "view", "header").when(F.col("event_type") == "signup", "heading")
        .when(F.col("event_type") == "error", "blank").otherwise("data")
    )
    rows = table(spark, folder, "events").select(
        "event_id", "user_id", kind.alias("kind"),
        F.concat(F.lit("signup "), F.col("event_id")).alias("heading"),
    )
    return sheet.carry_headings(rows, "user_id", "event_id", "kind", "heading").select(
        "event_id", "user_id", "bill"
    )


# Every part is a row of its brand's workbook. Small sizes are headings, header rows and blank
# rows; the other rows hold cells in good and bad shapes, told apart by the part's type.
_CELLS_SQL = """
WITH cells AS (
  SELECT p_brand AS file, p_partkey AS row_idx, p_type, p_name,
         CASE WHEN p_size = 1 THEN 'CFDA' WHEN p_size = 2 THEN '' WHEN p_size <= 6 THEN p_name
              ELSE p_size || '.' || (p_partkey % 1000) END AS c0,
         CASE p_type WHEN 'ECONOMY' THEN 'N/A' WHEN 'PROMO' THEN '1,000'
              ELSE CAST(CAST(floor(p_retailprice) AS BIGINT) AS VARCHAR) END AS c3,
         CASE p_type WHEN 'ECONOMY' THEN '5-' || (p_partkey % 28 + 1) || '-99'
              WHEN 'PROMO' THEN '5/' || (p_partkey % 28 + 1) || '/23' ELSE 'soon' END AS c12
  FROM part),
h AS (SELECT *, min(CASE WHEN c0 = 'CFDA' THEN row_idx END) OVER (PARTITION BY file) AS head FROM cells),
b AS (
  SELECT *, regexp_full_match(c0, '[0-9]{1,2}[.][0-9]{0,3}[+]?') AS is_data,
         last_value(CASE WHEN c0 NOT IN ('', 'CFDA') AND row_idx > head
                          AND NOT regexp_full_match(c0, '[0-9]{1,2}[.][0-9]{0,3}[+]?') THEN c0 END IGNORE NULLS)
           OVER (PARTITION BY file ORDER BY row_idx ROWS UNBOUNDED PRECEDING) AS heading
  FROM h),
d AS (
  SELECT file, row_idx, p_type, coalesce(heading, '') AS bill, printf('%06.3f', CAST(c0 AS DOUBLE)) AS cfda,
         coalesce(TRY_CAST(CASE WHEN regexp_full_match(c3, '[+-]?[0-9]+') THEN c3 END AS BIGINT), 0) AS funding,
         CASE p_type WHEN 'ECONOMY' THEN make_date(1999, 5, row_idx % 28 + 1)
              WHEN 'PROMO' THEN make_date(2023, 5, row_idx % 28 + 1) END AS due,
         row_idx + 1 AS grant_id
  FROM b WHERE is_data AND row_idx > head)
"""


def _cells(spark: SparkSession, folder: str) -> DataFrame:
    p = table(spark, folder, "part")
    key, size, kind = F.col("p_partkey"), F.col("p_size"), F.col("p_type")
    first = (
        F.when(size == 1, "CFDA").when(size == 2, "").when(size <= 6, F.col("p_name"))
        .otherwise(F.concat(size, F.lit("."), key % 1000))
    )
    funding = (
        F.when(kind == "ECONOMY", "N/A").when(kind == "PROMO", "1,000")
        .otherwise(F.floor("p_retailprice").cast("string"))
    )
    day = (key % 28 + 1).cast("string")
    due = (
        F.when(kind == "ECONOMY", F.concat(F.lit("5-"), day, F.lit("-99")))
        .when(kind == "PROMO", F.concat(F.lit("5/"), day, F.lit("/23"))).otherwise("soon")
    )
    mark = F.when(kind == "PROMO", "X").otherwise("N")
    host = F.when(kind == "STANDARD", "https://not.grants.gov").otherwise("https://www.grants.gov")
    link = F.concat(host, F.lit("/search-results-detail/"), (key + 1).cast("string"))
    return p.select(
        F.col("p_brand").alias("file"), key.alias("row_idx"),
        F.array(
            first, F.col("p_name"), F.col("p_brand"), funding, F.lit("N/A"),
            F.concat(F.lit("N-"), key), mark, F.lit("N"), F.lit(""), F.lit("X"), F.lit("x"),
            F.lit(""), due, mark,
        ).alias("cells"),
        link.alias("link"), F.lit(None).cast("string").alias("error"),
    )


@query(_CELLS_SQL + """
SELECT file, row_idx, bill, cfda, funding AS estimated_funding, due AS due_date, grant_id,
       p_type = 'PROMO' AS state, true AS higher_education, p_type = 'PROMO' AS match
FROM d WHERE p_type <> 'STANDARD'
""")
def sheet_parse(spark, folder):
    rows, _ = sheet.parse_sheet(_cells(spark, folder))
    return rows.select(
        "file", "row_idx", "bill", "cfda", "estimated_funding", "due_date", "grant_id",
        F.col("eligibility.state").alias("state"),
        F.col("eligibility.higher_education").alias("higher_education"), "match",
    )


@query(_CELLS_SQL + """
SELECT target, count(*) AS errors FROM (
  SELECT 'EstimatedFunding' AS target FROM d WHERE p_type = 'PROMO'
  UNION ALL SELECT 'GrantID' FROM d WHERE p_type = 'STANDARD'
  UNION ALL SELECT 'DueDate' FROM d WHERE p_type NOT IN ('ECONOMY', 'PROMO'))
GROUP BY target
""")
def sheet_cell_errors(spark, folder):
    _, errors = sheet.parse_sheet(_cells(spark, folder))
    return errors.groupBy("target").agg(F.count(F.lit(1)).alias("errors"))


@query("""
SELECT p_partkey AS partkey, printf('%06.3f', CAST(p_size || '.' || (p_partkey % 1000) AS DOUBLE)) AS cfda,
       true AS valid
FROM part
""")
def cfda_normalize(spark, folder):
    text = F.concat(
        F.col("p_size"), F.lit("."), F.col("p_partkey") % 1000,
        F.when(F.col("p_type") == "PROMO", "+").otherwise(""),
    )
    number = numbers.cfda_number(text)
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("partkey"), number.alias("cfda"), numbers.is_cfda(number).alias("valid")
    )


@query("""
WITH t AS (
  SELECT p_partkey AS partkey, p_type,
         CASE p_type WHEN 'ECONOMY' THEN 'N/A' WHEN 'PROMO' THEN '+' || CAST(p_partkey AS VARCHAR)
              ELSE CAST(p_retailprice AS VARCHAR) END AS txt
  FROM part)
SELECT partkey, coalesce(CASE WHEN p_type = 'PROMO' THEN partkey END, 0) AS amount,
       p_type NOT IN ('ECONOMY', 'PROMO') AS is_bad
FROM t
""")
def amount_parse(spark, folder):
    """Prices with decimals are no amounts; N/A counts as 0 without an error."""
    text = (
        F.when(F.col("p_type") == "ECONOMY", "N/A")
        .when(F.col("p_type") == "PROMO", F.concat(F.lit("+"), F.col("p_partkey")))
        .otherwise(F.col("p_retailprice").cast("string"))
    )
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("partkey"), numbers.amount(text).alias("amount"),
        numbers.amount_is_bad(text).alias("is_bad"),
    )


@query("""
SELECT o_orderkey AS orderkey,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL ELSE CAST(o_orderdate AS DATE) END AS due
FROM orders
""")
def due_date_parse(spark, folder):
    text = (
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy.MM.dd"))
        .when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "M-d-yy"))
        .otherwise(F.date_format("o_orderdate", "M/d/yy"))
    )
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), due_date(text).alias("due")
    )


@query(r"""
SELECT page_id, coalesce(
  TRY_CAST(regexp_extract(url, '^https?://[^/]+/[a-z]{2}/([0-9]+)$', 1) AS BIGINT),
  TRY_CAST(regexp_extract(url, '[?&]page=([0-9]+)(?:[&#]|$)', 1) AS BIGINT)) AS link_id
FROM pages
""")
def link_grant_id(spark, folder):
    """Ids in page addresses: in the path, else in the query."""
    return table(spark, folder, "pages").select(
        "page_id",
        links.link_id(F.col("url"), hosts=None, path=r"^/[a-z]{2}/[0-9]+\z", param="page").alias("link_id"),
    )


@query("""
SELECT p_partkey AS partkey,
       CASE WHEN p_type IN ('ECONOMY', 'PROMO') OR p_size < 10 THEN p_partkey END AS link_id
FROM part
""")
def link_hosts(spark, folder):
    """Path-style, query-style and foreign links."""
    key, kind = F.col("p_partkey"), F.col("p_type")
    link = (
        F.when(kind == "ECONOMY", F.concat(F.lit("https://www.grants.gov/search-results-detail/"), key))
        .when(kind == "PROMO", F.concat(F.lit("https://grants.gov/web/view?a=1&oppId="), key))
        .when(F.col("p_size") < 10, F.concat(
            F.lit("https://grants.gov/search-results-detail/7?oppId="), key))
        .otherwise(F.concat(F.lit("https://not.grants.gov/search-results-detail/"), key))
    )
    return table(spark, folder, "part").select(key.alias("partkey"), links.link_id(link).alias("link_id"))


@query("""
SELECT 'book ' || o_orderkey AS source_path,
       'sources/' || strftime(o_orderdate, '%Y/%m/%d') || '/ffis.org/download.xlsx' AS dest_key
FROM orders WHERE o_orderpriority <> '4-NOT SPECIFIED'
""")
def backfill_keys(spark, folder):
    """Every order as a workbook that prints its date in N2; one priority prints it wrongly."""
    shown = F.when(
        F.col("o_orderpriority") == "4-NOT SPECIFIED", F.date_format("o_orderdate", "yyyy-MM-dd")
    ).otherwise(F.date_format("o_orderdate", "MMMM d, yyyy"))
    cells = table(spark, folder, "orders").select(
        F.concat(F.lit("book "), F.col("o_orderkey")).alias("file"), F.lit(1).alias("row_idx"),
        F.concat(F.array_repeat(F.lit(""), 13), F.array(shown)).alias("cells"),
        F.lit(None).cast("string").alias("error"),
    )
    manifest, _ = backfill_manifest(cells)
    return manifest
