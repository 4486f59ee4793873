"""Keys, routes, manifests and purges."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.functions import keys
from grantflow.operators import purge
from grantflow.operators.router import route
from grantflow.queries.base import query, table


@query("""
SELECT c_custkey AS custkey,
       CASE WHEN c_custkey >= 100 THEN left(c_custkey::VARCHAR, 3) || '/' || c_custkey || '/grants.gov/v2.' ||
         CASE WHEN c_acctbal < 0 THEN 'OpportunityForecastDetail_1_0.xml' ELSE 'OpportunitySynopsisDetail_1_0.xml' END
       END AS registry_key,
       CASE WHEN c_custkey >= 100 THEN left(c_custkey::VARCHAR, 3) || '/' || c_custkey || '/ffis.org/v1.json'
       END AS sheet_key,
       CASE WHEN c_custkey < 100 THEN 'short_id' ELSE '' END AS problem
FROM customer
""")
def prepared_keys(spark, folder):
    key = F.col("c_custkey").cast("string")
    return table(spark, folder, "customer").select(
        F.col("c_custkey").alias("custkey"),
        keys.registry_key(key, F.col("c_acctbal") < 0).alias("registry_key"),
        keys.sheet_key(F.col("c_custkey")).alias("sheet_key"),
        F.coalesce(keys.key_problem(key), F.lit("")).alias("problem"),
    )


@query("""
SELECT DISTINCT CAST(o_orderdate AS DATE) AS day,
       'https://example.org/extract/GrantsDBExtract' || strftime(o_orderdate, '%Y%m%d') || 'v2.zip' AS address,
       'sources/' || strftime(o_orderdate, '%Y/%m/%d') || '/grants.gov/archive.zip' AS landing
FROM orders
""")
def source_manifest(spark, folder):
    """Download address and landing key of every day, oldest first."""
    days = table(spark, folder, "orders").select(F.to_date("o_orderdate").alias("day")).distinct()
    return days.select(
        "day", keys.locator(F.col("day"), F.lit("https://example.org/extract/")).alias("address"),
        keys.landing_key(F.col("day"), F.lit(keys.REGISTRY_SEGMENT), F.lit("archive.zip")).alias("landing"),
    ).orderBy("landing")


@query("""
SELECT l_returnflag AS flag, l_linestatus AS status,
       CASE WHEN l_quantity > 40 THEN 'status' WHEN l_linestatus = 'F' THEN 'content_type' ELSE 'accepted' END AS verdict,
       count(*) AS n
FROM lineitem GROUP BY ALL
""")
def fetch_accept(spark, folder):
    """Line items as a fetch log."""
    code = F.when(F.col("l_quantity") > 40, 404).otherwise(200)
    kind = F.when(F.col("l_linestatus") == "F", "text/html").otherwise("application/zip")
    return (
        table(spark, folder, "lineitem")
        .groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"),
                 F.coalesce(keys.fetch_problem(code, kind), F.lit("accepted")).alias("verdict"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


_PATHS_SQL = """
WITH p AS (
  SELECT o_orderkey AS orderkey, CASE o_orderpriority
    WHEN '1-URGENT' THEN 'sources/' || strftime(o_orderdate, '%Y/%m/%d') || '/grants.gov/archive.zip'
    WHEN '2-HIGH' THEN 'sources/' || strftime(o_orderdate, '%Y/%m/%d') || '/ffis.org/raw.eml'
    WHEN '3-MEDIUM' THEN left(o_orderkey::VARCHAR, 3) || '/' || o_orderkey || '/ffis.org/v1.json'
    WHEN '4-NOT SPECIFIED' THEN
      left(o_orderkey::VARCHAR, 3) || '/' || o_orderkey || '/grants.gov/v2.OpportunitySynopsisDetail_1_0.xml'
    ELSE 'other/' || o_orderkey || '/grants.gov/archive.zip' END AS path, o_orderpriority AS pr
  FROM orders)
"""


def _paths(spark: SparkSession, folder: str) -> DataFrame:
    pr, day = F.col("o_orderpriority"), F.col("o_orderdate")
    key = F.col("o_orderkey").cast("string")
    below = lambda segment, name: F.concat_ws(
        "/", F.substring(key, 1, 3), key, F.lit(segment), F.lit(name)
    )
    path = (
        F.when(pr == "1-URGENT", keys.landing_key(day, F.lit(keys.REGISTRY_SEGMENT), F.lit("archive.zip")))
        .when(pr == "2-HIGH", keys.landing_key(day, F.lit(keys.SHEET_SEGMENT), F.lit("raw.eml")))
        .when(pr == "3-MEDIUM", below(keys.SHEET_SEGMENT, keys.SHEET_FILE))
        .when(pr == "4-NOT SPECIFIED", below(keys.REGISTRY_SEGMENT, keys.REGISTRY_FILE[False]))
        .otherwise(F.concat(F.lit("other/"), key, F.lit("/grants.gov/archive.zip")))
    )
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), path.alias("path"))


@query(_PATHS_SQL + """
SELECT orderkey, CASE pr WHEN '1-URGENT' THEN 'extract_registry' WHEN '2-HIGH' THEN 'enqueue_sheet_download'
                         WHEN '3-MEDIUM' THEN 'persist_sheet' WHEN '4-NOT SPECIFIED' THEN 'persist_registry' END AS step,
       CASE WHEN pr = '2-HIGH' THEN replace(path, 'raw.eml', 'download.xlsx') ELSE path END AS download_key
FROM p
""")
def route_paths(spark, folder):
    return _paths(spark, folder).select(
        "orderkey", route(F.col("path")).alias("step"), keys.download_key(F.col("path")).alias("download_key")
    )


@query(_PATHS_SQL + """
SELECT orderkey, path FROM p
WHERE (pr = '3-MEDIUM' AND orderkey >= 100) OR (pr = '4-NOT SPECIFIED' AND orderkey >= 100)
   OR (pr = '5-LOW' AND orderkey BETWEEN 10 AND 99)
""")
def purge_match(spark, folder):
    """Sheet and registry objects, and what a glob takes; ``*`` and ``?`` stop at a slash."""
    matchers = purge.purge_matchers(sheet=True, registry=True, globs=("other/??/*/*.zip", "sources/*"))
    return purge.match_paths(_paths(spark, folder), matchers)


@query(_PATHS_SQL + """
SELECT orderkey, path FROM p WHERE NOT (pr = '3-MEDIUM' AND orderkey >= 100 AND starts_with(path, '1'))
""")
def purge_left(spark, folder):
    """Objects that stay after purging one prefix of the sheet objects."""
    paths = _paths(spark, folder)
    return purge.purge_paths(paths, purge.match_paths(paths, purge.purge_matchers(sheet=True), "1"))


@query("""
SELECT o_orderkey AS orderkey, NULL::VARCHAR AS revision, o_custkey AS custkey, o_orderstatus AS status,
       o_totalprice AS price, NULL::VARCHAR AS bill
FROM orders
""")
def purge_strip(spark, folder):
    """Sheet attribute and revision are stripped, the rest stays."""
    return purge.purge_items(
        _items(spark, folder), sheet=True, key="orderkey", sheet_attrs=("bill",)
    )


@query("""
SELECT o_orderkey AS orderkey, o_orderdate::DATE::VARCHAR AS revision, NULL::BIGINT AS custkey,
       NULL::VARCHAR AS status, NULL::DOUBLE AS price, o_orderpriority AS bill
FROM orders
""")
def purge_registry(spark, folder):
    """Only key, revision and sheet attribute stay."""
    return purge.purge_items(
        _items(spark, folder), registry=True, keep_revision=True, key="orderkey", sheet_attrs=("bill",)
    )


def _items(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), F.to_date("o_orderdate").cast("string").alias("revision"),
        F.col("o_custkey").alias("custkey"), F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("price"), F.col("o_orderpriority").alias("bill"),
    )
