"""Code and name lookups, record union."""

from __future__ import annotations

from pyspark.sql import functions as F

from grantflow.operators import lookup
from grantflow.queries.base import joined, query, table

# A dimension for the order priorities; one priority is left unknown.
PRIORITY = {"1-URGENT": "Urgent", "2-HIGH": "High", "3-MEDIUM": "Medium", "5-LOW": "Low"}
FLAG = {"A": "Accepted", "R": "Returned"}

_PRIORITY_CASE = """CASE o_orderpriority WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
 WHEN '3-MEDIUM' THEN 'Medium' WHEN '5-LOW' THEN 'Low' ELSE '' END"""


@query(f"""
SELECT o_orderkey AS orderkey, o_orderpriority AS code, {_PRIORITY_CASE} AS name,
       o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AS is_unknown
FROM orders
""")
def code_lookup(spark, folder):
    entry = lookup.code_to_struct(F.col("o_orderpriority"), PRIORITY)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("orderkey"), entry["code"].alias("code"), entry["name"].alias("name"),
        (~lookup.is_known(F.col("o_orderpriority"), PRIORITY)).alias("is_unknown"),
    )


@query("""
SELECT c_custkey AS custkey, CASE WHEN n_regionkey <> 0 THEN n_name ELSE '' END AS name,
       n_regionkey = 0 AS is_unknown
FROM customer JOIN nation ON n_nationkey = c_nationkey
""")
def dimension_lookup(spark, folder):
    """Nation names from a table in which one region is missing."""
    nations = table(spark, folder, "nation").where("n_regionkey <> 0")
    out = lookup.lookup_code(
        table(spark, folder, "customer"), "c_nationkey", nations, "n_nationkey", "n_name"
    )
    return out.select(F.col("c_custkey").alias("custkey"), "name", "is_unknown")


@query("""
WITH s AS (
  SELECT DISTINCT l_orderkey, l_returnflag AS code,
         CASE l_returnflag WHEN 'A' THEN 'Accepted' WHEN 'R' THEN 'Returned' ELSE '' END AS name
  FROM lineitem)
SELECT l_orderkey AS orderkey, string_agg(code || '=' || name, ',' ORDER BY code || '=' || name) AS flags,
       bool_or(name = '') AS has_unknown
FROM s GROUP BY l_orderkey
""")
def code_array_lookup(spark, folder):
    """Return flags of an order as coded entries."""
    flags = table(spark, folder, "lineitem").groupBy(F.col("l_orderkey").alias("orderkey")).agg(
        F.collect_set("l_returnflag").alias("codes")
    )
    entries = flags.withColumn("entries", lookup.codes_to_structs(F.col("codes"), FLAG))
    return entries.select(
        "orderkey",
        joined(F.transform("entries", lambda e: F.concat_ws("=", e["code"], e["name"]))).alias("flags"),
        F.exists("entries", lambda e: ~lookup.agrees(e, FLAG)).alias("has_unknown"),
    )


@query("""
SELECT s_suppkey AS suppkey, n_name AS nation, CAST(n_nationkey AS VARCHAR) AS code, false AS is_unknown
FROM supplier JOIN nation ON n_nationkey = s_nationkey
""")
def reverse_lookup(spark, folder):
    """Nation code found by name."""
    nations = table(spark, folder, "nation")
    named = table(spark, folder, "supplier").join(
        nations.select(F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("nation")),
        "s_nationkey",
    )
    side = nations.withColumn("code", F.col("n_nationkey").cast("string"))
    out = lookup.lookup_code(named, "nation", side, "n_name", "code")
    return out.select(F.col("s_suppkey").alias("suppkey"), "nation", F.col("name").alias("code"), "is_unknown")


@query(f"""
SELECT {_PRIORITY_CASE} AS name,
       CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN '' ELSE o_orderpriority END AS code, count(*) AS orders
FROM orders GROUP BY ALL
""")
def name_lookup(spark, folder):
    """Priority code found by its name."""
    named = table(spark, folder, "orders").select(
        lookup.code_to_struct(F.col("o_orderpriority"), PRIORITY)["name"].alias("name")
    )
    return named.groupBy("name").agg(F.count(F.lit(1)).alias("orders")).select(
        "name", lookup.name_to_struct(F.col("name"), PRIORITY)["code"].alias("code"), "orders"
    )


@query("SELECT p_name AS name, count(*) AS codes FROM part GROUP BY p_name HAVING count(*) > 1")
def duplicate_names(spark, folder):
    parts = table(spark, folder, "part").withColumnRenamed("p_name", "name")
    return lookup.duplicate_names(parts, "name")


@query("""
SELECT c_custkey AS key, c_name AS name, c_mktsegment AS segment, c_acctbal AS balance, false AS is_supplier
FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal, true FROM supplier
""")
def record_union(spark, folder):
    """Two record types in one stream; what one type lacks is NULL."""
    customers = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("segment"), F.col("c_acctbal").alias("balance"),
        F.lit(False).alias("is_supplier"),
    )
    suppliers = table(spark, folder, "supplier").select(
        F.col("s_suppkey").alias("key"), F.col("s_name").alias("name"),
        F.col("s_acctbal").alias("balance"), F.lit(True).alias("is_supplier"),
    )
    return customers.unionByName(suppliers, allowMissingColumns=True)
