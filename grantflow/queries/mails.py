"""Mail trust, plain-text parts and download links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.functions.links import extract_one
from grantflow.functions.mail import plain_part
from grantflow.operators.trust import classify_mail
from grantflow.plans.ingest_mail import download_requests, receive_mail
from grantflow.queries.base import query, table
from grantflow.sources.mail_text import parse_mail

_ALLOW = ["Example.ORG", "allowed+any@example.com"]

# Every order as a mail; what is wrong with it follows from status, priority and price.
_VERDICT_SQL = """
WITH m AS (
  SELECT o_orderkey AS orderkey, CAST(o_orderdate AS DATE) AS day,
         CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'message'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '5-LOW' THEN 'sender'
              WHEN o_orderstatus = 'F' AND o_orderpriority = '4-NOT SPECIFIED' THEN 'date' END AS parse_error,
         CASE WHEN o_orderstatus = 'P' OR (o_orderstatus = 'O' AND o_orderpriority > '3') THEN 'sender'
              WHEN o_orderpriority = '3-MEDIUM' THEN 'spf'
              WHEN o_totalprice > 400000 THEN 'spam'
              WHEN o_totalprice < 50000 THEN 'virus' ELSE 'trusted' END AS trust
  FROM orders)
"""


def _mails(spark: SparkSession, folder: str) -> DataFrame:
    st, pr, price = F.col("o_orderstatus"), F.col("o_orderpriority"), F.col("o_totalprice")
    sender = (
        F.when(st == "F", F.concat(F.lit("\"Doe, Jane\" <user."), F.col("o_custkey"), F.lit("+x@example.org>")))
        .when((st == "O") & (pr < "3"), "Al.lowed+tag@EXAMPLE.com")
        .when(st == "O", F.concat(F.lit("User <user"), F.col("o_custkey"), F.lit("@example.com>")))
        .otherwise("nobody@else.net")
    )
    lost_sender = (st == "F") & (pr == "5-LOW")
    date = F.when((st == "F") & (pr == "4-NOT SPECIFIED"), "some day").otherwise(
        F.concat(F.lit("Sat, "), F.date_format("o_orderdate", "d MMM yyyy"), F.lit(" 23:30:00 -0500"))
    )
    unfinished = (st == "O") & (pr == "4-NOT SPECIFIED")
    text = F.concat(
        F.lit("Subject: a mail\n folded\nx-ses-virus-verdict: "), F.when(price < 50000, "FAIL").otherwise("PASS"),
        F.lit("\nX-SES-Spam-Verdict: "), F.when(price > 400000, "FAIL").otherwise("PASS"),
        F.lit("\nReceived-SPF: "), F.when(pr == "3-MEDIUM", "fail (no)").otherwise("pass (yes)\n more"),
        F.when(lost_sender, "").otherwise(F.concat(F.lit("\nFrom: "), sender)),
        F.lit("\nDate: "), date, F.when(unfinished, "").otherwise("\n\nFrom: not@a.header\n\nbody\n"),
    )
    return table(spark, folder, "orders").select(F.col("o_orderkey").alias("orderkey"), text.alias("text"))


@query(_VERDICT_SQL + """
SELECT orderkey, coalesce(parse_error, trust) AS verdict,
       CASE WHEN coalesce(parse_error, trust) = 'trusted'
            THEN 'sources/' || strftime(day, '%Y/%m/%d') || '/ffis.org/raw.eml' END AS mail_key
FROM m
""")
def mail_trust(spark, folder):
    """Verdict and landing key of every mail; the key keeps the sender's own day."""
    return receive_mail(_mails(spark, folder), _ALLOW).select("orderkey", "verdict", "mail_key")


@query(_VERDICT_SQL + """
SELECT coalesce(parse_error, trust) AS verdict, count(*) AS mails FROM m GROUP BY ALL
""")
def mail_trust_table(spark, folder):
    """The same with the allow-list as a table."""
    allow = spark.createDataFrame([(e,) for e in _ALLOW], "entry string")
    judged = classify_mail(parse_mail(_mails(spark, folder)), allow)
    return judged.groupBy("verdict").agg(F.count(F.lit(1)).alias("mails"))


@query("""
SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'no_plaintext' ELSE 'ok' END AS status,
       CASE WHEN role <> 'system' THEN replace(text, chr(13) || chr(10), chr(10)) END AS plain
FROM conversations
""")
def mail_plain_part(spark, folder):
    """Turns as mails: users write plain text first, assistants quoted-printable after HTML."""
    text = F.col("text")
    html = F.concat(F.lit("--=b1\nContent-Type: text/html\n\n<p>"), text, F.lit("</p>\n"))
    plain = F.concat(F.lit("--=b1\nContent-Type: text/plain; charset=\"UTF-8\"\n\n"), text, F.lit("\n"))
    quoted = F.concat(
        F.lit("--=b1\nContent-Type: text/plain\nContent-Transfer-Encoding: quoted-printable\n\n"),
        F.regexp_replace(F.replace(text, F.lit("="), F.lit("=3D")), r"^(.{5})", "$1=\n"), F.lit("\n"),
    )
    parts = (
        F.when(F.col("role") == "user", F.concat(plain, html))
        .when(F.col("role") == "assistant", F.concat(html, quoted)).otherwise(html)
    )
    mail = F.concat(
        F.lit("From: a@b.c\nContent-Type: multipart/alternative;\n boundary=\"=b1\"\n\npreamble\n"),
        parts, F.lit("--=b1--\n"),
    )
    part = plain_part(mail)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", part["status"].alias("status"), part["text"].alias("plain")
    )


@query("""
WITH n AS (SELECT page_id, regexp_extract_all(html, 'href="/th[^"]*"') AS found FROM pages)
SELECT page_id, CASE len(found) WHEN 0 THEN 'none' WHEN 1 THEN 'url' ELSE 'multiple' END AS status,
       CASE WHEN len(found) = 1 THEN found[1] END AS url
FROM n
""")
def url_cardinality(spark, folder):
    found = extract_one(F.col("html"), 'href="/th[^"]*"')
    return table(spark, folder, "pages").select(
        "page_id", found["status"].alias("status"), found["url"].alias("url")
    )


@query("""
SELECT page_id,
       CASE WHEN NOT starts_with(url, 'https://') THEN 'none' WHEN contains(url, '?') THEN 'multiple' ELSE 'url'
       END AS status,
       CASE WHEN starts_with(url, 'https://') AND NOT contains(url, '?') THEN
         '{"sourceFileKey":"sources/' || page_id || '/ffis.org/raw.eml","downloadUrl":"' || url || '"}' END AS message,
       CASE WHEN starts_with(url, 'https://') AND NOT contains(url, '?') THEN
         'sources/' || page_id || '/ffis.org/download.xlsx' END AS download_key
FROM pages
""")
def download_messages(spark, folder):
    """Pages as mails that link to themselves once, or twice when the address has a query."""
    url = F.col("url")
    link = F.concat(F.lit("<"), url, F.lit(">\n"))
    mail = F.concat(
        F.lit("Content-Type: multipart/alternative; boundary=zz\n\n--zz\nContent-Type: text/plain\n\nHere:\n"),
        link, F.when(F.instr(url, "?") > 0, link).otherwise(""),
        F.lit("\n--zz\nContent-Type: text/html\n\n"), F.col("html"), F.lit("\n--zz--\n"),
    )
    mails = table(spark, folder, "pages").select(
        "page_id", mail.alias("text"),
        F.concat(F.lit("sources/"), F.col("page_id"), F.lit("/ffis.org/raw.eml")).alias("mail_key"),
    )
    return download_requests(mails, pattern=r"https://[^>\s]+").select(
        "page_id", "status", "message", "download_key"
    )
