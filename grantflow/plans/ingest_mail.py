"""Mail -> trust verdict -> landing key and download request."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.functions.keys import SHEET_SEGMENT, download_key, landing_key
from grantflow.functions.links import DOWNLOAD_URL, extract_one
from grantflow.functions.mail import plain_part
from grantflow.operators.trust import classify_mail
from grantflow.sources.mail_text import parse_mail


def receive_mail(mail: DataFrame, allow: list[str] | DataFrame) -> DataFrame:
    """Every mail with its verdict; trusted mail also has the key it is stored under."""
    judged = classify_mail(parse_mail(mail), allow)
    key = landing_key(F.col("sent_day"), F.lit(SHEET_SEGMENT), F.lit("raw.eml"))
    return judged.withColumn("mail_key", F.when(F.col("verdict") == "trusted", key))


def download_requests(
    mail: DataFrame, text: str = "text", key: str = "mail_key", pattern: str = DOWNLOAD_URL
) -> DataFrame:
    """Adds ``status``, and for exactly one link the ``message`` and the key to download to.

    status: url, none, multiple, or why there is no plain text.
    """
    out = mail.withColumn("_part", plain_part(F.col(text)))
    out = out.withColumn("_found", extract_one(F.col("_part.text"), pattern))
    status = F.when(F.col("_part.status") != "ok", F.col("_part.status")).otherwise(
        F.col("_found.status")
    )
    out = out.withColumn("status", status)
    message = F.to_json(
        F.struct(F.col(key).alias("sourceFileKey"), F.col("_found.url").alias("downloadUrl"))
    )
    is_url = F.col("status") == "url"
    return (
        out.withColumn("message", F.when(is_url, message))
        .withColumn("download_key", F.when(is_url, download_key(F.col(key))))
        .drop("_part", "_found")
    )
