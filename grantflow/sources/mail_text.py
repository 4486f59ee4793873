"""Mail messages, one row per file, and what their headers say."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grantflow.frames import settled
from grantflow.functions import mail


def read_mail(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("path"), F.col("value").alias("text")
    )


def parse_mail(df: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds sender, sent_at, sent_day, the verdict headers and parse_error.

    Errors are judged in order: message, sender, date.
    """
    head = F.col("_head")
    out = df.withColumn("_head", mail.head(F.col(text_col)))
    out = out.select(
        *df.columns,
        mail.is_message(head).alias("_ok"),
        settled(mail.sender(mail.header(head, "From"))).alias("sender"),
        mail.sent_at(mail.header(head, "Date")).alias("sent_at"),
        mail.sent_day(mail.header(head, "Date")).alias("sent_day"),
        mail.header(head, "Received-SPF").alias("spf"),
        mail.header(head, "X-SES-Spam-Verdict").alias("spam"),
        mail.header(head, "X-SES-Virus-Verdict").alias("virus"),
    )
    error = (
        F.when(~F.col("_ok"), "message")
        .when(F.col("sender").isNull(), "sender")
        .when(F.col("sent_at").isNull(), "date")
    )
    return out.withColumn("parse_error", error).drop("_ok")
