"""Prepared sheet records stored as JSON documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow import schemas
from grantflow.frames import settled

_CORRUPT = "_corrupt_record"
# the due date is written as midnight UTC
_JSON = T.StructType(
    [
        T.StructField(f.name, T.StringType() if f.name == "due_date" else f.dataType)
        for f in schemas.SHEET.fields
    ]
    + [T.StructField(_CORRUPT, T.StringType())]
)


def required_problem(rec: Column, corrupt: Column, bill: str = "bill", key: str = "grant_id") -> Column:
    """Why a record cannot be used; decode errors come before missing fields."""
    return (
        F.when(corrupt.isNotNull(), "undecodable")
        .when(F.coalesce(rec[bill], F.lit("")) == "", "missing_bill")
        .when(F.coalesce(rec[key], F.lit(0)) == 0, "missing_grant_id")
    )


def decode_sheet_json(df: DataFrame, text_col: str) -> DataFrame:
    """Adds ``rec`` and ``reason``; unknown fields are ignored."""
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    out = df.withColumn("rec", settled(F.from_json(text_col, _JSON, options)))
    corrupt = F.when(F.col("rec").isNull(), F.lit("null")).otherwise(F.col(f"rec.{_CORRUPT}"))
    return out.withColumn("reason", required_problem(F.col("rec"), corrupt))


def read_sheet_json(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records, rejects) over many one-record documents."""
    docs = spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_path").alias("file"), "value"
    )
    out = decode_sheet_json(docs, "value")
    day = F.to_date(F.substring("rec.due_date", 1, 10)).alias("due_date")
    fields = [day if f.name == "due_date" else F.col(f"rec.{f.name}") for f in schemas.SHEET.fields]
    good = out.where(F.col("reason").isNull()).select("file", *fields)
    rejects = out.where(F.col("reason").isNotNull()).select("file", "reason", "value")
    return good, rejects


def to_sheet_json(df: DataFrame) -> DataFrame:
    """Adds ``json``: the stored document of a sheet record."""
    due = F.concat(
        F.coalesce(F.date_format("due_date", "yyyy-MM-dd"), F.lit("0001-01-01")), F.lit("T00:00:00Z")
    ).alias("due_date")
    fields = [due if f.name == "due_date" else F.col(f.name) for f in schemas.SHEET.fields]
    return df.withColumn("json", F.to_json(F.struct(*fields)))
