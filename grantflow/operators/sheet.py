"""Sheet rows: header gate, bill headings carried down, typed columns, cell errors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.frames import settled
from grantflow.functions import numbers
from grantflow.functions.dates import due_date
from grantflow.functions.links import link_id
from grantflow.operators.skew import running

HEADER_CELL = "CFDA"


def classify(first_cell: Column) -> Column:
    """header, blank, data or heading."""
    text = F.coalesce(first_cell, F.lit(""))
    return (
        F.when(text == HEADER_CELL, "header")
        .when(text == "", "blank")
        .when(numbers.is_cfda_cell(text), "data")
        .otherwise("heading")
    )


def carry_headings(
    rows: DataFrame, group: str, pos: str, kind: str, heading: str
) -> DataFrame:
    """Data rows after the group's first header row, each with the last heading above it.

    Adds ``bill``: blank until the first heading that follows the header.
    """
    seen = running(
        rows, [group], pos,
        {
            "_first_header": ("first", F.when(F.col(kind) == "header", F.col(pos))),
            "_heading": (
                "last",
                F.when(
                    F.col(kind) == "heading",
                    F.struct(F.col(pos).alias("at"), F.col(heading).alias("text")),
                ),
            ),
        },
    )
    bill = F.when(F.col("_heading.at") > F.col("_first_header"), F.col("_heading.text"))
    return (
        seen.where((F.col(kind) == "data") & F.col("_first_header").isNotNull())
        .withColumn("bill", F.coalesce(bill, F.lit("")))
        .drop("_first_header", "_heading")
    )


def parse_sheet(cells: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(records with a positive grant id, cell errors) from a cells table."""
    cell = lambda i: F.get("cells", F.lit(i))
    rows = cells.where("error IS NULL").withColumn("kind", classify(cell(0)))
    rows = rows.withColumn("heading", cell(0))
    data = carry_headings(rows, "file", "row_idx", "kind", "heading")
    # the link belongs to the number cell; a row without that cell has no link
    grant_id = F.when(F.size("cells") > 5, link_id(F.col("link")))
    data = data.withColumn("grant_id", settled(grant_id))
    typed = data.select(
        "file", "row_idx",
        F.coalesce(cell(2), F.lit("")).alias("opportunity_agency"),
        "bill",
        numbers.cfda_number(cell(0)).alias("cfda"),
        due_date(cell(12)).alias("due_date"),
        F.struct(
            numbers.x_mark(cell(9)).alias("higher_education"),
            numbers.x_mark(cell(7)).alias("local"),
            numbers.x_mark(cell(10)).alias("non_profits"),
            numbers.x_mark(cell(11)).alias("other"),
            numbers.x_mark(cell(6)).alias("state"),
            numbers.x_mark(cell(8)).alias("tribal"),
        ).alias("eligibility"),
        numbers.amount(cell(3)).alias("estimated_funding"),
        F.coalesce(cell(4), F.lit("")).alias("expected_awards"),
        "grant_id",
        numbers.x_mark(cell(13)).alias("match"),
        F.coalesce(cell(5), F.lit("")).alias("opportunity_number"),
        F.coalesce(cell(1), F.lit("")).alias("opportunity_title"),
        F.array_compact(
            F.array(
                F.when(numbers.cfda_number(cell(0)).isNull(), "CFDA"),
                F.when(numbers.amount_is_bad(cell(3)), "EstimatedFunding"),
                F.when(
                    (F.size("cells") > 5) & F.col("link").isNotNull() & F.col("grant_id").isNull(),
                    "GrantID",
                ),
                F.when(cell(12).isNotNull() & due_date(cell(12)).isNull(), "DueDate"),
            )
        ).alias("_targets"),
    )
    errors = typed.select("file", "row_idx", F.explode("_targets").alias("target"))
    return typed.where(F.col("grant_id") > 0).drop("_targets"), errors


def file_errors(cells: DataFrame) -> DataFrame:
    """Workbooks that could not be read."""
    return cells.where("error IS NOT NULL").select("file", "error")
