"""Date parsing rules. Dirty text becomes NULL, never an error."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def mmddyyyy(c: Column) -> Column:
    """Eight digits, month first, real calendar day."""
    return F.when(F.length(c) == 8, F.try_to_date(c, "MMddyyyy"))


def text_date(c: Column, layout: str) -> Column:
    return mmddyyyy(c) if layout == "MMddyyyy" else F.try_to_date(c, layout)


def fiscal_year(c: Column) -> Column:
    return F.when(c.rlike(r"^[0-9]{4}\z"), F.make_date(c.try_cast("int"), F.lit(1), F.lit(1)))


def iso_date(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd")


def due_date(c: Column) -> Column:
    """``5-11-23`` or ``5/11/23``; years 69 to 99 belong to the 1900s."""
    day = F.coalesce(F.try_to_date(c, "M-d-yy"), F.try_to_date(c, "M/d/yy"))
    return F.when(F.year(day) >= 2069, F.add_months(day, -1200)).otherwise(day)


def long_date(c: Column) -> Column:
    """``January 2, 2006``."""
    return F.try_to_date(c, "MMMM d, yyyy")


def is_set(c: Column) -> Column:
    return F.coalesce(c, F.lit("")) != ""
