"""CFDA numbers, amounts, award counts and yes/no flags."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Shapes of a catalogue number, loose (sheet cell) and strict (canonical).
CFDA_CELL = r"^([0-9]{1,2}\.[0-9]{0,3})\+?\z"
CFDA_STRICT = r"^[0-9]{2}\.[0-9]{3}\z"
INTEGER = r"^[+-]?[0-9]+\z"


def is_cfda_cell(c: Column) -> Column:
    return c.rlike(CFDA_CELL)


def is_cfda(c: Column) -> Column:
    return c.rlike(CFDA_STRICT)


def cfda_number(c: Column) -> Column:
    """``2.98`` -> ``02.980``; a trailing plus sign is dropped."""
    number = F.regexp_replace(c, r"\++\z", "").try_cast("double")
    return F.when(is_cfda_cell(c), F.format_string("%06.3f", number))


def strict_bigint(c: Column) -> Column:
    return F.when(c.rlike(INTEGER), c.try_cast("bigint"))


def amount(c: Column) -> Column:
    """Funding amount; anything that is not a whole number counts as 0."""
    return F.coalesce(F.when(c != "N/A", strict_bigint(c)), F.lit(0).cast("bigint"))


def amount_is_bad(c: Column) -> Column:
    return F.coalesce((c != "N/A") & strict_bigint(c).isNull(), F.lit(False))


def award_count(c: Column) -> Column:
    """Whole number from 0 up; NULL when blank or malformed."""
    n = strict_bigint(c)
    return F.when(n >= 0, n)


def yes_no(c: Column) -> Column:
    text = F.lower(c)
    return F.when(text == "yes", True).when(text == "no", False)


def x_mark(c: Column) -> Column:
    return c.eqNullSafe(F.lit("X"))
