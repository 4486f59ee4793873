"""Sortable 26-character revision ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The base-32 digits of the id format, and the ones Spark's conv() uses.
ALPHABET = "0123456789ABCDEFGHJKMNPQRSTVWXYZ"
CONV_DIGITS = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
ZERO = "0" * 26
SHAPE = r"^[0-7][0-9A-HJKMNP-TV-Z]{25}\z"


def is_ulid(c: Column) -> Column:
    return F.coalesce(F.upper(c).rlike(SHAPE), F.lit(False))


def ulid_millis(c: Column) -> Column:
    """Milliseconds since 1970 held in the first ten characters."""
    digits = F.translate(F.substring(F.upper(c), 1, 10), ALPHABET, CONV_DIGITS)
    return F.when(is_ulid(c), F.conv(digits, 32, 10).cast("bigint"))


def ulid_time(c: Column) -> Column:
    return F.timestamp_millis(ulid_millis(c))


def _base32(number: Column, base: int, width: int) -> Column:
    digits = F.lpad(F.conv(number, base, 32), width, "0")
    return F.translate(digits, CONV_DIGITS, ALPHABET)


def ulid_prefix(millis: Column) -> Column:
    """The ten time characters of an id."""
    return _base32(millis.cast("string"), 10, 10)


def revision_id(millis: Column, *payload: Column) -> Column:
    """Id for a change: batch time, then 80 bits of a digest of what was written.

    The same batch and payload always give the same id, so a replay writes no new revision.
    """
    digest = F.sha2(F.to_json(F.struct(*[p.alias(f"c{i}") for i, p in enumerate(payload)])), 256)
    halves = [_base32(F.substring(digest, at, 10), 16, 8) for at in (1, 11)]
    return F.concat(ulid_prefix(millis), *halves)
