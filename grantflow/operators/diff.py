"""Change feed from two snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def changed_keys(old: DataFrame, new: DataFrame, key: str, rev: str) -> DataFrame:
    """(key, op) with op INSERT, MODIFY or REMOVE; reads two columns of each snapshot."""
    before = old.select(key, F.col(rev).alias("_old_rev"), F.lit(True).alias("_had"))
    after = new.select(key, F.col(rev).alias("_new_rev"), F.lit(True).alias("_has"))
    op = (
        F.when(F.col("_had").isNull(), "INSERT")
        .when(F.col("_has").isNull(), "REMOVE")
        .when(~F.col("_old_rev").eqNullSafe(F.col("_new_rev")), "MODIFY")
    )
    return (
        before.join(after, key, "full").select(key, op.alias("op")).where(F.col("op").isNotNull())
    )


def diff_snapshots(old: DataFrame, new: DataFrame, key: str, rev: str) -> DataFrame:
    """(key, op, old, new) for every key that differs.

    Wide rows are fetched for the changed keys only, so a small change does not shuffle two
    whole snapshots.
    """
    keys = changed_keys(old, new, key, rev)

    def image(df: DataFrame, name: str, skip: str) -> DataFrame:
        wanted = keys.where(F.col("op") != skip).select(key)
        return df.join(wanted, key, "left_semi").select(key, F.struct(*df.columns).alias(name))

    both = image(old, "old", "INSERT").join(image(new, "new", "REMOVE"), key, "full")
    op = (
        F.when(F.col("old").isNull(), "INSERT").when(F.col("new").isNull(), "REMOVE")
        .otherwise("MODIFY")
    )
    return both.select(key, op.alias("op"), "old", "new")


def changed_prefixes(old: dict[str, list | None], new: dict[str, list | None]) -> list[str]:
    """Id prefixes whose rows may differ between two states of a table (rows and hash sums by prefix)."""
    return sorted(p for p in old.keys() | new.keys() if old.get(p, []) is None or old.get(p) != new.get(p))


def event_type(new: Column, old: Column) -> Column:
    """update, create or delete; NULL when there is neither version."""
    return (
        F.when(new.isNotNull() & old.isNotNull(), "update")
        .when(new.isNotNull(), "create")
        .when(old.isNotNull(), "delete")
    )


def images_for(op: Column, old: Column, new: Column) -> tuple[Column, Column]:
    """(old, new) as far as the kind of change lets them count."""
    return F.when(op.isin("MODIFY", "REMOVE"), old), F.when(op.isin("INSERT", "MODIFY"), new)
