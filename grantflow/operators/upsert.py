"""Change-only upsert of a keyed snapshot."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.frames import settled
from grantflow.functions.ulid import revision_id
from grantflow.records import RecordSpec


def any_changed(pairs: list[tuple[Column, Column]]) -> Column:
    """True when one of the (stored, incoming) pairs differs; NULL counts as a value."""
    if not pairs:
        raise ValueError("no attributes to compare")
    return reduce(lambda a, b: a | b, [~old.eqNullSafe(new) for old, new in pairs])


def upsert_changed(
    prev: DataFrame,
    incoming: DataFrame,
    spec: RecordSpec,
    batch_millis: Column | None = None,
    images: bool = False,
) -> DataFrame:
    """New snapshot plus ``changed``; both inputs are unique on the key.

    A record overwrites only the attributes it carries, and only when one of them differs; an
    unknown key becomes a new row. With ``batch_millis`` a changed row gets a new revision id.
    With ``images`` the change feed columns ``op``, ``old`` and ``new`` are added.

    The snapshot side is joined from the left, so a small batch is broadcast and the snapshot is
    never shuffled; the second read for unknown keys touches the key column only.
    """
    key = spec.key
    record = incoming.select(
        key,
        F.struct(
            *[F.col(a) for a in spec.attrs],
            *[cond.alias(f"_carries_{name}") for name, (cond, _) in spec.carried.items()],
        ).alias("_in"),
    )

    groups = {attr: spec.group_of(attr) for attr in spec.attrs}

    def carries(group: str | None) -> Column:
        given = F.col("_in").isNotNull()
        return given if group is None else given & F.col(f"_in._carries_{group}")

    def differs() -> Column:
        """One struct comparison for each group of attributes that come together."""
        parts = []
        for group in dict.fromkeys(groups.values()):
            names = [a for a in spec.attrs if groups[a] == group]
            pair = (F.struct(*names), F.struct(*[F.col(f"_in.{a}").alias(a) for a in names]))
            parts.append(carries(group) & any_changed([pair]))
        return reduce(lambda a, b: a | b, parts)

    def merged(df: DataFrame, is_new: bool) -> DataFrame:
        df = df.withColumn("changed", F.lit(True) if is_new else settled(differs()))
        out = []
        for name in prev.columns:
            if name in spec.attrs:
                value = F.when(carries(groups[name]), F.col(f"_in.{name}")).otherwise(F.col(name))
            elif name == spec.revision and batch_millis is not None:
                fresh = revision_id(batch_millis, F.col(key), F.col("_in"))
                value = F.when(F.col("changed"), fresh).otherwise(F.col(name))
            else:
                value = F.col(name)
            out.append(value.alias(name))
        if images:
            before = F.lit(None).cast(prev.schema) if is_new else F.struct(*prev.columns)
            op = F.when(F.col("changed"), "INSERT" if is_new else "MODIFY")
            after = F.struct(*out)
            return df.select(
                *out, "changed", op.alias("op"),
                F.when(F.col("changed"), before).alias("old"),
                F.when(F.col("changed"), after).alias("new"),
            )
        return df.select(*out, "changed")

    kept = merged(prev.join(record, key, "left"), is_new=False)
    known = prev.select(key).join(record.select(key), key, "left_semi")
    unknown = record.join(known, key, "left_anti")
    blank = [
        F.lit(None).cast(f.dataType).alias(f.name) for f in prev.schema.fields if f.name != key
    ]
    added = merged(unknown.select("*", *blank), is_new=True)
    return kept.unionByName(added)


def upsert_delta(
    prev: DataFrame, incoming: DataFrame, spec: RecordSpec, batch_millis: Column | None = None, images: bool = False,
) -> DataFrame:
    """The new and changed rows alone: the table is filtered by the keys of the batch before anything is compared."""
    touched = prev.join(incoming.select(spec.key), spec.key, "left_semi").select(prev.columns)
    return upsert_changed(touched, incoming, spec, batch_millis, images).where("changed")


def change_feed(upserted: DataFrame) -> DataFrame:
    """(op, old, new) rows of an upsert made with ``images``."""
    return upserted.where("changed").select("op", "old", "new")


def feed_rows(upserted: DataFrame, columns: list[str]) -> DataFrame:
    """The rows to store of an upsert made with ``images``, with what happened to each and its row before."""
    return upserted.where("changed").select(*columns, F.col("op").alias("_op"), F.col("old").alias("_old"))
