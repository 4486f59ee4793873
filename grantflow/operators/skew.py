"""Joins and running values that stay balanced when one key holds a third of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# A key with fewer rows than this fits one task.
HOT_ROWS = 1_000_000
# At most this many keys are treated as hot, so the list is small whatever the input size.
# Keys beyond it take the ordinary path, where adaptive skew handling still splits them.
HOT_KEYS = 1_000
SALTS = 256
BLOCK_ROWS = 65_536


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_ROWS) -> DataFrame:
    """The most frequent keys, at most ``HOT_KEYS`` of them; counts combine before the shuffle."""
    return (
        df.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
        .where((F.col("_n") >= min_rows) & F.col(key).isNotNull())
        .orderBy(F.desc("_n"), key).limit(HOT_KEYS).select(key)
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    how: str = "left",
    hot: DataFrame | None = None,
    salts: int = SALTS,
) -> DataFrame:
    """Join many rows to a side that is unique on ``key``.

    Without ``hot`` the adaptive skew join splits a heavy key of the left side at run time. With
    ``hot`` (from ``hot_keys``) those keys are spread over ``salts`` tasks up front: a left row
    takes a salt from a hash of its columns, so that clustered rows of a key spread as well, and the one
    matching right row is repeated for every salt. Other keys keep a single salt, so the right
    side grows by at most ``HOT_KEYS * salts`` rows.
    """
    if hot is None:
        return left.join(right, key, how)
    flagged = F.broadcast(hot.withColumn("_hot", F.lit(True)))
    many = left.join(flagged, key, "left").withColumn(
        "_salt",
        F.when(F.col("_hot"), F.pmod(F.xxhash64(*[c for c in left.columns]), F.lit(salts))).otherwise(F.lit(0)),
    )
    one = right.join(flagged, key, "left").withColumn(
        "_salt",
        F.explode(
            F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(salts - 1)))
            .otherwise(F.array(F.lit(0)))
        ),
    )
    joined = many.drop("_hot").join(one.drop("_hot"), [key, "_salt"], how)
    return joined.drop("_salt")


def running(
    df: DataFrame,
    group: list[str],
    pos: str,
    values: dict[str, tuple[str, Column]],
    block: Column | None = None,
    levels: int = 2,
    inclusive: bool = True,
) -> DataFrame:
    """Running value per group in order of ``pos``, without a whole group in one task.

    ``values`` names outputs as (kind, column) with kind ``last`` or ``first`` (of the non-null
    values so far) or ``sum``. Rows are ordered inside blocks of positions; only one summary row
    per block is carried across blocks, and the summaries are handled the same way one level up.
    ``pos`` must be a whole number unless ``block`` gives the block of a row.
    """
    names = list(values)
    held = {n: f"_v_{n}" for n in names}
    # one struct as the group key, so that NULL groups meet in the join below
    work = df.withColumn("_grp", F.struct(*group)) if group != ["_grp"] else df
    group = ["_grp"]
    for n in names:
        work = work.withColumn(held[n], values[n][1])
    if levels == 0:
        out = _windowed(work, group, pos, values, held, names, inclusive)
        return out.select(*df.columns, *names)

    blk = f"_blk{levels}"
    if block is None:
        block = F.floor(F.col(pos) / F.lit(BLOCK_ROWS))
    work = work.withColumn(blk, block)
    local = {n: f"_l_{n}" for n in names}
    inside = _windowed(work, [*group, blk], pos, values, held, names, inclusive)
    for n in names:
        inside = inside.withColumnRenamed(n, local[n])
    inside = inside.drop(*held.values())

    totals = work.groupBy(*group, blk).agg(
        *[_total(values[n][0], F.col(held[n]), F.col(pos)).alias(f"_t_{n}") for n in names]
    )
    before = running(
        totals, group, blk,
        {f"_c_{n}": (values[n][0], F.col(f"_t_{n}")) for n in names},
        levels=levels - 1, inclusive=False,
    ).select(*group, blk, *[f"_c_{n}" for n in names])

    joined = inside.join(before, [*group, blk], "left")
    result = [
        _combined(values[n][0], F.col(f"_c_{n}"), F.col(local[n])).alias(n) for n in names
    ]
    return joined.select(*df.columns, *result)


def _windowed(df, group, pos, values, held, names, inclusive):
    frame = Window.partitionBy(*group).orderBy(pos).rowsBetween(
        Window.unboundedPreceding, 0 if inclusive else -1
    )
    for n in names:
        kind, c = values[n][0], F.col(held[n])
        if kind == "last":
            out = F.last(c, ignorenulls=True).over(frame)
        elif kind == "first":
            out = F.first(c, ignorenulls=True).over(frame)
        elif kind == "sum":
            out = F.coalesce(F.sum(c).over(frame), F.lit(0))
        else:
            raise ValueError(f"unknown running value {kind!r}")
        df = df.withColumn(n, out)
    return df


def _total(kind: str, c: Column, pos: Column) -> Column:
    if kind == "sum":
        return F.sum(c)
    at = F.when(c.isNotNull(), pos)
    return F.max_by(c, at) if kind == "last" else F.min_by(c, at)


def _combined(kind: str, before: Column, here: Column) -> Column:
    if kind == "sum":
        return F.coalesce(before, F.lit(0)) + here
    return F.coalesce(here, before) if kind == "last" else F.coalesce(before, here)
