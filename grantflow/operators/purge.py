"""Purge of prepared rows and prepared objects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grantflow.functions import match


def purge_items(
    prepared: DataFrame,
    sheet: bool = False,
    registry: bool = False,
    keep_revision: bool = False,
    everything: bool = False,
    key: str = "grant_id",
    sheet_attrs: tuple[str, ...] = ("Bill",),
    revision: str = "revision",
    dry_run: bool = False,
) -> DataFrame:
    """New snapshot with the purged attributes NULL; ``dry_run`` gives the row count instead."""
    if dry_run:
        return prepared.agg(F.count(F.lit(1)).alias("items"))
    if everything:
        return prepared.where(F.lit(False))

    def stripped(name: str) -> bool:
        if name == key:
            return False
        if name == revision:
            return not keep_revision
        return sheet if name in sheet_attrs else registry

    return prepared.select(*[
        F.lit(None).cast(f.dataType).alias(f.name) if stripped(f.name) else F.col(f.name)
        for f in prepared.schema.fields
    ])


def purge_matchers(
    sheet: bool = False, registry: bool = False, everything: bool = False,
    regexes: tuple[str, ...] = (), globs: tuple[str, ...] = (),
) -> list[match.Matcher]:
    if everything:
        return [match.all_keys]
    chosen = ([match.sheet_keys] if sheet else []) + ([match.registry_keys] if registry else [])
    chosen += [match.regex_matcher(r) for r in regexes] + [match.glob_matcher(g) for g in globs]
    if not chosen:
        raise ValueError("at least one matcher is required")
    return chosen


def match_paths(
    paths: DataFrame, matchers: list[match.Matcher], prefix: str = "", path: str = "path"
) -> DataFrame:
    return paths.where(match.any_of(F.col(path), matchers, prefix))


def purge_paths(df: DataFrame, matches: DataFrame, path: str = "path") -> DataFrame:
    """What is left after removing the matched objects."""
    return df.join(matches.select(path), path, "left_anti")
