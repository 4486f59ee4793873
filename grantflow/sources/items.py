"""Prepared table: one current row per grant, kept as a base and deltas."""

from __future__ import annotations

import re
import uuid
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from grantflow import schemas
from grantflow.functions.keys import id_prefix
from grantflow.sources import manifest

TYPED_ITEM = (
    "map<string, struct<S: string, N: string, B: string, L: array<struct<S: string, N: string>>,"
    " BOOL: boolean, `NULL`: boolean>>"
)


def decode_item(json_col: Column) -> Column:
    """Typed-attribute JSON (``{"Name": {"S": "text"}}``) as a map."""
    return F.from_json(json_col, TYPED_ITEM)


def item_struct(item: Column) -> Column:
    """Prepared-row image of a decoded item, with ``unbuildable`` set when a list holds no list."""
    def text(name: str) -> Column:
        attr = item[name]
        return F.coalesce(attr["S"], attr["N"], attr["B"], attr["BOOL"].cast("string"))

    fields, bad = [], F.lit(False)
    for f in schemas.PREPARED.fields:
        attr = item[f.name]
        if f.name in schemas.LIST_FIELDS:
            is_null = F.coalesce(attr["NULL"], F.lit(False))
            bad = bad | (attr.isNotNull() & attr["L"].isNull() & ~is_null)
            value = F.transform(attr["L"], lambda e: F.coalesce(e["S"], e["N"]))
        elif f.name == "is_forecast":
            value = attr["BOOL"]
        else:
            value = text(f.name)
        fields.append(value.alias(f.name))
    return F.struct(*fields, bad.alias("unbuildable"))


_MARK = "version long, kind string, writer string, batch long"
OP, OLD = "_op", "_old"  # of a delta's rows: what happened to the key, and its row before
PRUNED = 2000  # id prefixes that a read is narrowed to, at most
FANOUT = 8  # deltas of a level that are merged into one of the next


def marks(spark: SparkSession, root: str) -> DataFrame:
    """One small row per commit: version, kind (base, delta or merge), and who wrote it (stream or run, batch)."""
    try:
        return spark.read.schema(_MARK).option("recursiveFileLookup", "true").json(f"{root}/{manifest.COMMITS}")
    except AnalysisException:
        return spark.createDataFrame([], _MARK)


def commits(spark: SparkSession, root: str) -> list[int]:
    """Committed snapshot numbers, oldest first."""
    return list(manifest.versions(manifest.Files(spark, root)))


def written(spark: SparkSession, root: str, writer: str, batch: int) -> bool:
    """Whether this writer has committed this batch, or a later one; batch numbers and versions are different things."""
    last = manifest.newest(manifest.Files(spark, root))
    return last is not None and last.writers.get(writer, -1) >= batch


def prefix_of(key: Column) -> Column:
    return F.coalesce(id_prefix(key), F.lit("short"))


def prefixes_of(batch: DataFrame, key: str = "grant_id") -> list[str] | None:
    """The id prefixes of a batch, sorted; None where they are too many for a read to be narrowed to them."""
    found = batch.select(prefix_of(F.col(key).cast("string")).alias("p")).distinct().limit(PRUNED + 1).collect()
    return None if len(found) > PRUNED else sorted(r.p for r in found)


def current_rows(base: DataFrame, deltas: DataFrame, key: str, version: str = "_version") -> DataFrame:
    """The newest row of each key: rows of ``deltas`` (with their ``_version``) before those of ``base``.

    The base is only filtered by the keys of the deltas, never shuffled for an order.
    """
    newest = Window.partitionBy(key).orderBy(F.desc(version))
    changed = deltas.withColumn("_n", F.row_number().over(newest)).where("_n = 1").drop("_n", version)
    return base.join(changed.select(key), key, "left_anti").select(base.columns).unionByName(changed.select(base.columns))


def _full(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("id_prefix", T.StringType())])


def _scan(files: manifest.Files, spark: SparkSession, part: manifest.Part, schema: T.StructType,
          prefixes: list[str] | None) -> DataFrame | None:
    """Rows of a part; of the folders of the wanted prefixes alone, and None if it has none of them."""
    folder = f"{files.root}/{part.folder}"
    reader = spark.read.schema(schema)
    if prefixes is None:
        return reader.parquet(folder)
    held = manifest.part_prefixes(files, part)
    # names of folders as Spark writes them: only plain prefixes can be named from here, others are filtered
    wanted = [p for p in prefixes if p in held]
    if not wanted:
        return None
    if all(re.fullmatch(r"[0-9A-Za-z _.-]+", p) for p in wanted):
        return reader.option("basePath", folder).parquet(*[f"{folder}/id_prefix={p}" for p in wanted])
    return reader.parquet(folder).where(F.col("id_prefix").isin(wanted))


def _merged(files: manifest.Files, spark: SparkSession, parts: list[manifest.Part], schema: T.StructType, key: str,
            prefixes: list[str] | None = None) -> DataFrame:
    scans = [(p, _scan(files, spark, p, schema, prefixes)) for p in parts]
    scans = [(p, s) for p, s in scans if s is not None]
    base = next((s for p, s in scans if p.kind == "base"), None)
    deltas = [s.withColumn("_version", F.lit(p.high)) for p, s in scans if p.kind != "base"]
    start = spark.createDataFrame([], schema) if base is None else base
    return current_rows(start, reduce(DataFrame.unionByName, deltas), key) if deltas else start


def read_snapshot(
    spark: SparkSession, root: str, version: int | None = None,
    schema: T.StructType = schemas.PREPARED, below: int | None = None, key: str = "grant_id",
    prefixes: list[str] | None = None, last: manifest.Commit | None = None,
) -> DataFrame | None:
    """The table as of a commit, the newest by default or the newest ``below`` a number; None when there is none.

    With ``prefixes`` only the folders of these id prefixes are listed and opened, and parts without any of them not at
    all. ``last`` is a commit that has been loaded. The schema is given, not inferred: a prefix like ``012`` is text,
    and a purged snapshot may have no files to infer from.
    """
    files = manifest.Files(spark, root)
    found = last or manifest.newest(files, version, below)
    return None if found is None else _merged(files, spark, found.parts, _full(schema), key, prefixes)


def _hash_sums(value: Column, name: str, sign: int = 1) -> list[Column]:
    """Sums of both halves of a hash: free of order, and far from an overflow."""
    halves = (value.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(value, 32))
    return [F.coalesce(F.sum(h * sign), F.lit(0)).alias(f"{name}{i}") for i, h in enumerate(halves)]


def _write_part(
    df: DataFrame, files: manifest.Files, kind: str, low: int, high: int, level: int, key: str, sums: dict | None = None,
) -> manifest.Part:
    """A folder of its own and the side file about it. A run that fails leaves a folder that no commit names.

    ``sums`` are known for merged parts; else they come from the key and revision columns of what was written: for a
    delta with images those of the new rows less those of the old ones.
    """
    spark = df.sparkSession
    rows = df if "id_prefix" in df.columns else df.withColumn("id_prefix", prefix_of(F.col(key).cast("string")))
    folder = f"part-{high:010d}-{uuid.uuid4().hex[:12]}"
    rows.hint("rebalance", "id_prefix").write.mode("overwrite").partitionBy("id_prefix").parquet(f"{files.root}/{folder}")
    back = spark.read.schema(rows.schema).parquet(f"{files.root}/{folder}")
    images = {OP, OLD} <= set(df.columns)
    identity = ["revision"] if "revision" in df.columns else [c for c in df.columns if c not in (OP, OLD, "id_prefix", key)]
    hashed = lambda prefix: F.xxhash64(F.col(key), *[F.col(f"{prefix}{c}") for c in identity])
    known = kind == "base" or images
    fresh = F.count(F.when(F.col(OP) == "INSERT", 1)) if images else F.count(F.lit(1))
    aggs = [F.count(F.lit(1)).alias("rows"), fresh.alias("fresh")]
    if known:
        aggs += _hash_sums(hashed(""), "new")
        aggs += _hash_sums(F.when(F.col(OP) == "MODIFY", hashed(f"{OLD}.")), "old", -1) if images else []
    prefixes = {}
    for r in back.groupBy("id_prefix").agg(*aggs).collect():  # one small row per prefix, of three characters
        state = [r.fresh, *(r[f"new{i}"] + (r[f"old{i}"] if images else 0) for i in (0, 1))] if known else None
        prefixes[r.id_prefix] = [r["rows"], (sums or {}).get(r.id_prefix, None) if kind == "merge" else state]
    part = manifest.Part(folder, "base" if kind == "base" else "delta", low, high, level, sum(v[0] for v in prefixes.values()))
    manifest.save_part(files, part, prefixes)
    return part


def newest(spark: SparkSession, root: str) -> manifest.Commit | None:
    return manifest.newest(manifest.Files(spark, root))


def next_version(
    spark: SparkSession, root: str, version: int | None = None,
) -> tuple[manifest.Commit | None, int]:
    """The newest commit and the version that follows it; refused where another version was meant."""
    last = newest(spark, root)
    following = (last.version if last else 0) + 1
    if version is not None and version != following:
        raise manifest.CommitConflict(f"version {version} does not follow {following - 1}")
    return last, following


Start = tuple[manifest.Commit | None, int]


def write_snapshot(df: DataFrame, root: str, version: int | None = None, key: str = "grant_id", writer: str | None = None,
                   batch: int | None = None, start: Start | None = None) -> int:
    """The whole table as a new base, as the given version (it must be the next one); gives the version."""
    files = manifest.Files(df.sparkSession, root)
    last, version = start or next_version(df.sparkSession, root, version)
    part = _write_part(df, files, "base", 0, version, 0, key)
    manifest.commit(files, last, manifest.Commit(version, "base", writer, batch, None, [part], {}))
    return version


def write_delta(df: DataFrame, root: str, version: int | None = None, key: str = "grant_id", writer: str | None = None,
                batch: int | None = None, start: Start | None = None) -> int:
    """Only new and changed rows: what is written follows the batch, not the table. Gives the version.

    ``start`` is what ``next_version`` gave before the rows were computed; the commit fails if the table has moved on
    since. Rows may carry ``_op`` and ``_old``, which make the change feed.
    """
    files = manifest.Files(df.sparkSession, root)
    last, version = start or next_version(df.sparkSession, root, version)
    part = _write_part(df, files, "delta", version, version, 0, key)
    changes = part.folder if {OP, OLD} <= set(df.columns) else None
    parts = [*(last.parts if last else []), *([part] if part.rows else [])]
    manifest.commit(files, last, manifest.Commit(version, "delta", writer, batch, changes, parts, {}))
    return version


def _add(a: list | None, b: list | None) -> list | None:
    return None if a is None or b is None else [x + y for x, y in zip(a, b, strict=True)]


def prefix_states(spark: SparkSession, root: str, version: int | None = None) -> dict[str, list | None]:
    """Rows and hash sums of every id prefix of the table as of a commit, from the side files alone; None for a prefix that
    was written without images."""
    files = manifest.Files(spark, root)
    found = manifest.newest(files, version)
    states: dict[str, list | None] = {}
    for part in found.parts if found else []:
        for p, (_, state) in manifest.part_prefixes(files, part).items():
            states[p] = _add(states[p], state) if p in states else state
    return {p: s for p, s in states.items() if s is None or any(s)}


def compact(spark: SparkSession, root: str, schema: T.StructType = schemas.PREPARED, key: str = "grant_id",
            fanout: int = FANOUT) -> int:
    """Merges deltas by levels: ``fanout`` of one level become one of the next, and all become a new base once they hold
    half as many rows as it. So a read opens few parts, and a row is rewritten once per level. Gives the merges done.

    A merge that meets another commit leaves its work: the next call starts from the newer table.
    """
    files = manifest.Files(spark, root)
    done = 0
    while True:
        last = manifest.newest(files)
        deltas = [p for p in last.parts if p.kind == "delta"] if last else []
        full = [lv for lv in sorted({p.level for p in deltas}) if sum(p.level == lv for p in deltas) >= fanout]
        if not full:
            return done
        held = sum(p.rows for p in last.parts if p.kind == "base")
        whole = sum(p.rows for p in deltas) * 2 > held
        chosen = last.parts if whole else [p for p in deltas if p.level == full[0]]
        rows = _merged(files, spark, chosen, _full(schema), key)
        level = 0 if whole else full[0] + 1
        if whole:
            part = _write_part(rows, files, "base", 0, last.version + 1, level, key)
        else:
            sums: dict[str, list | None] = {}
            for p in chosen:
                for prefix, (_, state) in manifest.part_prefixes(files, p).items():
                    sums[prefix] = _add(sums[prefix], state) if prefix in sums else state
            part = _write_part(rows, files, "merge", chosen[0].low, chosen[-1].high, level, key, sums)
        at = last.parts.index(chosen[0])
        parts = [*last.parts[:at], part, *last.parts[at + len(chosen):]]
        try:
            manifest.commit(files, last, manifest.Commit(last.version + 1, "merge", None, None, None, parts, {}))
        except manifest.CommitConflict:
            return done
        done += 1


def vacuum(spark: SparkSession, root: str, keep: int = 100) -> list[str]:
    """Deletes the folders that none of the last ``keep`` commits names, and the commits before them; gives the folders.

    Work of a run that is under way isn't named yet: call this from the table's own writer, between its batches.
    """
    files = manifest.Files(spark, root)
    known = list(manifest.versions(files))
    named = set()
    for version in known[-keep:]:
        commit = manifest.load(files, version)
        named |= {p.folder for p in commit.parts} | {commit.changes}
    gone = [n for n in files.names("") if n.startswith("part-") and n not in named]
    for version in known[:-keep]:
        manifest.forget(files, version)
    for folder in gone:
        files.delete(folder)
        files.delete(f"{manifest.PARTS}/{folder}.json")
    return gone


def read_changes(
    spark: SparkSession, root: str, versions: list[int], schema: T.StructType = schemas.PREPARED,
) -> DataFrame:
    """(op, old, new, version) of everything these versions changed, from their deltas: no snapshot is read.

    Bases (a purge) and merges publish nothing.
    """
    files = manifest.Files(spark, root)
    image = T.StructType(schema.fields)
    full = T.StructType([*schema.fields, T.StructField(OP, T.StringType()), T.StructField(OLD, image)])
    empty = spark.createDataFrame([], T.StructType([
        T.StructField("op", T.StringType()), T.StructField("old", image), T.StructField("new", image),
        T.StructField("version", T.LongType())]))
    named = [(v, manifest.load(files, v).changes) for v in versions]
    scans = [
        spark.read.schema(full).parquet(f"{root}/{folder}").select(
            F.col(OP).alias("op"), F.col(OLD).alias("old"), F.struct(*schema.fieldNames()).alias("new"),
            F.lit(v).cast("long").alias("version"))
        for v, folder in named if folder]
    return reduce(DataFrame.unionByName, scans, empty)


def list_objects(spark: SparkSession, path: str, prefix: str | None = None) -> DataFrame:
    """(path, length, modificationTime); file contents are not read."""
    found = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
        .select("path", "length", "modificationTime")
    )
    return found.where(F.col("path").startswith(prefix)) if prefix else found


def objects_without_rows(
    inventory: DataFrame, rows: DataFrame, path: str = "path"
) -> DataFrame:
    """Objects of an inventory table that gave no row: empty files, or files without a record.

    Spark's file readers skip empty files, so these can only be found from an inventory.
    """
    return inventory.join(rows.select(path), path, "left_anti")


def empty_prepared(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], schemas.PREPARED)
