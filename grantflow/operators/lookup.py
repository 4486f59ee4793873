"""Code and name lookups against small fixed dimensions, and against dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow.dims import inverse, map_column


def code_to_struct(code: Column, codes: dict[str, str]) -> Column:
    """struct(name, code); an unknown code keeps its code and has a blank name."""
    name = F.coalesce(F.try_element_at(map_column(codes), code), F.lit(""))
    return F.struct(name.alias("name"), code.alias("code"))


def codes_to_structs(code_list: Column, codes: dict[str, str]) -> Column:
    return F.transform(
        code_list, lambda c: code_to_struct(F.coalesce(c, F.lit("")), codes)
    )


def name_to_struct(name: Column, codes: dict[str, str]) -> Column:
    code = F.coalesce(F.try_element_at(map_column(inverse(codes)), name), F.lit(""))
    return F.struct(name.alias("name"), code.alias("code"))


def is_known(code: Column, codes: dict[str, str]) -> Column:
    return F.try_element_at(map_column(codes), code).isNotNull()


def agrees(entry: Column, codes: dict[str, str]) -> Column:
    """Name and code of an entry belong together."""
    name = F.try_element_at(map_column(codes), F.coalesce(entry["code"], F.lit("")))
    return F.coalesce(name == entry["name"], F.lit(False))


def lookup_code(
    df: DataFrame, code: str, dim: DataFrame, dim_code: str, dim_name: str
) -> DataFrame:
    """Adds ``name`` (blank when unknown) and ``is_unknown`` from a dimension table.

    No broadcast is forced: Spark broadcasts the table while it is small and shuffles otherwise.
    """
    side = dim.select(
        F.col(dim_code).alias(code), F.col(dim_name).alias("name"), F.lit(True).alias("_hit")
    )
    return (
        df.join(side, code, "left")
        .withColumn("name", F.coalesce("name", F.lit("")))
        .withColumn("is_unknown", F.col("_hit").isNull()).drop("_hit")
    )


def duplicate_names(dim: DataFrame, name: str) -> DataFrame:
    """Names that stand for more than one code; a reverse lookup needs none."""
    return dim.groupBy(name).agg(F.count(F.lit(1)).alias("codes")).where("codes > 1")
