"""Object keys of the landing and prepared areas."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Path segments of the two sources.
REGISTRY_SEGMENT = "grants.gov"
SHEET_SEGMENT = "ffis.org"
REGISTRY_FILE = {
    False: "v2.OpportunitySynopsisDetail_1_0.xml",
    True: "v2.OpportunityForecastDetail_1_0.xml",
}
SHEET_FILE = "v1.json"


def id_prefix(key: Column) -> Column:
    """First three characters; NULL for shorter ids, which have no place in the layout."""
    return F.when(F.length(key) >= 3, F.substring(key, 1, 3))


def prepared_key(key: Column, segment: Column, file_name: Column) -> Column:
    """NULL for a short id."""
    return F.concat(id_prefix(key), F.lit("/"), key, F.lit("/"), segment, F.lit("/"), file_name)


def registry_key(key: Column, is_forecast: Column) -> Column:
    name = F.when(is_forecast, REGISTRY_FILE[True]).otherwise(REGISTRY_FILE[False])
    return prepared_key(key, F.lit(REGISTRY_SEGMENT), name)


def sheet_key(key: Column) -> Column:
    return prepared_key(key.cast("string"), F.lit(SHEET_SEGMENT), F.lit(SHEET_FILE))


def key_problem(key: Column) -> Column:
    return F.when(F.coalesce(F.length(key), F.lit(0)) < 3, "short_id")


def landing_key(day: Column, segment: Column, file_name: Column) -> Column:
    """``sources/2023/04/22/<segment>/<file>``; ``day`` is already in the sender's zone."""
    return F.concat_ws("/", F.lit("sources"), F.date_format(day, "yyyy/MM/dd"), segment, file_name)


def download_key(mail_key: Column) -> Column:
    """Key of the workbook next to a stored mail; only the first occurrence is replaced."""
    first = r"^(.*?)ffis\.org/raw\.eml"
    return F.regexp_replace(mail_key, first, "$1ffis.org/download.xlsx")


def locator(day: Column, base: Column) -> Column:
    """Download address of the extract of a day."""
    return F.concat(base, F.lit("GrantsDBExtract"), F.date_format(day, "yyyyMMdd"), F.lit("v2.zip"))


def fetch_problem(status: Column, content_type: Column) -> Column:
    """Why a download must not be stored; NULL when it may."""
    return (
        F.when(~status.eqNullSafe(F.lit(200)), "status")
        .when(~content_type.eqNullSafe(F.lit("application/zip")), "content_type")
    )
