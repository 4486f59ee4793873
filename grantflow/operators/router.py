"""Which step handles a new object."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (prefix, suffix, step).
LANDING_ROUTES = [
    ("sources/", "/grants.gov/archive.zip", "extract_registry"),
    ("sources/", "/grants.gov/extract.xml", "split_registry"),
    ("sources/", "/ffis.org/raw.eml", "enqueue_sheet_download"),
    ("sources/", "/ffis.org/download.xlsx", "split_sheet"),
]
PREPARED_ROUTES = [
    ("", "/grants.gov/v2.xml", "persist_registry"),
    ("", "/grants.gov/v2.OpportunitySynopsisDetail_1_0.xml", "persist_registry"),
    ("", "/grants.gov/v2.OpportunityForecastDetail_1_0.xml", "persist_registry"),
    ("", "/ffis.org/v1.json", "persist_sheet"),
]


def route(path: Column, routes=None) -> Column:
    """Step for an object key; NULL when no step takes it."""
    step = F.lit(None).cast("string")
    for prefix, suffix, name in reversed(routes or LANDING_ROUTES + PREPARED_ROUTES):
        step = F.when(path.startswith(prefix) & path.endswith(suffix), name).otherwise(step)
    return step
