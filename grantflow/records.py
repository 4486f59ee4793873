"""What an operator needs to know about a kind of record."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantflow import schemas


@dataclass(frozen=True)
class RecordSpec:
    """Key, freshness date and the attributes a record writes.

    ``carried`` names groups of attributes that only some records carry, each with its condition;
    a record that does not carry an attribute leaves the stored value alone.
    """

    key: str
    attrs: tuple[str, ...]
    date_col: str | None = None
    date_format: str = "MMddyyyy"
    revision: str = "revision"
    carried: dict[str, tuple[Column, tuple[str, ...]]] = field(default_factory=dict)

    def group_of(self, attr: str) -> str | None:
        return next((name for name, (_, attrs) in self.carried.items() if attr in attrs), None)


def registry_spec() -> RecordSpec:
    is_forecast = F.col("is_forecast")
    return RecordSpec(
        key="grant_id",
        attrs=("is_forecast", *schemas.REGISTRY_FIELDS),
        date_col="LastUpdatedDate",
        carried={
            "synopsis": (~is_forecast, tuple(schemas.SYNOPSIS_ONLY)),
            "forecast": (is_forecast, tuple(schemas.FORECAST_ONLY)),
        },
    )


def sheet_spec() -> RecordSpec:
    return RecordSpec(key="grant_id", attrs=("Bill",))
