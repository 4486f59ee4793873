"""Rules of a canonical document, and the optional source facets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from grantflow import dims
from grantflow.functions.dates import is_set
from grantflow.functions.numbers import is_cfda
from grantflow.functions.ulid import ZERO
from grantflow.operators.lookup import agrees

EVENT_TYPES = ("create", "update", "delete")


def _each(entries: Column, is_bad, code: str) -> Column:
    bad = F.filter(F.coalesce(entries, F.array()), is_bad)
    return F.transform(bad, lambda _: F.lit(code))


def grant_errors(grant: Column) -> Column:
    """Every broken rule, one entry per offending list element; empty when valid."""
    opp = grant["opportunity"]
    single = F.array_compact(F.array(
        F.when(~agrees(opp["category"], dims.CATEGORY), "invalid_opportunity_category"),
        F.when(opp["milestones"]["post_date"].isNull(), "missing_post_date"),
        F.when(~is_set(opp["id"]), "empty_id"),
        F.when(~is_set(opp["number"]), "empty_number"),
        F.when(~is_set(opp["title"]), "empty_title"),
        F.when(opp["last_updated"].isNull(), "missing_last_updated"),
        F.when(~F.coalesce(grant["revision"]["id"] > ZERO, F.lit(False)), "empty_revision"),
    ))
    return F.concat(
        single,
        _each(grant["funding_activity"]["categories"],
              lambda e: ~agrees(e, dims.ACTIVITY), "invalid_activity_category"),
        _each(grant["cfda_numbers"],
              lambda c: ~F.coalesce(is_cfda(c), F.lit(False)), "invalid_cfda_number"),
        _each(grant["eligible_applicants"],
              lambda e: ~agrees(e, dims.APPLICANT), "invalid_applicant"),
        _each(grant["funding_instrument_types"],
              lambda e: ~agrees(e, dims.INSTRUMENT), "invalid_instrument"),
    )


def event_errors(kind: Column, previous: Column, new: Column) -> Column:
    """Errors of both versions and of the event type."""
    nothing = F.array().cast("array<string>")
    return F.concat(
        F.when(previous.isNotNull(), grant_errors(previous)).otherwise(nothing),
        F.when(new.isNotNull(), grant_errors(new)).otherwise(nothing),
        F.when(F.coalesce(kind.isin(*EVENT_TYPES), F.lit(False)), nothing)
        .otherwise(F.array(F.lit("unknown_type"))),
    )


@dataclass(frozen=True)
class Facet:
    """Documented limits of a source field; the pattern must match the whole text."""

    field: str
    max_length: int | None = None
    min_length: int | None = None
    pattern: str | None = None


_DAY = r"(0[1-9]|1[012])(0[1-9]|[12][0-9]|3[01])\d\d\d\d"
# Limits published with the extract's schema.
REGISTRY_FACETS = [
    Facet("OpportunityID", pattern=r"[0-9]{1,20}"),
    Facet("OpportunityTitle", pattern=r"[^\s].{0,254}"),
    Facet("OpportunityNumber", max_length=40),
    Facet("OpportunityCategory", max_length=20),
    Facet("OpportunityCategoryExplanation", max_length=255),
    Facet("FundingInstrumentType", max_length=2),
    Facet("CategoryOfFundingActivity", max_length=3),
    Facet("CategoryExplanation", max_length=2500),
    Facet("CFDANumbers", pattern=r"[0-9]{2}[\.][0-9]{3}"),
    Facet("EligibleApplicants", max_length=2),
    Facet("AdditionalInformationOnEligibility", max_length=4000),
    Facet("AgencyCode", min_length=1, max_length=255),
    Facet("AgencyName", min_length=1, max_length=255),
    Facet("PostDate", pattern=_DAY),
    Facet("CloseDate", pattern=_DAY),
    Facet("CloseDateExplanation", max_length=4000),
    Facet("LastUpdatedDate", pattern=_DAY),
    Facet("EstimatedSynopsisPostDate", pattern=_DAY),
    Facet("FiscalYear", pattern=r"[0-9]*", max_length=4),
    Facet("EstimatedSynopsisCloseDate", pattern=_DAY),
    Facet("EstimatedSynopsisCloseDateExplanation", max_length=4000),
    Facet("EstimatedAwardDate", pattern=_DAY),
    Facet("EstimatedProjectStartDate", pattern=_DAY),
    Facet("AwardCeiling", pattern=r"none|[0-9]{1,15}"),
    Facet("AwardFloor", pattern=r"[0-9]{1,15}"),
    Facet("EstimatedTotalProgramFunding", pattern=r"[0-9]*", max_length=15),
    Facet("ExpectedNumberOfAwards", pattern=r"[0-9]*", max_length=15),
    Facet("Description", max_length=18000),
    Facet("Version", max_length=20),
    Facet("CostSharingOrMatchingRequirement", max_length=3),
    Facet("ArchiveDate", pattern=_DAY),
    Facet("AdditionalInformationURL", max_length=250),
    Facet("AdditionalInformationText", max_length=250),
    Facet("GrantorContactEmail", max_length=130),
    Facet("GrantorContactEmailDescription", max_length=102),
    Facet("GrantorContactText", max_length=2500),
    Facet("GrantorContactName", max_length=2500),
    Facet("GrantorContactPhoneNumber", max_length=100),
]


def _breaks(c: Column, facet: Facet) -> Column:
    bad = F.lit(False)
    if facet.max_length is not None:
        bad = bad | (F.length(c) > facet.max_length)
    if facet.min_length is not None:
        bad = bad | (F.length(c) < facet.min_length)
    if facet.pattern is not None:
        bad = bad | ~c.rlike(rf"^(?:{facet.pattern})\z")
    return bad


def facet_errors(get, facets: list[Facet], list_fields=frozenset()) -> Column:
    """Names of fields outside their documented limits; blank text counts as absent."""
    def check(facet: Facet) -> Column:
        c = get(facet.field)
        if facet.field in list_fields:
            bad = F.exists(F.coalesce(c, F.array()), lambda e: _breaks(e, facet))
        else:
            bad = is_set(c) & _breaks(c, facet)
        return F.when(bad, facet.field)

    return F.array_compact(F.array(*[check(f) for f in facets]))
