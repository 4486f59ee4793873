"""Prepared row -> canonical grant document, with a list of malformed fields."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grantflow import dims
from grantflow.functions import numbers
from grantflow.functions.dates import is_set, iso_date, mmddyyyy
from grantflow.functions.ulid import ZERO, is_ulid, ulid_time
from grantflow.operators.lookup import code_to_struct, codes_to_structs, is_known

Getter = Callable[[str], Column]
_DATES = ("LastUpdatedDate", "PostDate", "ArchiveDate", "CloseDate")
_CODE_LISTS = (
    ("EligibleApplicants", dims.APPLICANT),
    ("CategoryOfFundingActivity", dims.ACTIVITY),
    ("FundingInstrumentType", dims.INSTRUMENT),
)


def _text(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def canonical_grant(get: Getter) -> Column:
    """Nested document; blank text is NULL, nested structs are never NULL."""
    t = lambda name: _text(get(name))
    day = lambda name: mmddyyyy(get(name))
    revision = F.coalesce(F.when(is_ulid(get("revision")), F.upper(get("revision"))), F.lit(ZERO))
    category = code_to_struct(F.coalesce(get("OpportunityCategory"), F.lit("")), dims.CATEGORY)
    return F.struct(
        codes_to_structs(get("FundingInstrumentType"), dims.INSTRUMENT).alias("funding_instrument_types"),
        numbers.yes_no(get("CostSharingOrMatchingRequirement")).alias("cost_sharing_or_matching_requirement"),
        get("CFDANumbers").alias("cfda_numbers"),
        t("Bill").alias("bill"),
        codes_to_structs(get("EligibleApplicants"), dims.APPLICANT).alias("eligible_applicants"),
        F.struct(
            t("AdditionalInformationOnEligibility").alias("eligibility"),
            t("AdditionalInformationText").alias("text"),
            t("AdditionalInformationURL").alias("url"),
        ).alias("additional_information"),
        F.struct(t("AgencyName").alias("name"), t("AgencyCode").alias("code")).alias("agency"),
        F.struct(
            t("AwardCeiling").alias("ceiling"),
            t("AwardFloor").alias("floor"),
            t("EstimatedTotalProgramFunding").alias("estimated_total_program_funding"),
            F.nullif(numbers.award_count(get("ExpectedNumberOfAwards")), F.lit(0)).alias(
                "expected_number_of_awards"
            ),
        ).alias("award"),
        F.struct(
            codes_to_structs(get("CategoryOfFundingActivity"), dims.ACTIVITY).alias("categories"),
            t("CategoryExplanation").alias("explanation"),
        ).alias("funding_activity"),
        F.struct(
            F.struct(
                t("GrantorContactEmail").alias("email"),
                t("GrantorContactEmailDescription").alias("description"),
            ).alias("email"),
            t("GrantorContactText").alias("text"),
        ).alias("grantor"),
        F.struct(t("Version").alias("version")).alias("metadata"),
        F.struct(
            t("OpportunityID").alias("id"),
            t("OpportunityNumber").alias("number"),
            t("OpportunityTitle").alias("title"),
            t("Description").alias("description"),
            F.struct(
                category["name"].alias("name"),
                category["code"].alias("code"),
                t("OpportunityCategoryExplanation").alias("explanation"),
            ).alias("category"),
            F.struct(
                day("PostDate").alias("post_date"),
                F.struct(day("CloseDate").alias("date"), t("CloseDateExplanation").alias("explanation")).alias("close"),
                day("ArchiveDate").alias("archive_date"),
            ).alias("milestones"),
            day("LastUpdatedDate").alias("last_updated"),
        ).alias("opportunity"),
        F.struct(revision.alias("id"), ulid_time(revision).alias("timestamp")).alias("revision"),
    )


def malformed_fields(get: Getter) -> Column:
    """Names of fields that could not be read; a list field is named once per bad entry."""
    cost = get("CostSharingOrMatchingRequirement")
    awards = get("ExpectedNumberOfAwards")
    category = get("OpportunityCategory")
    single = F.array_compact(F.array(
        F.when(~is_ulid(get("revision")), "revision"),
        F.when(numbers.yes_no(cost).isNull(), "CostSharingOrMatchingRequirement"),
        F.when(is_set(awards) & numbers.award_count(awards).isNull(), "ExpectedNumberOfAwards"),
        F.when(is_set(category) & ~is_known(category, dims.CATEGORY), "OpportunityCategory"),
        *[F.when(is_set(get(n)) & mmddyyyy(get(n)).isNull(), n) for n in _DATES],
    ))

    def each(name: str, is_bad) -> Column:
        bad = F.filter(F.coalesce(get(name), F.array()), is_bad)
        return F.transform(bad, lambda _: F.lit(name))

    def unknown(codes: dict[str, str]):
        return lambda c: ~is_known(c, codes)

    lists = [each(name, unknown(codes)) for name, codes in _CODE_LISTS]
    cfda = each("CFDANumbers", lambda c: ~F.coalesce(numbers.is_cfda(c), F.lit(False)))
    return F.concat(single, cfda, *lists)


def to_canonical(df: DataFrame, images: dict[str, tuple[str, str]] | None = None) -> DataFrame:
    """Adds ``grant`` and ``malformed`` for the row itself.

    ``images`` maps image struct columns to the names of their two results instead.
    """
    if images is None:
        return df.withColumns(
            {"grant": canonical_grant(F.col), "malformed": malformed_fields(F.col)}
        )
    results = {}
    for image, (grant, malformed) in images.items():
        def get(name: str, image: str = image) -> Column:
            return F.col(image)[name]

        there = F.col(image).isNotNull()
        results[grant] = F.when(there, canonical_grant(get))
        results[malformed] = F.when(there, malformed_fields(get))
    return df.withColumns(results)


def grant_json(grant: Column) -> Column:
    """JSON text of a document: empty lists and blanks are left out, structs are kept."""
    def listed(arr: Column) -> Column:
        return F.when(F.size(arr) > 0, arr)

    def named(arr: Column) -> Column:
        return listed(F.transform(
            arr, lambda e: F.struct(_text(e["name"]).alias("name"), _text(e["code"]).alias("code"))
        ))

    activity, opp, rev = grant["funding_activity"], grant["opportunity"], grant["revision"]
    category, dates = opp["category"], opp["milestones"]
    stamp = F.date_format(rev["timestamp"], "yyyy-MM-dd'T'HH:mm:ss.SSS")
    whole = ("additional_information", "agency", "award")
    return F.to_json(F.struct(
        named(grant["funding_instrument_types"]).alias("funding_instrument_types"),
        grant["cost_sharing_or_matching_requirement"].alias("cost_sharing_or_matching_requirement"),
        listed(grant["cfda_numbers"]).alias("cfda_numbers"),
        grant["bill"].alias("bill"),
        named(grant["eligible_applicants"]).alias("eligible_applicants"),
        *[grant[name].alias(name) for name in whole],
        F.struct(
            named(activity["categories"]).alias("categories"),
            activity["explanation"].alias("explanation"),
        ).alias("funding_activity"),
        grant["grantor"].alias("grantor"),
        grant["metadata"].alias("metadata"),
        F.struct(
            *[opp[name].alias(name) for name in ("id", "number", "title", "description")],
            F.struct(
                _text(category["name"]).alias("name"), _text(category["code"]).alias("code"),
                category["explanation"].alias("explanation"),
            ).alias("category"),
            F.struct(
                iso_date(dates["post_date"]).alias("post_date"),
                F.struct(
                    iso_date(dates["close"]["date"]).alias("date"),
                    dates["close"]["explanation"].alias("explanation"),
                ).alias("close"),
                iso_date(dates["archive_date"]).alias("archive_date"),
            ).alias("milestones"),
            iso_date(opp["last_updated"]).alias("last_updated"),
        ).alias("opportunity"),
        F.struct(
            rev["id"].alias("id"),
            F.concat(F.regexp_replace(stamp, r"\.?0{1,3}\z", ""), F.lit("Z")).alias("timestamp"),
        ).alias("revision"),
    ))
