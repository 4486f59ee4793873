"""Schemas of the tables this package reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

SYNOPSIS_TAG = "OpportunitySynopsisDetail_1_0"
FORECAST_TAG = "OpportunityForecastDetail_1_0"

# Element names of the public extract, in document order.
COMMON_FIELDS = [
    "OpportunityID", "OpportunityTitle", "OpportunityNumber", "OpportunityCategory",
    "OpportunityCategoryExplanation", "FundingInstrumentType", "CategoryOfFundingActivity",
    "CategoryExplanation", "CFDANumbers", "EligibleApplicants",
    "AdditionalInformationOnEligibility", "AgencyCode", "AgencyName", "PostDate",
    "LastUpdatedDate", "AwardCeiling", "AwardFloor", "EstimatedTotalProgramFunding",
    "ExpectedNumberOfAwards", "Description", "Version", "CostSharingOrMatchingRequirement",
    "ArchiveDate", "AdditionalInformationURL", "AdditionalInformationText",
    "GrantorContactEmail", "GrantorContactEmailDescription",
]
SYNOPSIS_ONLY = ["CloseDate", "CloseDateExplanation", "GrantorContactText"]
FORECAST_ONLY = [
    "EstimatedSynopsisPostDate", "FiscalYear", "EstimatedSynopsisCloseDate",
    "EstimatedSynopsisCloseDateExplanation", "EstimatedAwardDate", "EstimatedProjectStartDate",
    "GrantorContactName", "GrantorContactPhoneNumber",
]
LIST_FIELDS = {
    "FundingInstrumentType", "CategoryOfFundingActivity", "CFDANumbers", "EligibleApplicants",
}
REGISTRY_FIELDS = COMMON_FIELDS + SYNOPSIS_ONLY + FORECAST_ONLY


def _registry_type(name: str) -> T.DataType:
    return T.ArrayType(T.StringType()) if name in LIST_FIELDS else T.StringType()


REGISTRY = T.StructType([T.StructField(n, _registry_type(n)) for n in REGISTRY_FIELDS])

ELIGIBILITY = T.StructType([
    T.StructField(n, T.BooleanType())
    for n in ("higher_education", "local", "non_profits", "other", "state", "tribal")
])
SHEET = T.StructType([
    T.StructField("opportunity_agency", T.StringType()),
    T.StructField("bill", T.StringType()),
    T.StructField("cfda", T.StringType()),
    T.StructField("due_date", T.DateType()),
    T.StructField("eligibility", ELIGIBILITY),
    T.StructField("estimated_funding", T.LongType()),
    T.StructField("expected_awards", T.StringType()),
    T.StructField("grant_id", T.LongType()),
    T.StructField("match", T.BooleanType()),
    T.StructField("opportunity_number", T.StringType()),
    T.StructField("opportunity_title", T.StringType()),
])

PREPARED = T.StructType(
    [
        T.StructField("grant_id", T.StringType()),
        T.StructField("revision", T.StringType()),
        T.StructField("Bill", T.StringType()),
        T.StructField("is_forecast", T.BooleanType()),
    ]
    + REGISTRY.fields
)

CELLS = "file string, row_idx int, cells array<string>, link string, error string"
ARCHIVE_CHUNKS = "path string, entry string, status string, seq long, chunk string"
METRIC_SAMPLE = "ts timestamp, step string, metric string, value double, tags map<string,string>"
