"""The four code dimensions, as literal map columns and as tables."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Code -> name of the published code lists.
APPLICANT = {
    "00": "State governments",
    "01": "County governments",
    "02": "City or township governments",
    "04": "Special district governments",
    "05": "Independent school districts",
    "06": "Public and State controlled institutions of higher education",
    "07": "Native American tribal governments (Federally recognized)",
    "08": "Public housing authorities/Indian housing authorities",
    "11": "Native American tribal organizations (other than Federally recognized tribal governments)",
    "12": "Nonprofits having a 501(c)(3) status with the IRS, other than institutions of higher education",
    "13": "Nonprofits that do not have a 501(c)(3) status with the IRS, other than institutions of higher education",
    "20": "Private institutions of higher education",
    "21": "Individuals",
    "22": "For profit organizations other than small businesses",
    "23": "Small businesses",
    "25": "Others (see text field entitled \"Additional Information on Eligibility\" for clarification)",
    "99": "Unrestricted (i.e., open to any type of entity above), subject to any clarification in text field entitled \"Additional Information on Eligibility\"",
}
ACTIVITY = {
    "RA": "Recovery Act",
    "AG": "Agriculture",
    "AR": "Arts",
    "BC": "Business and Commerce",
    "CD": "Community Development",
    "CP": "Consumer Protection",
    "DPR": "Disaster Prevention and Relief",
    "ED": "Education",
    "ELT": "Employment, Labor and Training",
    "EN": "Energy",
    "ENV": "Environment",
    "FN": "Food and Nutrition",
    "HL": "Health",
    "HO": "Housing",
    "HU": "Humanities",
    "IIJ": "Infrastructure Investment and Jobs Act",
    "IS": "Information and Statistics",
    "ISS": "Income Security and Social Services",
    "LJL": "Law, Justice and Legal Services",
    "NR": "Natural Resources",
    "O": "Other",
    "OZ": "Opportunity Zone Benefits",
    "RD": "Regional Development",
    "ST": "Science and Technology and Other Research and Development",
    "T": "Transportation",
    "ACA": "Affordable Care Act",
}
INSTRUMENT = {
    "CA": "Cooperative Agreement",
    "G": "Grant",
    "PC": "Procurement Contract",
    "O": "Other",
}
CATEGORY = {
    "D": "Discretionary",
    "M": "Mandatory",
    "C": "Continuation",
    "E": "Earmark",
    "O": "Other",
}

DIMENSIONS = {
    "applicant": APPLICANT,
    "activity": ACTIVITY,
    "instrument": INSTRUMENT,
    "category": CATEGORY,
}


def inverse(codes: dict[str, str]) -> dict[str, str]:
    """name -> code; a name that stands for two codes is an error."""
    flipped = {name: code for code, name in codes.items()}
    if len(flipped) != len(codes):
        raise ValueError("two codes share one name")
    return flipped


def map_column(codes: dict[str, str]) -> Column:
    # one literal of JSON instead of two per entry; folded to a constant map when planned
    return F.from_json(F.lit(json.dumps(codes)), "map<string,string>")


def dimension_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame(list(DIMENSIONS[name].items()), "code string, name string")
