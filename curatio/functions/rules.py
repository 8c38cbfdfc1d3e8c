"""Domain rules of the baseline profile (harmonisation, consistency, grouping).

Each rule is a single column expression so it can run inside whole-stage
codegen on batch or streaming frames alike.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from curatio.functions.expr import as_col, empty_or_null, first_match, in_values, not_in_values

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# Race harmonisation, first match wins (pattern -> label).
RACE_RULES = [
    ("latino_hispanic", "latino_hispanic"),
    ("black_or_african", "Black_African"),
    ("caucasian", "caucasian"),
    ("asian,pacific.*", "asian"),
    ("native_american|caribbean|middle_eastern", "other"),
]
# Education harmonisation.
EDUCATION_TO_DIPLOMA = ["some_high_school", "high_school_diploma_ged"]
EDUCATION_DIPLOMA = "high_school_diploma_ged"
EDUCATION_TO_COLLEGE = ["some_college"]
EDUCATION_COLLEGE = "college_degree"
# Insurance harmonisation.
INSURANCE_GOVERNMENT = ["government insurance", "medicare", "medicaid"]
INSURANCE_OTHER = ["other", "rather not say"]
# Cohort-consistency error codes.
ERR_NA_WITH_MS = "Ignore|dataGroups = NA and some MS related params"
ERR_CONTROL_WITH_MS = "Ignore|dataGroups = control and some MS related params"
ERR_CONTROL_REFERRED = "dataGroups = control and referred_by_clinician =T"
ERR_NA = "Ignore|dataGroups = NA"
CONTROL_DIAGNOSIS_OK = ["no", "notsure"]
# Cohort labels.
COHORTS = ["control", "ms_patient"]
IGNORE = "Ignore"
GROUP_REFERRAL = "MS patients(clinical referral)"
GROUP_PATIENT = "MS patients"
GROUP_CONTROL = "Controls"
# Consent value (upper case in activity tables, lower-cased in baseline).
SHARE_ALL = "ALL_QUALIFIED_RESEARCHERS"
# Default study start.
START_DATE = "2017-08-14"


def harmonise_race(race: str | Column) -> Column:
    """Collapse a comma list of race answers into one label (L1)."""
    r = as_col(race)
    return first_match([(r.rlike(p), label) for p, label in RACE_RULES], default=r)


def harmonise_education(edu: str | Column) -> Column:
    e = as_col(edu)
    return first_match(
        [
            (e.isin(EDUCATION_TO_DIPLOMA), EDUCATION_DIPLOMA),
            (e.isin(EDUCATION_TO_COLLEGE), EDUCATION_COLLEGE),
        ],
        default=e,
    )


def harmonise_insurance(ins: str | Column) -> Column:
    i = as_col(ins)
    return first_match(
        [
            (i.isin(INSURANCE_GOVERNMENT), "government insurance"),
            (i.isin(INSURANCE_OTHER), "other"),
        ],
        default=i,
    )


def cohort_error_code(
    group: str | Column = "dataGroups",
    current_diagnosis: str | Column = "currentDiagnosis",
    current_diagnosis_year: str | Column = "currentDiagnosisYear",
    current_dmt: str | Column = "currentDMT",
    first_dmt_year: str | Column = "firstDMTYear",
    physical_ability: str | Column = "overallPhysicalAbility",
    referred: str | Column = "referred_by_clinician",
    external_id: str | Column = "externalId",
) -> Column:
    """Ordered consistency rules (L4). ``NULL`` means consistent.

    Rule 3 treats a NULL diagnosis as "not in {no, notsure}" (R's ``%in%``).
    """
    g = as_col(group)
    no_group = empty_or_null(g)
    is_control = F.coalesce(g == F.lit("control"), F.lit(False))
    cd, cdy = as_col(current_diagnosis), as_col(current_diagnosis_year)
    dmt, fdy = as_col(current_dmt), as_col(first_dmt_year)
    return first_match(
        [
            (no_group & cd.isNotNull() & cdy.isNotNull(), ERR_NA_WITH_MS),
            (no_group & dmt.isNotNull() & fdy.isNotNull(), ERR_NA_WITH_MS),
            (
                is_control
                & (
                    dmt.isNotNull()
                    | not_in_values(cd, CONTROL_DIAGNOSIS_OK)
                    | cdy.isNotNull()
                    | as_col(physical_ability).isNotNull()
                ),
                ERR_CONTROL_WITH_MS,
            ),
            (
                is_control
                & (F.coalesce(as_col(referred) == F.lit(True), F.lit(False)) | as_col(external_id).isNotNull()),
                ERR_CONTROL_REFERRED,
            ),
            (no_group, ERR_NA),
        ]
    )


def reassign_cohort(group: str | Column, error: str | Column) -> Column:
    """Cohort after the consistency check (L5); ``Ignore`` rows stay in the table."""
    e = as_col(error)
    return first_match(
        [
            (e.isin(ERR_CONTROL_WITH_MS, ERR_NA_WITH_MS, ERR_NA), IGNORE),
            (e == F.lit(ERR_CONTROL_REFERRED), "ms_patient"),
        ],
        default=as_col(group),
    )


def analysis_group(referred: str | Column, group: str | Column) -> Column:
    """Analysis label (L6); NULL when no rule applies."""
    r, g = as_col(referred), as_col(group)
    return first_match(
        [
            ((r == F.lit(True)) & (g == F.lit("ms_patient")), GROUP_REFERRAL),
            ((r == F.lit(False)) & (g == F.lit("ms_patient")), GROUP_PATIENT),
            (g == F.lit("control"), GROUP_CONTROL),
        ]
    )


def in_cohort(group: str | Column) -> Column:
    return in_values(group, COHORTS)


def postcode_prefix(zipcode: str | Column, digits: int = 3) -> Column:
    """Generalised postcode: the first ``digits`` characters."""
    return F.substring(as_col(zipcode), 1, digits)
