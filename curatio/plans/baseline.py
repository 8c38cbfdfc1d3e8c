"""Baseline characteristics (P17): one row per participant from two sources.

Plan outline (all lazy; the aggregations and full outer joins shuffle on
the participant key, about ten exchanges in the final plan - see PLANS.md -
and the lists and dimensions join as broadcasts when Spark's size check
allows):

1. demographics survey: rename, cohort + start filters, race flags ->
   comma list per participant (one ``bool_or`` aggregate) joined back,
   lb -> kg, race harmonisation;
2. profile table: rename, JSON punctuation stripped from race, start filter;
3. union of both, half-even rounding, lower-casing, keep-first per answer
   combination (explicit order: source, then row order);
4. latest non-NULL answer per participant and attribute (one ``max_by``
   per attribute - no gather/spread);
5. disease attributes the same way; latest age; full outer joins;
6. rules (education, consistency code, cohort reassignment, years since,
   insurance, analysis group), postcode generalisation, consent, drops.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.functions.expr import c, half_even, strip_json_punct, to_number, years_since
from curatio.functions.rules import (
    START_DATE,
    analysis_group,
    cohort_error_code,
    harmonise_education,
    harmonise_insurance,
    harmonise_race,
    in_cohort,
    postcode_prefix,
    reassign_cohort,
)
from curatio.operators.aggregates import first_in_order, keep_first, last_in_order, latest_nonnull
from curatio.operators.columns import columns_matching, drop_if_present, lower_columns, regex_rename, sentinel_to_null
from curatio.operators.filters import since
from curatio.operators.joins import exclude, full_outer_coalesced, inner_lookup, left_lookup, mark_member
from curatio.operators.reshape import flags_to_list

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
DEMOG_DROP_FIRST = ["ROW_ID", "ROW_VERSION", "metadata.json.dataGroups", "substudyMemberships"]
DEMOG_RENAMES = [(".json.answer", ""), ("metadata.json.", "")]
DEMOG_DROP_AFTER = [
    "scheduledActivityGuid", "endDate", "endDate.timezone", "validationErrors", "startDate.timezone",
    "startDate", "appVersion", "phoneInfo", "createdOn", "createdOnTimeZone", "recordId", "uploadDate", "rawData",
]
PROFILE_RENAME = ("demographics.", "")
PROFILE_DROP = ["ROW_ID", "ROW_VERSION", "recordId", "rawData"]
DEMOG_FEATURES = [
    "externalId", "dataGroups", "userSharingScope", "gender", "height", "weight", "zipcode",
    "education", "health_insurance", "employment", "race",
]
DEMOG_LOWER = [
    "healthCode", "externalId", "dataGroups", "userSharingScope", "gender", "zipcode", "education",
    "race", "health_insurance", "employment",
]
DISEASE_COLUMNS = [
    "initialDiagnosis", "initialDiagnosisYear", "currentDiagnosis", "currentDiagnosisYear", "currentDMT",
    "firstDMTYear", "msFamilyHistory", "overallPhysicalAbility",
]
DISEASE_FEATURES = DISEASE_COLUMNS[2:]
POUNDS_PER_KG = 2.2
SHARE_ALL_LOWER = "all_qualified_researchers"
FINAL_DROP = ["zipcode_firstThree", "externalId", "userSharingScope", "error", "state.abbr", "group"]


def prepare_demographics(demog: DataFrame, start: str = START_DATE, order: str = "__seq") -> DataFrame:
    """Step 1: survey demographics -> (healthCode, answers..., date_of_entry, race)."""
    df = drop_if_present(demog, *DEMOG_DROP_FIRST)
    for pat, rep in DEMOG_RENAMES:
        df = regex_rename(df, pat, rep)
    df = df.where(in_cohort("dataGroups")).withColumn("date_of_entry", F.to_date(c("startDate")))
    df = drop_if_present(df, *DEMOG_DROP_AFTER)
    df = since(df, "date_of_entry", start)
    race_cols = columns_matching(df, "race")
    race = flags_to_list(df, "healthCode", race_cols, r"race.", "race")
    df = inner_lookup(drop_if_present(df, *race_cols, "dayInStudy"), race, "healthCode")
    return df.withColumn("weight", c("weight") / F.lit(POUNDS_PER_KG)).withColumn("race", harmonise_race("race"))


def prepare_profiles(profiles: DataFrame, start: str = START_DATE) -> DataFrame:
    """Step 2: profile table with clean race text and the entry date."""
    df = regex_rename(profiles, PROFILE_RENAME[0], PROFILE_RENAME[1])
    df = drop_if_present(df, *PROFILE_DROP)
    df = df.withColumn("race", strip_json_punct("race")).withColumn("date_of_entry", F.to_date(c("createdOn")))
    return since(df, "date_of_entry", start)


def demographic_profile(demog: DataFrame, profiles: DataFrame, order: str) -> DataFrame:
    """Steps 3-4: union, round, lower, keep-first, latest answer per participant.

    ``order`` is the row-order column of both inputs (the table order R sees).
    """
    cols = ["healthCode", *DEMOG_FEATURES[:-1], "date_of_entry", "race"]
    a = demog.select(*[c(n) for n in cols], c(order).alias("__seq")).withColumn("__src", F.lit(0))
    b = profiles.select(*[c(n) for n in cols], c(order).alias("__seq")).withColumn("__src", F.lit(1))
    u = a.unionByName(b)
    u = u.withColumn("height", half_even("height", 1)).withColumn("weight", half_even("weight", 1))
    u = lower_columns(u, DEMOG_LOWER)
    u = keep_first(u, ["healthCode", *DEMOG_FEATURES], ["__src", "__seq"])
    return u.groupBy("healthCode").agg(
        *[latest_nonnull(f, ["date_of_entry", "__src", "__seq"]).alias(f) for f in DEMOG_FEATURES]
    )


def disease_profile(profiles: DataFrame, order: str) -> DataFrame:
    """Step 5a: latest disease attributes per participant (text, lower-cased)."""
    d = profiles.select(
        F.lower(c("healthCode")).alias("healthCode"),
        *[F.lower(c(n).cast("string")).alias(n) for n in DISEASE_COLUMNS],
        c("date_of_entry"),
        c(order).alias("__seq"),
    )
    d = keep_first(d, ["healthCode", *DISEASE_COLUMNS], ["__seq"])
    return d.groupBy("healthCode").agg(
        *[latest_nonnull(f, ["date_of_entry", "__seq"]).alias(f) for f in DISEASE_FEATURES]
    )


def latest_age(profiles: DataFrame, order: str) -> DataFrame:
    """Step 5b: age at the last entry date; ties by row order of first appearance."""
    firsts = (
        profiles.where(c("age").isNotNull())
        .groupBy("healthCode", "date_of_entry", "age")
        .agg(F.min(c(order)).alias("__seq"))
    )
    return firsts.groupBy("healthCode").agg(last_in_order("age", ["date_of_entry", "__seq"]).alias("age"))


def postcode_states(zips: DataFrame, states: DataFrame) -> DataFrame:
    """Postcode prefix -> (state name, abbreviation); first state by zip on a conflict."""
    z = inner_lookup(zips.select("zip", "state"), states, "state")
    z = z.withColumn("zipcode_firstThree", postcode_prefix("zip"))
    return z.groupBy("zipcode_firstThree").agg(
        first_in_order(F.struct(c("state.name").alias("s"), c("state").alias("a")), ["zip"]).alias("__st")
    ).select("zipcode_firstThree", F.col("__st.s").alias("state"), F.col("__st.a").alias("state.abbr"))


def baseline_characteristics(
    demog: DataFrame,
    profiles: DataFrame,
    external_ids: DataFrame,
    excluded: DataFrame,
    withdrew: DataFrame,
    zips: DataFrame,
    states: DataFrame,
    order: str = "__seq",
    start: str = START_DATE,
    as_of: str | None = None,
    keep_qc: bool = False,
) -> DataFrame:
    """The whole P17 job.  ``order`` names a row-order column present in
    ``demog`` and ``profiles`` (the table order R sees, e.g. ``ROW_ID``);
    ``as_of`` fixes "today" for the year columns."""
    if order != "__seq":
        demog = demog.withColumn("__seq", c(order))
        profiles = profiles.withColumn("__seq", c(order))
        order = "__seq"
    dem = prepare_demographics(demog, start)
    prof = prepare_profiles(profiles, start)
    demo = demographic_profile(dem, prof, order)
    ids = external_ids.select(F.regexp_replace(c("id"), "-", "").alias("externalId"))
    demo = mark_member(demo, ids, "externalId", "referred_by_clinician")
    demo = demo.where(in_cohort("dataGroups"))
    out = full_outer_coalesced(demo, disease_profile(prof, order), "healthCode")
    out = full_outer_coalesced(out, latest_age(prof, order), "healthCode")
    out = out.withColumn("education", harmonise_education("education"))
    out = out.withColumn("height", to_number("height")).withColumn("weight", to_number("weight"))
    out = exclude(out, excluded, "healthCode")
    out = exclude(out, withdrew, "healthCode")
    out = sentinel_to_null(out.withColumn("error", F.lit(None).cast("string")))
    out = out.withColumn("error", cohort_error_code())
    out = out.withColumn("dataGroups", reassign_cohort("dataGroups", "error"))
    out = out.withColumn("YearsSinceDiagnosis", years_since("currentDiagnosisYear", as_of))
    out = out.withColumn("YearsSinceFirstDMT", years_since("firstDMTYear", as_of))
    out = out.withColumn("health_insurance", harmonise_insurance("health_insurance"))
    out = out.withColumn("group", analysis_group("referred_by_clinician", "dataGroups"))
    out = out.withColumn("zipcode_firstThree", postcode_prefix("zipcode"))
    out = left_lookup(out, postcode_states(zips, states), "zipcode_firstThree")
    out = out.withColumn("zipcode", c("zipcode_firstThree"))
    out = out.where(c("userSharingScope") == F.lit(SHARE_ALL_LOWER))
    return out if keep_qc else drop_if_present(out, *FINAL_DROP)


def consistency_report(base_with_qc: DataFrame) -> DataFrame:
    """QC output: participants with a non-NULL consistency code."""
    return base_with_qc.where(c("error").isNotNull()).select("healthCode", "dataGroups", "error")


__all__: Sequence[str] = [
    "baseline_characteristics",
    "consistency_report",
    "demographic_profile",
    "disease_profile",
    "latest_age",
    "postcode_states",
    "prepare_demographics",
    "prepare_profiles",
]
