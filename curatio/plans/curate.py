"""The standard curate pipeline and the declarative specs of the 15 activity/survey jobs.

One lazy plan per job::

    scan(v1..vN) -> drop raw -> align names -> unionByName -> study-start filter
      -> [distinct] -> [not null] -> null-safe anti join (excluded)
      -> null-safe anti join (withdrew) -> consent -> drop / allow-list

Attachment re-homing (``curatio.plans.attachments``) runs on the *output*
of this plan, so only released rows have their payloads copied.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from curatio.functions.rules import SHARE_ALL, START_DATE
from curatio.operators.aggregates import distinct_rows
from curatio.operators.columns import drop_if_present, select_allowlist, skip_columns
from curatio.operators.filters import consented, not_null, since
from curatio.operators.joins import exclude
from curatio.operators.sets import union_versions

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------
# De-identification drop list shared by every activity/survey table.
STANDARD_DROP = [
    "dataGroups",
    "externalId",
    "userSharingScope",
    "validationErrors",
    "substudyMemberships",
    "dayInStudy",
]
# Column never fetched from any source table.
RAW_COLUMN = "rawData"
# Columns kept, in order, by the truncated MSIS-29 release, and its rename.
MSIS29_KEEP = [
    "recordId",
    "appVersion",
    "phoneInfo",
    "uploadDate",
    "healthCode",
    "createdOn",
    "createdOnTimeZone",
    "01_demanding_tasks",
    "02_grip",
    "03_carry_things",
    "04_balance",
    "29_confidence",
]
MSIS29_RENAME = {"29_confidence": "29_depression"}


@dataclass(frozen=True)
class Source:
    """One version of an input table."""

    table: str
    renames: Mapping[str, str] = field(default_factory=dict)
    enabled: bool = True


@dataclass(frozen=True)
class TableSpec:
    """Everything that distinguishes one standard job from another."""

    name: str
    sources: Sequence[Source]
    date_col: str
    drop: Sequence[str] = tuple(STANDARD_DROP)
    keep: Sequence[str] | None = None
    keep_renames: Mapping[str, str] = field(default_factory=dict)
    dedup: bool = False
    not_null: Sequence[str] = ()
    json_columns: Sequence[str] = ()
    schema_source: str | None = None  # table whose schema types the output; None = inferred
    schema_drop: Sequence[str] | None = None  # defaults to drop + raw column
    lineage: Sequence[str] = ()

    @property
    def used(self) -> list[str]:
        """Input ids recorded in the provenance row."""
        return list(self.lineage) or [s.table for s in self.sources if s.enabled]


def curate(
    spec: TableSpec,
    frames: Mapping[str, DataFrame],
    excluded: DataFrame,
    withdrew: DataFrame,
    start: str = START_DATE,
    participant: str = "healthCode",
    scope: str = "userSharingScope",
    share_value: str = SHARE_ALL,
    list_key: str = "healthCode",
) -> DataFrame:
    """Run the standard pipeline (L12) for ``spec`` over already-scanned ``frames``.

    ``frames`` maps each source table name to its DataFrame (see
    ``Catalog.scan``); system and raw columns are dropped here so the scan
    never reads them.
    """
    versions = [s for s in spec.sources if s.enabled]
    scanned = [skip_columns(frames[s.table], (RAW_COLUMN,)) for s in versions]
    df = union_versions(scanned, [dict(s.renames) for s in versions])
    df = since(df, spec.date_col, start)
    if spec.dedup:
        df = distinct_rows(df)
    if spec.not_null:
        df = not_null(df, *spec.not_null)
    df = exclude(df, excluded, participant, list_key)
    df = exclude(df, withdrew, participant, list_key)
    df = consented(df, scope, share_value)
    if spec.keep is not None:
        return select_allowlist(df, spec.keep, spec.keep_renames)
    return drop_if_present(df, *spec.drop)


def _activity(name: str, versions: list[tuple[str, dict]], extra_drop=(), schema_extra_drop=None, **kw) -> TableSpec:
    drop = [*STANDARD_DROP, *extra_drop]
    sdrop = [*STANDARD_DROP, *(extra_drop if schema_extra_drop is None else schema_extra_drop), RAW_COLUMN]
    return TableSpec(
        name=name,
        sources=[Source(t, r) for t, r in versions],
        date_col=kw.pop("date_col", "metadata.json.startDate"),
        drop=drop,
        schema_drop=sdrop,
        schema_source=kw.pop("schema_source", versions[-1][0]),
        **kw,
    )


def _items(*names: str) -> dict[str, str]:
    return {n: f"{n}.items" for n in names}


# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results: the
# release tables, their source versions, the attachment columns renamed to
# the newer version's names, the per-table extra drops and the date column.
# (Logical source names are ours; map them to storage with a ``Catalog``.)
# ---------------------------------------------------------------------------
SPECS: dict[str, TableSpec] = {
    "tapping": _activity(
        "Tapping",
        [
            ("tapping_v1", _items("accelerometer_tapping_left.json", "accelerometer_tapping_right.json")),
            ("tapping_v2", {}),
        ],
        extra_drop=["metadata.json.dataGroups"],
    ),
    "walking": _activity(
        "Walking",
        [
            (
                "walking_v1",
                _items(
                    "accelerometer_walking_outbound.json",
                    "deviceMotion_walking_outbound.json",
                    "pedometer_walking_outbound.json",
                    "accelerometer_walking_rest.json",
                    "deviceMotion_walking_rest.json",
                ),
            ),
            ("walking_v2", {}),
        ],
        extra_drop=["metadata.json.dataGroups"],
    ),
    # Tremor drops the metadata group column from the data but not from the
    # schema; the conformance report flags that column as missing.
    "tremor": _activity(
        "Tremor",
        [
            (
                "tremor_v4",
                _items(
                    "ac4_acc_tremor_handToNose_right.json",
                    "ac4_motion_tremor_handToNose_right.json",
                    "ac4_acc_tremor_handToNose_left.json",
                    "ac4_motion_tremor_handToNose_left.json",
                ),
            ),
            ("tremor_v5", {}),
        ],
        extra_drop=["metadata.json.dataGroups"],
        schema_extra_drop=[],
    ),
    "passive_pedometer": _activity(
        "Passive Pedometer Data",
        [("passive_pedometer", {})],
        dedup=True,
        not_null=["pedometer.json.pedometerData"],
    ),
    "passive_weather": _activity(
        "Passive Weather Data",
        [("passive_weather", {})],
        extra_drop=["metadata.json.dataGroups", "weather.json.weather.code", "weather.json.weather.detail"],
        lineage=["passive_weather_v1", "passive_weather"],
    ),
    "symptoms": _activity(
        "Symptoms Survey",
        [("symptoms", {})],
        json_columns=["symptomTiming.json.choiceAnswers"],
        schema_extra_drop=["symptomTiming.json.choiceAnswers"],
    ),
    # The first triggers version is deliberately not read (spec flag).
    "triggers": TableSpec(
        name="Triggers Survey",
        sources=[Source("triggers_v1", enabled=False), Source("triggers")],
        date_col="metadata.json.startDate",
        json_columns=["myTriggers.json.choiceAnswers"],
        schema_source="triggers",
        schema_drop=[*STANDARD_DROP, RAW_COLUMN, "myTriggers.json.choiceAnswers"],
    ),
    "relapses": _activity("Relapses Survey", [("relapses", {})]),
    "daily_check_in": _activity("Daily Check-In", [("daily_check_in", {})], date_col="createdOn"),
    "medication": _activity("Medication Survey", [("medication", {})], date_col="createdOn"),
    "neuroqol_cognition": _activity("NeuroQOL-Cognition", [("neuroqol_cognition", {})], date_col="createdOn"),
    "neuroqol_lower": _activity("NeuroQOL-LowerExtremity", [("neuroqol_lower", {})], date_col="createdOn"),
    "neuroqol_upper": _activity("NeuroQOL-UpperExtremity", [("neuroqol_upper", {})], date_col="createdOn"),
    "msis29": TableSpec(
        name="Truncated MSIS-29",
        sources=[Source("msis29")],
        date_col="createdOn",
        keep=MSIS29_KEEP,
        keep_renames=MSIS29_RENAME,
    ),
    "wpai": TableSpec(
        name="WPAI",
        sources=[Source("wpai_v1"), Source("wpai_v2")],
        date_col="createdOn",
    ),
}
