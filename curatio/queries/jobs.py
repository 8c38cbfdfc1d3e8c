"""The fifteen standard jobs as queries (P1-P15), on survey and activity tables made from ``orders``.

A source version holds the orders whose key leaves its number as remainder; old
versions carry the old column names.  The oracles restate each job from
``JOBS``, not from the library's specs: which columns a job's table has, which it
drops, which hold file handles or JSON answers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from curatio.plans.curate import SPECS
from curatio.plans.release import released_frame
from curatio.queries.common import EXCLUDED_SQL, ORDERS_START, WITHDREW_SQL, without_zone
from curatio.queries.curation import ATTACH_SQL
from curatio.sources.testtables import duck, standin

QUERIES: dict = {}
ORACLE: dict = {}

START, CREATED = "metadata.json.startDate", "createdOn"
ALWAYS_DROPPED = ["dataGroups", "externalId", "validationErrors", "substudyMemberships", "dayInStudy"]
TAPS = ["accelerometer_tapping_left.json", "accelerometer_tapping_right.json"]
WALKS = [f"{s}_walking_outbound.json" for s in ("accelerometer", "deviceMotion", "pedometer")] + [
    f"{s}_walking_rest.json" for s in ("accelerometer", "deviceMotion")]
TREMORS = [f"ac4_{s}_tremor_handToNose_{h}.json" for h in ("right", "left") for s in ("acc", "motion")]
MSIS = ["appVersion", "phoneInfo", "uploadDate", "createdOnTimeZone", "01_demanding_tasks", "02_grip", "03_carry_things",
        "04_balance", "29_confidence"]
# versions: source names; renamed: handle columns whose old name lacks ".items"; dropped: extra columns that go;
# handles, json, plain: further columns that stay
JOBS: dict[str, dict] = {
    "tapping": dict(versions=["tapping_v1", "tapping_v2"], date=START, renamed=TAPS, dropped=["metadata.json.dataGroups"]),
    "walking": dict(versions=["walking_v1", "walking_v2"], date=START, renamed=WALKS, dropped=["metadata.json.dataGroups"]),
    "tremor": dict(versions=["tremor_v4", "tremor_v5"], date=START, renamed=TREMORS, dropped=["metadata.json.dataGroups"]),
    "passive_pedometer": dict(versions=["passive_pedometer"], date=START, handles=["pedometer.json.pedometerData"], distinct=True),
    "passive_weather": dict(versions=["passive_weather"], date=START, plain=["weather.json.temperature"],
                            dropped=["metadata.json.dataGroups", "weather.json.weather.code", "weather.json.weather.detail"]),
    "symptoms": dict(versions=["symptoms"], date=START, json=["symptomTiming.json.choiceAnswers"]),
    "triggers": dict(versions=["triggers"], date=START, json=["myTriggers.json.choiceAnswers"]),
    "relapses": dict(versions=["relapses"], date=START, plain=["relapse.json.answer"]),
    "daily_check_in": dict(versions=["daily_check_in"], date=CREATED, plain=["feeling"]),
    "medication": dict(versions=["medication"], date=CREATED, plain=["dose"]),
    "neuroqol_cognition": dict(versions=["neuroqol_cognition"], date=CREATED, plain=["q1"]),
    "neuroqol_lower": dict(versions=["neuroqol_lower"], date=CREATED, plain=["q1"]),
    "neuroqol_upper": dict(versions=["neuroqol_upper"], date=CREATED, plain=["q1"]),
    "msis29": dict(versions=["msis29"], date=CREATED, plain=MSIS, only=["recordId", "healthCode", CREATED]),
    "wpai": dict(versions=["wpai_v1", "wpai_v2"], date=CREATED, plain=["hours"]),
}


def q(name: str) -> str:
    return f"`{name}`"


def _cell(i: int) -> str:
    """A column that differs by row and position."""
    return f"concat(o_orderpriority, '-', CAST(o_orderkey % {7 + i} AS STRING))"


def _handle(i: int) -> str:
    """File handles: documents' ids, some of which don't exist, some NULL."""
    return f"CASE WHEN o_orderkey % {5 + i} <> 0 THEN CAST(o_orderkey % {900 + 300 * i} AS STRING) END"


def source_sql(job: dict, version: int) -> str:
    """One source version of a job."""
    last = version == len(job["versions"]) - 1
    once = "CAST(o_custkey % 50 AS STRING)" if job.get("distinct") else "CAST(o_orderkey AS STRING)"
    day = "date_trunc('year', o_orderdate)" if job.get("distinct") else "o_orderdate"
    cols = [f"{once} AS recordId", "CAST(nullif(o_custkey, 1) AS STRING) AS healthCode",
            f"{day} AS {CREATED}", f"{day} - INTERVAL '30' DAY AS {q(START)}",
            "CASE o_orderstatus WHEN 'F' THEN 'ALL_QUALIFIED_RESEARCHERS' WHEN 'O' THEN 'SPONSORS_AND_PARTNERS' END AS userSharingScope",
            "CAST(o_orderkey AS STRING) AS rawData"]
    cols += [f"'x' AS {q(n)}" for n in [*ALWAYS_DROPPED, *job.get("dropped", [])]]
    cols += [f"{_handle(i)} AS {q(n + '.items' if last else n)}" for i, n in enumerate(job.get("renamed", []))]
    cols += [f"CASE WHEN o_orderpriority <> '5-LOW' THEN CAST(o_orderkey % 3 AS STRING) END AS {q(n)}" for n in job.get("handles", [])]
    cols += ["CASE WHEN o_orderpriority = '1-URGENT' THEN 'not json' ELSE "
             f"concat('[\"', o_orderstatus, '\",\"', CAST(o_orderkey % 9 AS STRING), '\"]') END AS {q(n)}" for n in job.get("json", [])]
    cols += [f"{_cell(i)} AS {q(n)}" for i, n in enumerate(job.get("plain", []))]
    return f"SELECT {', '.join(cols)} FROM orders WHERE o_orderkey % {len(job['versions'])} = {version}"


def oracle(job: dict) -> str:
    """The released table: aligned union, filters, lists, consent, columns that stay, new handles."""
    parts = []
    for v in range(len(job["versions"])):
        last = v == len(job["versions"]) - 1
        old = ", ".join(f"{q(n)} AS {q(n + '.items')}" for n in job.get("renamed", []))
        src = source_sql(job, v)
        parts.append(src if last or not old else f"SELECT * EXCLUDE ({', '.join(map(q, job['renamed']))}), {old} FROM ({src})")
    handles = [n + ".items" for n in job.get("renamed", [])] + job.get("handles", [])
    kept = job.get("only", ["recordId", "healthCode", CREATED, START])
    cols = [f"s.{q(n)}" for n in kept]
    cols += [f"f{i}.new_handle AS {q(n)}" for i, n in enumerate(handles)]
    cols += [f"CASE WHEN json_valid({q(n)}) THEN sha256(to_json(CAST({q(n)} AS JSON)::VARCHAR[])::VARCHAR) END AS {q(n)}" for n in job.get("json", [])]
    cols += [f"s.{q(n)} AS {q({'29_confidence': '29_depression'}.get(n, n))}" for n in job.get("plain", [])]
    files = "(SELECT handle, min(sha256(content)) AS new_handle FROM att WHERE content IS NOT NULL GROUP BY handle)"
    joins = " ".join(f"LEFT JOIN {files} f{i} ON s.{q(n)} = f{i}.handle" for i, n in enumerate(handles))
    some = " ".join(f"AND s.{q(n)} IS NOT NULL" for n in job.get("handles", []))
    rows = "SELECT DISTINCT * EXCLUDE (rawData) FROM u" if job.get("distinct") else "SELECT * FROM u"
    return duck(f"""
WITH att AS ({ATTACH_SQL}), u AS ({' UNION ALL BY NAME '.join(parts)}), s AS ({rows})
SELECT {', '.join(cols)} FROM s {joins}
WHERE CAST(s.{q(job['date'])} AS DATE) >= DATE '{ORDERS_START}' {some} AND s.userSharingScope = 'ALL_QUALIFIED_RESEARCHERS'
  AND NOT EXISTS (SELECT 1 FROM ({EXCLUDED_SQL}) x WHERE x.healthCode IS NOT DISTINCT FROM s.healthCode)
  AND NOT EXISTS (SELECT 1 FROM ({WITHDREW_SQL}) w WHERE w.healthCode IS NOT DISTINCT FROM s.healthCode)""")


def _register(name: str, job: dict) -> None:
    handles = [n + ".items" for n in job.get("renamed", [])] + job.get("handles", [])

    def run(spark, d) -> DataFrame:
        frames = {t: standin(spark, d, source_sql(job, v)) for v, t in enumerate(job["versions"])}
        out = released_frame(SPECS[name], frames, standin(spark, d, EXCLUDED_SQL), standin(spark, d, WITHDREW_SQL),
                             attachments=standin(spark, d, ATTACH_SQL), handle_columns=tuple(handles), start=ORDERS_START)
        return without_zone(out)

    run.__name__, run.__doc__ = f"job_{name}", f"The {SPECS[name].name} release table."
    QUERIES[run.__name__], ORACLE[run.__name__] = run, oracle(job)


for _name, _job in JOBS.items():
    _register(_name, _job)
