"""Shared pieces of the registered queries: stand-in SQL, lists, presentation rounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curatio.sources.testtables import standin, table  # noqa: F401  (re-export)

# Study start used on the order-based stand-ins (orders span 1995-2001).
ORDERS_START = "1998-08-14"
# Study start used on the event-based stand-ins (events span January 2024).
EVENTS_START = "2024-01-10"
# "Today" for the year arithmetic, fixed so results are reproducible.
AS_OF = "2020-06-30"

# Exclusion list: participants of one nation.  Withdrawal list: supplier keys
# of three nations (overlaps the low participant keys).
EXCLUDED_SQL = "SELECT CAST(c_custkey AS STRING) AS healthCode FROM customer WHERE c_nationkey = 3"
WITHDREW_SQL = "SELECT CAST(s_suppkey AS STRING) AS healthCode FROM supplier WHERE s_nationkey IN (5, 6, 7)"
WITHDREW_NULL_SQL = WITHDREW_SQL + " UNION ALL SELECT CAST(NULL AS STRING) AS healthCode"

# Survey records: one per order; participant 1 is stored without id.
SURVEY_SQL = """
SELECT CAST(o_orderkey AS STRING) AS recordId,
       CAST(nullif(o_custkey, 1) AS STRING) AS healthCode,
       o_orderdate AS createdOn,
       CASE o_orderstatus WHEN 'F' THEN 'ALL_QUALIFIED_RESEARCHERS'
                          WHEN 'O' THEN 'SPONSORS_AND_PARTNERS' END AS userSharingScope,
       o_orderpriority AS answer,
       o_totalprice AS score,
       o_orderstatus AS dataGroups,
       concat('ext', CAST(o_custkey AS STRING)) AS externalId,
       CAST(NULL AS STRING) AS validationErrors,
       CAST(NULL AS STRING) AS substudyMemberships,
       CAST(NULL AS INT) AS dayInStudy,
       concat('raw', CAST(o_orderkey AS STRING)) AS rawData
FROM orders
"""


# Rounding boundary for presentation: 0.5 - 1/(1000 pi).  Sums and means of
# short decimals are often exact ties at .5 in decimal arithmetic, and two
# engines that sum in different orders land on either side of such a tie.  A
# boundary that no short terminating decimal can hit removes the ambiguity.
ROUND_OFFSET = 0.5 - 1.0 / (1000.0 * 3.141592653589793)


def without_zone(df: DataFrame) -> DataFrame:
    """Instants as UTC wall-clock times, the type the test tables and the oracles have."""
    return df.withColumns({n: F.col(f"`{n}`").cast("timestamp_ntz") for n, t in df.dtypes if t == "timestamp"})


def present(col: Column, digits: int = 6) -> Column:
    """Presentation rounding applied identically by Spark and the oracle
    (``floor(x * 10^d + offset) / 10^d`` in IEEE doubles), so both engines
    print the same digits even when their summation orders differ in the
    last bit."""
    m = float(10**digits)
    return F.floor(col * F.lit(m) + F.lit(ROUND_OFFSET)) / F.lit(m)


def present_sql(expr: str, digits: int = 6) -> str:
    m = f"1e{digits}"
    return f"(floor(({expr}) * {m} + {ROUND_OFFSET!r}e0) / {m})"
