"""Registered curation queries (SURVEY groups A-L) with their DuckDB oracles.

Every query reads the test tables in full; stand-ins only rename/reshape
rows (``curatio.queries.common``).  Oracle SQL restates each operator's
semantics independently in DuckDB.
"""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curatio.functions import expr as X
from curatio.functions import rules as R
from curatio.operators import aggregates as A
from curatio.operators import columns as C
from curatio.operators import filters as D
from curatio.operators import joins as E
from curatio.operators import reshape as G
from curatio.operators import windows as H
from curatio.operators.sets import union_versions
from curatio.plans import attachments as ATT
from curatio.plans import manifest as MF
from curatio.plans import publish as PUB
from curatio.plans.curate import Source, TableSpec, curate
from curatio.plans.release import ReleaseJob, release_set
from curatio.plans.trials import trial_summary
from curatio.queries.common import (
    AS_OF,
    EXCLUDED_SQL,
    ORDERS_START,
    SURVEY_SQL,
    WITHDREW_NULL_SQL,
    WITHDREW_SQL,
    present,
    present_sql,
    standin,
    table,
    without_zone,
)
from curatio.session import scratch
from curatio.sources.catalog import ATTACHMENT, attachment_files, inline_table, read_side_list, write_attachments
from curatio.sources.testtables import duck

QUERIES: dict = {}
ORACLE: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# --------------------------------------------------------------------------
# A. scans, sources
# --------------------------------------------------------------------------

@query("scan_skip_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority FROM orders")
def scan_skip_columns(spark, d):
    return C.skip_columns(table(spark, d, "orders"), ["o_totalprice"])


@query("scan_by_participant", "SELECT * FROM orders WHERE o_custkey = 10")
def scan_by_participant(spark, d):
    return table(spark, d, "orders").where(F.col("o_custkey") == F.lit(10))


@query("csv_side_list", duck(EXCLUDED_SQL))
def csv_side_list(spark, d):
    path = scratch(spark, "side-list")
    # the list's column stands between others, which are not read
    rows = standin(spark, d, EXCLUDED_SQL).selectExpr("'by phone' AS note", "healthCode", "1 AS round")
    rows.write.mode("overwrite").option("header", True).csv(path)
    return read_side_list(spark, path)


MIXED_CASE_SQL = """
SELECT CASE WHEN o_orderkey % 2 = 0 THEN concat('Ab', CAST(o_custkey AS STRING)) ELSE concat('aB', CAST(o_custkey AS STRING)) END AS healthCode,
       CAST(o_orderkey AS STRING) AS recordId FROM orders
"""
MIXED_LIST_SQL = "SELECT concat('AB', CAST(c_custkey AS STRING)) AS healthCode FROM customer WHERE c_nationkey = 3"


@query(
    "exclude_ignore_case",
    f"SELECT * FROM ({duck(MIXED_CASE_SQL)}) r WHERE lower(healthCode) NOT IN (SELECT lower(healthCode) FROM ({duck(MIXED_LIST_SQL)}))",
)
def exclude_ignore_case(spark, d):
    """Ids on the exclusion list in another case than in the records."""
    return E.exclude(standin(spark, d, MIXED_CASE_SQL), standin(spark, d, MIXED_LIST_SQL), "healthCode", ignore_case=True)


SEGMENT_CODES = [("AUTOMOBILE", "AU"), ("BUILDING", "BU"), ("FURNITURE", "FU"), ("HOUSEHOLD", "HO"), ("MACHINERY", "MA")]


@query(
    "inline_dimension",
    "SELECT c.c_custkey, c.c_mktsegment, s.code FROM customer c JOIN (VALUES "
    + ", ".join(f"('{a}', '{b}')" for a, b in SEGMENT_CODES)
    + ") s(segment, code) ON c.c_mktsegment = s.segment",
)
def inline_dimension(spark, d):
    codes = inline_table(spark, SEGMENT_CODES, "segment string, code string")
    cust = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return E.inner_lookup(cust, codes, "c_mktsegment", "segment")


# --------------------------------------------------------------------------
# C. schema & projection
# --------------------------------------------------------------------------

@query("project_allowlist", "SELECT o_orderkey, o_custkey, o_orderdate FROM orders")
def project_allowlist(spark, d):
    return C.select_allowlist(table(spark, d, "orders"), ["o_orderkey", "o_custkey", "o_orderdate"])


@query("drop_columns", "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderdate FROM orders")
def drop_columns(spark, d):
    return C.drop_if_present(table(spark, d, "orders"), "o_totalprice", "o_orderpriority", "not_there")


@query(
    "rename_in_select",
    "SELECT o_orderkey AS recordId, o_custkey AS healthCode, o_orderpriority AS answer FROM orders",
)
def rename_in_select(spark, d):
    return C.select_allowlist(
        table(spark, d, "orders"),
        ["o_orderkey", "o_custkey", "o_orderpriority"],
        {"o_orderkey": "recordId", "o_custkey": "healthCode", "o_orderpriority": "answer"},
    )


@query(
    "regex_rename_columns",
    "SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, "
    "c_mktsegment AS mktsegment FROM customer",
)
def regex_rename_columns(spark, d):
    # '.' is a wildcard, as in the reference's gsub over column names.
    return C.regex_rename(table(spark, d, "customer"), r"^c.", "")


@query("project_by_type", "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem")
def project_by_type(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*C.columns_of_type(li, "double"))


@query("project_by_pattern", "SELECT l_extendedprice, l_discount FROM lineitem")
def project_by_pattern(spark, d):
    li = table(spark, d, "lineitem")
    return li.select(*C.columns_matching(li, "price|discount"))


PART_TARGET = T.StructType(
    [
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_brand", T.IntegerType()),
        T.StructField("p_size", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_retailprice", T.DoubleType()),
        T.StructField("p_container", T.StringType()),
    ]
)


@query(
    "project_to_schema",
    "SELECT p_partkey, TRY_CAST(p_brand AS INTEGER) AS p_brand, CAST(p_size AS VARCHAR) AS p_size, "
    "p_retailprice, CAST(NULL AS VARCHAR) AS p_container FROM part",
)
def project_to_schema(spark, d):
    return C.project_to_schema(table(spark, d, "part"), PART_TARGET, drop=["p_type"])


@query("retype_column", "SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang FROM documents")
def retype_column(spark, d):
    docs = C.mark_handle(table(spark, d, "documents"), "doc_id")
    return docs.select(*[n for n in C.columns_of_type(docs, "handle")], "lang")


@query("align_columns", "SELECT c_nationkey, c_custkey FROM customer")
def align_columns(spark, d):
    target = table(spark, d, "customer").select("c_nationkey", "c_custkey")
    return C.align_to(table(spark, d, "customer"), target.columns)


CONFORM_TARGET = T.StructType(
    [
        T.StructField("p_partkey", T.IntegerType()),
        T.StructField("p_brand", T.IntegerType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_size", T.DoubleType()),
        T.StructField("p_missing", T.StringType()),
    ]
)


@query(
    "conformance_report",
    """
SELECT 'p_partkey' AS column_name, true AS present, 'int' AS target_type,
       CAST(count_if(p_partkey IS NOT NULL AND TRY_CAST(p_partkey AS INTEGER) IS NULL) AS BIGINT) AS bad_values FROM part
UNION ALL SELECT 'p_brand', true, 'int', CAST(count_if(p_brand IS NOT NULL AND TRY_CAST(p_brand AS INTEGER) IS NULL) AS BIGINT) FROM part
UNION ALL SELECT 'p_name', true, 'string', CAST(count_if(p_name IS NOT NULL AND TRY_CAST(p_name AS VARCHAR) IS NULL) AS BIGINT) FROM part
UNION ALL SELECT 'p_size', true, 'double', CAST(count_if(p_size IS NOT NULL AND TRY_CAST(p_size AS DOUBLE) IS NULL) AS BIGINT) FROM part
UNION ALL SELECT 'p_missing', false, 'string', CAST(NULL AS BIGINT)
""",
)
def conformance_report(spark, d):
    return C.conformance_report(table(spark, d, "part"), CONFORM_TARGET)


@query(
    "add_missing_columns",
    "SELECT *, CAST(NULL AS VARCHAR) AS c_phone, CAST(NULL AS DOUBLE) AS c_score FROM customer",
)
def add_missing_columns(spark, d):
    return C.add_missing_columns(table(spark, d, "customer"), {"c_phone": "string", "c_score": "double", "c_name": "string"})


@query(
    "lowercase_all",
    "SELECT c_custkey, lower(c_name) AS c_name, c_nationkey, c_acctbal, lower(c_mktsegment) AS c_mktsegment FROM customer",
)
def lowercase_all(spark, d):
    return C.lower_columns(table(spark, d, "customer"))


@query(
    "sentinel_to_null",
    "SELECT o_orderkey, nullif(o_orderstatus, '5-LOW') AS o_orderstatus, "
    "nullif(o_orderpriority, '5-LOW') AS o_orderpriority FROM orders",
)
def sentinel_to_null(spark, d):
    o = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return C.sentinel_to_null(o, "5-LOW")


@query(
    "masked_assign",
    "SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, "
    "c_acctbal / 1000.0 AS acct_k FROM customer",
)
def masked_assign(spark, d):
    cu = table(spark, d, "customer")
    cu = C.masked_assign(cu, "c_acctbal", F.col("c_acctbal") < 0, 0.0)
    cu = cu.withColumn("acct_k", F.col("c_acctbal") / 1000.0)  # derived (C14)
    return C.drop_if_present(cu, "c_name")  # remove by NULL (C18)


ORACLE["masked_assign"] = (
    "SELECT c_custkey, c_nationkey, c_mktsegment, CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal END AS c_acctbal, "
    "CASE WHEN c_acctbal < 0 THEN 0.0 ELSE c_acctbal / 1000.0 END AS acct_k FROM customer"
)


# --------------------------------------------------------------------------
# D. filters
# --------------------------------------------------------------------------

@query("start_date_filter", f"SELECT * FROM orders WHERE CAST(o_orderdate AS DATE) >= DATE '{ORDERS_START}'")
def start_date_filter(spark, d):
    return D.since(table(spark, d, "orders"), "o_orderdate", ORDERS_START)


@query(
    "having_start_date",
    "SELECT o_custkey, min(o_orderdate) AS first_order, count(*) AS n_orders FROM orders GROUP BY o_custkey "
    "HAVING CAST(min(o_orderdate) AS DATE) >= DATE '1995-06-01'",
)
def having_start_date(spark, d):
    agg = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.count(F.lit(1)).alias("n_orders")
    )
    return D.since(agg, "first_order", "1995-06-01")


@query("consent_filter", "SELECT * FROM orders WHERE o_orderstatus = 'F'")
def consent_filter(spark, d):
    return D.consented(table(spark, d, "orders"), "o_orderstatus", "F")


@query("cohort_membership", "SELECT * FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def cohort_membership(spark, d):
    return D.member_of(table(spark, d, "customer"), "c_mktsegment", ["BUILDING", "MACHINERY"])


SEG_NULL = "SELECT c_custkey, nullif(c_mktsegment, 'HOUSEHOLD') AS seg FROM customer"


@query(
    "not_in_null_safe",
    f"SELECT * FROM ({SEG_NULL}) WHERE NOT coalesce(seg IN ('AUTOMOBILE', 'FURNITURE'), false)",
)
def not_in_null_safe(spark, d):
    return D.not_member_of(standin(spark, d, SEG_NULL), "seg", ["AUTOMOBILE", "FURNITURE"])


PRIO_NULL = "SELECT o_orderkey, o_custkey, nullif(o_orderpriority, '5-LOW') AS prio, nullif(o_orderstatus, 'P') AS status FROM orders"


@query("not_null_filter", f"SELECT * FROM ({PRIO_NULL}) WHERE prio IS NOT NULL")
def not_null_filter(spark, d):
    return D.not_null(standin(spark, d, PRIO_NULL), "prio")


FLAG_SQL = (
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, "
    "CASE WHEN l_linestatus = 'O' THEN NULL ELSE l_returnflag = 'R' END AS flag FROM lineitem"
)


@query("true_flag_filter", f"SELECT * FROM ({FLAG_SQL}) WHERE flag")
def true_flag_filter(spark, d):
    return D.true_flag(standin(spark, d, FLAG_SQL), "flag")


@query("complete_cases", f"SELECT * FROM ({PRIO_NULL}) WHERE prio IS NOT NULL AND status IS NOT NULL")
def complete_cases(spark, d):
    return D.complete_cases(standin(spark, d, PRIO_NULL))


SEG_EMPTY = (
    "SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN '' WHEN 'AUTOMOBILE' THEN NULL "
    "ELSE c_mktsegment END AS seg FROM customer"
)


@query("empty_or_null", f"SELECT * FROM ({SEG_EMPTY}) WHERE seg IS NULL OR seg = ''")
def empty_or_null(spark, d):
    return D.empty_or_null_rows(standin(spark, d, SEG_EMPTY), "seg")


# --------------------------------------------------------------------------
# E. joins
# --------------------------------------------------------------------------

_S = duck(SURVEY_SQL)
_EXC = duck(EXCLUDED_SQL)
_WD = duck(WITHDREW_SQL)
_WDN = duck(WITHDREW_NULL_SQL)


@query(
    "exclude_participants",
    f"""
SELECT recordId, healthCode, answer FROM ({_S}) s
WHERE NOT EXISTS (SELECT 1 FROM ({_EXC}) x WHERE x.healthCode IS NOT DISTINCT FROM s.healthCode)
  AND NOT EXISTS (SELECT 1 FROM ({_WD}) w WHERE w.healthCode IS NOT DISTINCT FROM s.healthCode)
""",
)
def exclude_participants(spark, d):
    s = standin(spark, d, SURVEY_SQL).select("recordId", "healthCode", "answer")
    s = E.exclude(s, standin(spark, d, EXCLUDED_SQL), "healthCode")
    return E.exclude(s, standin(spark, d, WITHDREW_SQL), "healthCode")


@query(
    "exclude_null_list",
    f"""
SELECT recordId, healthCode FROM ({_S}) s
WHERE NOT EXISTS (SELECT 1 FROM ({_WDN}) w WHERE w.healthCode IS NOT DISTINCT FROM s.healthCode)
""",
)
def exclude_null_list(spark, d):
    s = standin(spark, d, SURVEY_SQL).select("recordId", "healthCode")
    return E.exclude(s, standin(spark, d, WITHDREW_NULL_SQL), "healthCode")


@query(
    "retain_cohort",
    "SELECT o.* FROM orders o WHERE o.o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
)
def retain_cohort(spark, d):
    cohort = table(spark, d, "customer").where(F.col("c_mktsegment") == "BUILDING")
    return E.retain(table(spark, d, "orders"), cohort, "o_custkey", "c_custkey")


@query(
    "referral_flag",
    "SELECT c_custkey, c_mktsegment, coalesce(c_custkey IN (SELECT s_suppkey FROM supplier), false) AS referred FROM customer",
)
def referral_flag(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return E.mark_member(cu, table(spark, d, "supplier"), "c_custkey", "referred", list_key="s_suppkey")


@query(
    "crosswalk_left_join",
    "SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, cw.o_custkey AS healthCode "
    "FROM lineitem l LEFT JOIN (SELECT DISTINCT o_orderkey, o_custkey FROM orders) cw ON l.l_orderkey = cw.o_orderkey",
)
def crosswalk_left_join(spark, d):
    cw = table(spark, d, "orders").select("o_orderkey", F.col("o_custkey").alias("healthCode")).distinct()
    li = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return E.left_lookup(li, cw, "l_orderkey", "o_orderkey")


@query(
    "handle_left_join",
    "SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id",
)
def handle_left_join(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return E.left_lookup(docs, table(spark, d, "labels"), "doc_id")


PREFIX_DIM_SQL = (
    "SELECT substring(n_name, 1, 8) AS prefix, arg_min(n_regionkey, n_nationkey) AS n_regionkey "
    "FROM nation GROUP BY substring(n_name, 1, 8)"
)


@query(
    "prefix_lookup",
    f"SELECT c.c_custkey, substring(concat('NATION_', CAST(c.c_nationkey AS VARCHAR)), 1, 8) AS prefix, p.n_regionkey "
    f"FROM customer c LEFT JOIN ({PREFIX_DIM_SQL}) p "
    f"ON substring(concat('NATION_', CAST(c.c_nationkey AS VARCHAR)), 1, 8) = p.prefix",
)
def prefix_lookup(spark, d):
    nation = table(spark, d, "nation").withColumn("prefix", F.substring("n_name", 1, 8))
    dim = nation.groupBy("prefix").agg(A.first_in_order("n_regionkey", ["n_nationkey"]).alias("n_regionkey"))
    cu = table(spark, d, "customer").select(
        "c_custkey", F.substring(F.concat(F.lit("NATION_"), F.col("c_nationkey").cast("string")), 1, 8).alias("prefix")
    )
    return E.left_lookup(cu, dim, "prefix")


@query(
    "inner_dimension",
    "SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') r "
    "ON n.n_regionkey = r.r_regionkey",
)
def inner_dimension(spark, d):
    reg = table(spark, d, "region").where(F.col("r_name") != "ASIA")
    return E.inner_lookup(table(spark, d, "nation"), reg, "n_regionkey", "r_regionkey").drop("n_regionkey")


@query(
    "full_outer_profiles",
    """
SELECT coalesce(a.k, b.k) AS k, a.n_orders, a.last_order, b.n_lines
FROM (SELECT o_custkey AS k, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey) a
FULL OUTER JOIN (SELECT l_suppkey AS k, count(*) AS n_lines FROM lineitem GROUP BY l_suppkey) b
ON a.k IS NOT DISTINCT FROM b.k
""",
)
def full_outer_profiles(spark, d):
    a = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("k")).agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    b = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("k")).agg(F.count(F.lit(1)).alias("n_lines"))
    return E.full_outer_coalesced(a, b, "k")


@query(
    "natural_join_nulls",
    "SELECT c.c_custkey, c.nk, n.n_name FROM (SELECT c_custkey, nullif(c_nationkey, 0) AS nk FROM customer) c "
    "LEFT JOIN (SELECT nullif(n_nationkey, 0) AS nk, n_name FROM nation) n ON c.nk IS NOT DISTINCT FROM n.nk",
)
def natural_join_nulls(spark, d):
    cu = table(spark, d, "customer").select("c_custkey", F.expr("nullif(c_nationkey, 0)").alias("nk"))
    na = table(spark, d, "nation").select(F.expr("nullif(n_nationkey, 0)").alias("nk"), "n_name")
    return E.left_lookup(cu, na, E.natural_keys(cu, na))


# --------------------------------------------------------------------------
# F. aggregations, H1/H2 ordering
# --------------------------------------------------------------------------

@query(
    "distinct_nonnull_count",
    f"SELECT o_custkey, count(DISTINCT prio) AS n_uniq FROM ({PRIO_NULL}) GROUP BY o_custkey",
)
def distinct_nonnull_count(spark, d):
    return standin(spark, d, PRIO_NULL).groupBy("o_custkey").agg(A.count_distinct_nonnull("prio").alias("n_uniq"))


PRIO_ORDERED = (
    "SELECT o_orderkey, o_custkey, o_orderdate, nullif(o_orderpriority, '5-LOW') AS prio FROM orders"
)


@query(
    "ordered_distinct_concat",
    f"""
SELECT o_custkey, string_agg(prio, ',' ORDER BY fd, fk) AS prios FROM (
  SELECT o_custkey, prio, arg_min(o_orderdate, (o_orderdate, o_orderkey)) AS fd, arg_min(o_orderkey, (o_orderdate, o_orderkey)) AS fk
  FROM ({PRIO_ORDERED}) WHERE prio IS NOT NULL GROUP BY o_custkey, prio) GROUP BY o_custkey
""",
)
def ordered_distinct_concat(spark, d):
    df = standin(spark, d, PRIO_ORDERED)
    return A.ordered_distinct_concat(df, ["o_custkey"], "prio", ["o_orderdate", "o_orderkey"], "prios")


@query(
    "latest_value",
    f"SELECT o_custkey, arg_max(prio, (o_orderdate, o_orderkey)) FILTER (WHERE prio IS NOT NULL) AS latest_prio "
    f"FROM ({PRIO_ORDERED}) GROUP BY o_custkey",
)
def latest_value(spark, d):
    df = standin(spark, d, PRIO_ORDERED)
    return df.groupBy("o_custkey").agg(A.latest_nonnull("prio", ["o_orderdate", "o_orderkey"]).alias("latest_prio"))


@query(
    "last_row",
    "SELECT o_custkey, arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS last_price, max(o_orderdate) AS last_date "
    "FROM orders GROUP BY o_custkey",
)
def last_row(spark, d):
    o = table(spark, d, "orders")
    return o.groupBy("o_custkey").agg(
        A.last_in_order("o_totalprice", ["o_orderdate", "o_orderkey"]).alias("last_price"),
        A.last_in_order("o_orderdate", ["o_orderdate", "o_orderkey"]).alias("last_date"),
    )


@query(
    "first_in_order",
    "SELECT n_regionkey, arg_min(n_name, n_nationkey) AS first_nation FROM nation GROUP BY n_regionkey",
)
def first_in_order(spark, d):
    return table(spark, d, "nation").groupBy("n_regionkey").agg(
        A.first_in_order("n_name", ["n_nationkey"]).alias("first_nation")
    )


@query("distinct_rows", "SELECT DISTINCT l_returnflag, l_linestatus, l_suppkey FROM lineitem")
def distinct_rows(spark, d):
    return A.distinct_rows(table(spark, d, "lineitem").select("l_returnflag", "l_linestatus", "l_suppkey"))


@query(
    "keep_first_by_key",
    """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderpriority ORDER BY o_orderdate, o_orderkey) AS rn FROM orders)
WHERE rn = 1
""",
)
def keep_first_by_key(spark, d):
    return A.keep_first(table(spark, d, "orders"), ["o_custkey", "o_orderpriority"], ["o_orderdate", "o_orderkey"])


@query("distinct_vector", "SELECT DISTINCT o_orderpriority FROM orders")
def distinct_vector(spark, d):
    return A.distinct_values(table(spark, d, "orders"), "o_orderpriority")


# --------------------------------------------------------------------------
# G. reshaping
# --------------------------------------------------------------------------

@query(
    "unpivot_selected",
    "SELECT c_custkey, feature, value FROM customer UNPIVOT (value FOR feature IN (c_name, c_mktsegment))",
)
def unpivot_selected(spark, d):
    return G.unpivot(table(spark, d, "customer"), ["c_custkey"], ["c_name", "c_mktsegment"], "feature", "value")


@query(
    "unpivot_all_text",
    """
SELECT c_custkey, feature, value FROM (
  SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
         regexp_replace(CAST(c_acctbal AS VARCHAR), '\\.0$', '') AS c_acctbal, c_mktsegment FROM customer)
UNPIVOT (value FOR feature IN (c_name, c_nationkey, c_acctbal, c_mktsegment))
""",
)
def unpivot_all_text(spark, d):
    return G.unpivot(table(spark, d, "customer"), ["c_custkey"], None, "feature", "value", as_text=True)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "pivot_long",
    "SELECT o_custkey, "
    + ", ".join(f"max(n) FILTER (WHERE o_orderpriority = '{p}') AS \"{p}\"" for p in PRIORITIES)
    + " FROM (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders GROUP BY ALL) GROUP BY o_custkey",
)
def pivot_long(spark, d):
    long = table(spark, d, "orders").groupBy("o_custkey", "o_orderpriority").agg(F.count(F.lit(1)).alias("n"))
    return G.pivot(long, ["o_custkey"], "o_orderpriority", "n", PRIORITIES)


# Race-style one-hot flags per order (stand-in): one flag column per priority.
RACE_FLAG_LABELS = ["latino_hispanic", "asian", "pacific_islander", "caucasian", "caribbean"]
RACE_FLAGS_SQL = (
    "SELECT o_custkey AS healthCode, "
    + ", ".join(
        f"o_orderpriority = '{p}' AS `race.{lbl}`" for p, lbl in zip(PRIORITIES, RACE_FLAG_LABELS)
    )
    + " FROM orders"
)
_FLAGS_ORACLE = (
    "SELECT healthCode, concat_ws(',', "
    + ", ".join(f"CASE WHEN bool_or(\"race.{lbl}\") THEN '{lbl}' END" for lbl in RACE_FLAG_LABELS)
    + f") AS race FROM ({duck(RACE_FLAGS_SQL)}) GROUP BY healthCode"
)


@query("flags_to_list", f"SELECT * FROM ({_FLAGS_ORACLE}) WHERE race <> ''")
def flags_to_list(spark, d):
    flags = standin(spark, d, RACE_FLAGS_SQL)
    return G.flags_to_list(flags, "healthCode", C.columns_matching(flags, "race"), r"race.", "race")


PROFILE_SRC = (
    "SELECT o_orderkey, o_custkey, o_orderdate, nullif(o_orderpriority, '5-LOW') AS prio, "
    "nullif(o_orderstatus, 'P') AS status, o_totalprice FROM orders"
)


@query(
    "latest_profile",
    f"SELECT o_custkey, "
    + ", ".join(
        f"arg_max({f}, (o_orderdate, o_orderkey)) FILTER (WHERE {f} IS NOT NULL) AS {f}"
        for f in ["prio", "status", "o_totalprice"]
    )
    + f" FROM ({PROFILE_SRC}) GROUP BY o_custkey",
)
def latest_profile(spark, d):
    return G.latest_profile(
        standin(spark, d, PROFILE_SRC), "o_custkey", ["o_orderdate", "o_orderkey"], ["prio", "status", "o_totalprice"]
    )


@query(
    "change_report",
    f"""
WITH long AS (
  SELECT o_custkey, o_orderdate, o_orderkey, feature, value FROM ({PROFILE_SRC})
  UNPIVOT INCLUDE NULLS (value FOR feature IN (prio, status))),
per_value AS (
  SELECT o_custkey, feature, value, min((o_orderdate, o_orderkey)) AS f, max((o_orderdate, o_orderkey)) AS l
  FROM long GROUP BY ALL)
SELECT o_custkey, feature, count(value) AS n_uniq_values,
       coalesce(string_agg(value, ',' ORDER BY f), '') AS unique_values,
       arg_max(value, l) FILTER (WHERE value IS NOT NULL) AS value
FROM per_value GROUP BY o_custkey, feature
""",
)
def change_report(spark, d):
    return G.change_report(
        standin(spark, d, PROFILE_SRC), "o_custkey", ["o_orderdate", "o_orderkey"], ["prio", "status"]
    )


@query(
    "map_to_rows",
    "SELECT event_id, 'k' AS key, CAST(json_extract_string(props, '$.k') AS INTEGER) AS value FROM events",
)
def map_to_rows(spark, d):
    ev = table(spark, d, "events").withColumn("m", F.from_json("props", "map<string,int>"))
    return G.map_to_rows(ev, "m", "key", "value", keep=["event_id"])


# --------------------------------------------------------------------------
# H. ordered series on events (participant = user)
# --------------------------------------------------------------------------

@query(
    "lag_diff",
    "SELECT event_id, user_id, value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d_value FROM events",
)
def lag_diff(spark, d):
    ev = table(spark, d, "events")
    out = H.lag_diff(ev, ["user_id"], ["ts", "event_id"], "value", "d_value")
    return out.select("event_id", "user_id", present(F.col("d_value")).alias("d_value"))


ORACLE["lag_diff"] = (
    "SELECT event_id, user_id, "
    + present_sql("value - lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id)")
    + " AS d_value FROM events"
)


@query(
    "running_integral",
    "SELECT event_id, user_id, "
    + present_sql("sum(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 0.5", 4)
    + " AS integral FROM events",
)
def running_integral(spark, d):
    out = H.running_sum(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", "integral", 0.5)
    return out.select("event_id", "user_id", present(F.col("integral"), 4).alias("integral"))


@query(
    "percent_slices",
    """
WITH p AS (SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events)
SELECT user_id, """
    + ", ".join(
        f"{present_sql(f'avg(value) FILTER (WHERE i <= ceil(n * {p}))')} AS first_{t}, "
        f"{present_sql(f'avg(value) FILTER (WHERE i > n - ceil(n * {p}))')} AS last_{t}"
        for p, t in [(0.1, 10), (0.25, 25), (0.5, 50)]
    )
    + " FROM p GROUP BY user_id",
)
def percent_slices(spark, d):
    out = H.percent_slice_means(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], "value", [0.1, 0.25, 0.5])
    return out.select("user_id", *[present(F.col(c)).alias(c) for c in out.columns if c != "user_id"])


@query(
    "fixed_windows",
    """
WITH p AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS i0,
                  count(*) OVER (PARTITION BY user_id) AS n FROM events),
g AS (SELECT max(n) AS most FROM p),
w AS (SELECT unnest(range(0, (SELECT most // 8 + 1 FROM g))) AS window_id)
SELECT user_id, CAST(window_id AS INTEGER) AS window_id, count(*) AS n_samples FROM p, w
WHERE i0 >= window_id * 8 AND i0 < window_id * 8 + 16 AND (window_id = 0 OR window_id * 8 + 8 < n)
GROUP BY user_id, window_id
""",
)
def fixed_windows(spark, d):
    out = H.fixed_windows(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], 16, 8)
    return out.groupBy("user_id", "window_id").agg(F.count(F.lit(1)).alias("n_samples"))


# --------------------------------------------------------------------------
# I. unions
# --------------------------------------------------------------------------

V1_SQL = "SELECT o_orderkey, o_custkey, o_orderpriority AS answer_v1 FROM orders WHERE o_orderstatus = 'F'"
V2_SQL = "SELECT o_orderkey, o_custkey, o_orderpriority AS answer FROM orders WHERE o_orderstatus <> 'F'"


@query("union_versions", "SELECT o_orderkey, o_custkey, o_orderpriority AS answer FROM orders")
def union_versions_q(spark, d):
    v1, v2 = standin(spark, d, V1_SQL), standin(spark, d, V2_SQL)
    return union_versions([v1, v2], [{"answer_v1": "answer"}, None])


@query(
    "union_aligned_sources",
    "SELECT c_custkey AS k, c_acctbal AS bal, 0 AS src FROM customer UNION ALL "
    "SELECT s_suppkey AS k, s_acctbal AS bal, 1 AS src FROM supplier",
)
def union_aligned_sources(spark, d):
    a = table(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_acctbal").alias("bal"),
                                           F.lit(0).alias("src"))
    b = table(spark, d, "supplier").select(F.lit(1).alias("src"), F.col("s_acctbal").alias("bal"),
                                           F.col("s_suppkey").alias("k"))
    return union_versions([a, C.align_to(b, a.columns)])


@query("union_many", "SELECT r_regionkey AS k, r_name AS name FROM region UNION ALL SELECT n_nationkey, n_name FROM nation")
def union_many(spark, d):
    one = union_versions([table(spark, d, "region").select(F.col("r_regionkey").alias("k"), F.col("r_name").alias("name"))])
    two = table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), F.col("n_name").alias("name"))
    return union_versions([one, two])


# --------------------------------------------------------------------------
# J. scalar functions
# --------------------------------------------------------------------------

@query(
    "regex_clean",
    "SELECT p_partkey, regexp_replace(p_name, '[aeiou]', '', 'g') AS no_vowels, "
    "regexp_replace(p_brand, '\\D', '', 'g') AS brand_no FROM part",
)
def regex_clean(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.regexp_replace("p_name", "[aeiou]", "").alias("no_vowels"),
                    F.regexp_replace("p_brand", r"\D", "").alias("brand_no"))


PART_RULES = [("ring|bolt", "hardware"), ("red|blue", "colour"), ("^s", "s-word")]


@query(
    "regex_match_rules",
    "SELECT p_partkey, CASE "
    + " ".join(f"WHEN regexp_matches(p_name, '{p}') THEN '{v}'" for p, v in PART_RULES)
    + " ELSE p_name END AS kind FROM part",
)
def regex_match_rules(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", X.first_match([(F.col("p_name").rlike(pt), v) for pt, v in PART_RULES],
                                               default=F.col("p_name")).alias("kind"))


@query(
    "string_functions",
    "SELECT p_partkey, concat(p_brand, '/', p_type) AS brand_type, substring(p_type, 1, 3) AS type3, "
    "CAST(length(p_name) AS INTEGER) AS name_len, lower(p_type) AS type_lower FROM part",
)
def string_functions(spark, d):
    p = table(spark, d, "part")
    return p.select("p_partkey", F.concat("p_brand", F.lit("/"), "p_type").alias("brand_type"),
                    F.substring("p_type", 1, 3).alias("type3"), F.length("p_name").alias("name_len"),
                    F.lower("p_type").alias("type_lower"))


@query(
    "rounding",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_quantity / 8.0, 2) AS q8, "
    "round_even(l_discount * 10.0, 0) AS d10 FROM lineitem",
)
def rounding(spark, d):
    li = table(spark, d, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                     X.half_even(F.col("l_quantity") / 8.0, 2).alias("q8"),
                     X.half_even(F.col("l_discount") * 10.0, 0).alias("d10"))


@query(
    "unit_conversion",
    "SELECT c_custkey, " + present_sql("c_acctbal / 2.2") + " AS acct_kg, " + present_sql("c_acctbal / 1000") + " AS acct_s FROM customer",
)
def unit_conversion(spark, d):
    cu = table(spark, d, "customer")
    return cu.select("c_custkey", present(F.col("c_acctbal") / F.lit(2.2)).alias("acct_kg"),
                     present(F.col("c_acctbal") / F.lit(1000)).alias("acct_s"))


@query(
    "safe_casts",
    "SELECT p_partkey, TRY_CAST(substring(p_brand, 7) AS DOUBLE) AS brand_no, TRY_CAST(p_type AS DOUBLE) AS type_no, "
    "CAST(p_size AS VARCHAR) AS size_text FROM part",
)
def safe_casts(spark, d):
    p = table(spark, d, "part").withColumn("b", F.substring("p_brand", 7, 100))
    return p.select("p_partkey", X.to_number("b").alias("brand_no"), X.to_number("p_type").alias("type_no"),
                    F.col("p_size").cast("string").alias("size_text"))


@query(
    "date_functions",
    "SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(year(o_orderdate) AS INTEGER) AS yr, "
    "CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start, epoch(o_orderdate) AS epoch_s, "
    f"{present_sql(f'year(DATE {chr(39)}{AS_OF}{chr(39)}) - year(o_orderdate)', 0)} AS years_ago FROM orders",
)
def date_functions(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey", F.to_date("o_orderdate").alias("day"), F.year("o_orderdate").alias("yr"),
        F.to_date(F.date_trunc("month", "o_orderdate")).alias("month_start"),
        X.epoch_seconds("o_orderdate").alias("epoch_s"),
        present(X.years_since(F.year("o_orderdate").cast("string"), AS_OF), 0).alias("years_ago"),
    )


@query(
    "case_rules",
    "SELECT o_orderkey, CASE WHEN o_totalprice > 300000 THEN 'large' WHEN o_totalprice > 100000 THEN 'medium' END AS size, "
    "CASE WHEN o_orderstatus = 'F' THEN true ELSE false END AS done, "
    "(nullif(o_orderstatus, 'P') = 'F') OR (o_totalprice > 300000) AS either FROM orders",
)
def case_rules(spark, d):
    o = table(spark, d, "orders")
    return o.select(
        "o_orderkey",
        X.first_match([(F.col("o_totalprice") > 300000, "large"), (F.col("o_totalprice") > 100000, "medium")]).alias("size"),
        F.when(F.col("o_orderstatus") == "F", True).otherwise(False).alias("done"),
        ((F.expr("nullif(o_orderstatus, 'P')") == "F") | (F.col("o_totalprice") > 300000)).alias("either"),
    )


CHOICE_SQL = (
    "SELECT event_id, user_id, ts, "
    "CASE WHEN event_type = 'error' THEN 'not json' "
    "ELSE concat('[\"', event_type, '\",\"k', CAST(CAST(floor(value) AS BIGINT) AS STRING), '\"]') END AS answers FROM events"
)


@query(
    "json_parse",
    "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k, "
    "CASE WHEN json_valid(answers) THEN CAST(answers AS JSON)::VARCHAR[] END AS choices "
    f"FROM ({duck(CHOICE_SQL)}) JOIN events USING (event_id)",
)
def json_parse(spark, d):
    ev = table(spark, d, "events").select("event_id", "props")
    ch = standin(spark, d, CHOICE_SQL).select("event_id", "answers")
    j = ev.join(ch, "event_id")
    return j.select("event_id", F.get_json_object("props", "$.k").cast("int").alias("k"),
                    X.json_string_array("answers").alias("choices"))


@query(
    "json_strip_punct",
    f"SELECT event_id, regexp_replace(answers, '[\\[\"\\]]', '', 'g') AS plain FROM ({duck(CHOICE_SQL)})",
)
def json_strip_punct(spark, d):
    return standin(spark, d, CHOICE_SQL).select("event_id", X.strip_json_punct("answers").alias("plain"))


@query(
    "array_position",
    "SELECT vec_id, " + present_sql("embedding[1]") + " AS first_v, " + present_sql("embedding[len(embedding)]")
    + " AS last_v, CAST(len(embedding) AS INTEGER) AS n FROM embeddings",
)
def array_position(spark, d):
    e = table(spark, d, "embeddings")
    return e.select("vec_id", present(F.element_at("embedding", 1).cast("double")).alias("first_v"),
                    present(F.element_at("embedding", -1).cast("double")).alias("last_v"),
                    F.size("embedding").alias("n"))


# --------------------------------------------------------------------------
# L. domain rules on stand-in participant attributes
# --------------------------------------------------------------------------

# The published race rules, written out for the oracles (fixed values; first match wins).
RACE_CASE_DUCK = """CASE WHEN regexp_matches(race, 'latino_hispanic') THEN 'latino_hispanic'
  WHEN regexp_matches(race, 'black_or_african') THEN 'Black_African'
  WHEN regexp_matches(race, 'caucasian') THEN 'caucasian'
  WHEN regexp_matches(race, 'asian,pacific.*') THEN 'asian'
  WHEN regexp_matches(race, 'native_american|caribbean|middle_eastern') THEN 'other' ELSE race END"""


@query(
    "race_harmonise",
    f"SELECT healthCode, race AS race_list, {RACE_CASE_DUCK} AS race FROM ({_FLAGS_ORACLE}) WHERE race <> ''",
)
def race_harmonise(spark, d):
    lists = flags_to_list(spark, d)
    return lists.select("healthCode", F.col("race").alias("race_list"), R.harmonise_race("race").alias("race"))


EDU_VALUES = ["some_high_school", "high_school_diploma_ged", "some_college", "college_degree", "masters"]
INS_VALUES = ["medicare", "medicaid", "government insurance", "rather not say", "employer"]
ATTR_SQL = (
    "SELECT o_orderkey, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{e}'" for p, e in zip(PRIORITIES, EDU_VALUES))
    + " END AS education, CASE o_orderpriority "
    + " ".join(f"WHEN '{p}' THEN '{i}'" for p, i in zip(PRIORITIES, INS_VALUES))
    + " END AS health_insurance FROM orders"
)


@query(
    "education_harmonise",
    "SELECT o_orderkey, CASE WHEN education IN ('some_high_school', 'high_school_diploma_ged') THEN 'high_school_diploma_ged' "
    "WHEN education IN ('some_college') THEN 'college_degree' ELSE education END AS education "
    f"FROM ({ATTR_SQL})",
)
def education_harmonise(spark, d):
    return standin(spark, d, ATTR_SQL).select("o_orderkey", R.harmonise_education("education").alias("education"))


@query(
    "insurance_harmonise",
    "SELECT o_orderkey, CASE WHEN health_insurance IN ('government insurance', 'medicare', 'medicaid') THEN 'government insurance' "
    "WHEN health_insurance IN ('other', 'rather not say') THEN 'other' ELSE health_insurance END AS health_insurance "
    f"FROM ({ATTR_SQL})",
)
def insurance_harmonise(spark, d):
    return standin(spark, d, ATTR_SQL).select("o_orderkey", R.harmonise_insurance("health_insurance").alias("health_insurance"))


# Participant attributes (stand-in): cohort from segment (one segment has no
# cohort, one an empty one), diagnosis answers from nation, DMT from balance.
PARTICIPANT_SQL = """
SELECT CAST(c_custkey AS STRING) AS healthCode,
       CASE c_mktsegment WHEN 'BUILDING' THEN 'control' WHEN 'AUTOMOBILE' THEN NULL
                         WHEN 'HOUSEHOLD' THEN '' ELSE 'ms_patient' END AS dataGroups,
       CASE WHEN c_nationkey < 5 THEN 'no' WHEN c_nationkey < 8 THEN 'notsure'
            WHEN c_nationkey < 15 THEN 'yes' END AS currentDiagnosis,
       CASE WHEN c_nationkey BETWEEN 10 AND 19 THEN CAST(1990 + c_nationkey AS STRING)
            WHEN c_nationkey = 20 THEN 'abc' END AS currentDiagnosisYear,
       CASE WHEN c_acctbal > 7000 THEN 'dmt' END AS currentDMT,
       CASE WHEN c_acctbal > 8000 THEN CAST(2000 + c_nationkey AS STRING) END AS firstDMTYear,
       CASE WHEN c_acctbal < 0 THEN 'low' END AS overallPhysicalAbility,
       c_nationkey IN (1, 2) AS referred_by_clinician,
       CASE WHEN c_nationkey IN (2, 9) THEN concat('EX', CAST(c_custkey AS STRING)) END AS externalId
FROM customer
"""
_P = duck(PARTICIPANT_SQL)
ERROR_CASE_SQL = f"""
CASE
  WHEN (dataGroups IS NULL OR dataGroups = '') AND currentDiagnosis IS NOT NULL AND currentDiagnosisYear IS NOT NULL
    THEN 'Ignore|dataGroups = NA and some MS related params'
  WHEN (dataGroups IS NULL OR dataGroups = '') AND currentDMT IS NOT NULL AND firstDMTYear IS NOT NULL
    THEN 'Ignore|dataGroups = NA and some MS related params'
  WHEN coalesce(dataGroups = 'control', false) AND (currentDMT IS NOT NULL
       OR NOT coalesce(currentDiagnosis IN ('no', 'notsure'), false)
       OR currentDiagnosisYear IS NOT NULL OR overallPhysicalAbility IS NOT NULL)
    THEN 'Ignore|dataGroups = control and some MS related params'
  WHEN coalesce(dataGroups = 'control', false) AND (coalesce(referred_by_clinician, false) OR externalId IS NOT NULL)
    THEN 'dataGroups = control and referred_by_clinician =T'
  WHEN dataGroups IS NULL OR dataGroups = '' THEN 'Ignore|dataGroups = NA'
END"""
REASSIGN_SQL = (
    f"CASE WHEN error IN ('Ignore|dataGroups = control and some MS related params', 'Ignore|dataGroups = NA and some MS related params', 'Ignore|dataGroups = NA') THEN 'Ignore' "
    f"WHEN error = 'dataGroups = control and referred_by_clinician =T' THEN 'ms_patient' ELSE dataGroups END"
)


@query("cohort_error_code", f"SELECT healthCode, dataGroups, {ERROR_CASE_SQL} AS error FROM ({_P})")
def cohort_error_code(spark, d):
    p = standin(spark, d, PARTICIPANT_SQL)
    return p.select("healthCode", "dataGroups", R.cohort_error_code().alias("error"))


@query(
    "cohort_reassign",
    f"SELECT healthCode, error, {REASSIGN_SQL} AS dataGroups FROM (SELECT *, {ERROR_CASE_SQL} AS error FROM ({_P}))",
)
def cohort_reassign(spark, d):
    p = standin(spark, d, PARTICIPANT_SQL).withColumn("error", R.cohort_error_code())
    return p.select("healthCode", "error", R.reassign_cohort("dataGroups", "error").alias("dataGroups"))


@query(
    "group_label",
    f"""
SELECT healthCode, CASE WHEN referred_by_clinician AND g = 'ms_patient' THEN '{R.GROUP_REFERRAL}'
  WHEN NOT referred_by_clinician AND g = 'ms_patient' THEN '{R.GROUP_PATIENT}'
  WHEN g = 'control' THEN '{R.GROUP_CONTROL}' END AS "group"
FROM (SELECT *, {REASSIGN_SQL.replace('ELSE dataGroups', 'ELSE dataGroups')} AS g FROM (SELECT *, {ERROR_CASE_SQL} AS error FROM ({_P})))
""",
)
def group_label(spark, d):
    p = standin(spark, d, PARTICIPANT_SQL).withColumn("error", R.cohort_error_code())
    p = p.withColumn("g", R.reassign_cohort("dataGroups", "error"))
    return p.select("healthCode", R.analysis_group("referred_by_clinician", "g").alias("group"))


@query(
    "years_since",
    f"SELECT healthCode, year(DATE '{AS_OF}') - TRY_CAST(currentDiagnosisYear AS DOUBLE) AS YearsSinceDiagnosis, "
    f"year(DATE '{AS_OF}') - TRY_CAST(firstDMTYear AS DOUBLE) AS YearsSinceFirstDMT FROM ({_P})",
)
def years_since(spark, d):
    p = standin(spark, d, PARTICIPANT_SQL)
    return p.select("healthCode", X.years_since("currentDiagnosisYear", AS_OF).alias("YearsSinceDiagnosis"),
                    X.years_since("firstDMTYear", AS_OF).alias("YearsSinceFirstDMT"))


# Postcode stand-in: nation name plays the zip, region the state (name and
# abbreviation); the 8-character prefix collides for nations 1 and 10-19.
ZIP_SQL = "SELECT n_name AS zip, CAST(n_regionkey AS STRING) AS state FROM nation"
STATES_SQL = "SELECT CAST(r_regionkey AS STRING) AS state, r_name AS `state.name` FROM region WHERE r_name <> 'ASIA'"
CUST_ZIP_SQL = "SELECT CAST(c_custkey AS STRING) AS healthCode, concat('NATION_', CAST(c_nationkey AS STRING), '9') AS zipcode FROM customer"


@query(
    "postcode_generalise",
    f"""
WITH z AS (SELECT z.zip, z.state, s."state.name" FROM ({duck(ZIP_SQL)}) z JOIN ({duck(STATES_SQL)}) s ON z.state = s.state),
pre AS (SELECT substring(zip, 1, 3 + 5) AS zipcode_firstThree, arg_min("state.name", zip) AS state,
               arg_min(state, zip) AS "state.abbr" FROM z GROUP BY 1)
SELECT c.healthCode, substring(c.zipcode, 1, 8) AS zipcode, pre.state, pre."state.abbr"
FROM ({duck(CUST_ZIP_SQL)}) c LEFT JOIN pre ON substring(c.zipcode, 1, 8) = pre.zipcode_firstThree
""",
)
def postcode_generalise(spark, d):
    from curatio.operators.joins import inner_lookup

    zips, states = standin(spark, d, ZIP_SQL), standin(spark, d, STATES_SQL)
    z = inner_lookup(zips, states, "state").withColumn("zipcode_firstThree", R.postcode_prefix("zip", 8))
    dim = z.groupBy("zipcode_firstThree").agg(
        A.first_in_order(F.struct(F.col("`state.name`").alias("s"), F.col("state").alias("a")), ["zip"]).alias("st")
    ).select("zipcode_firstThree", F.col("st.s").alias("state"), F.col("st.a").alias("state.abbr"))
    cu = standin(spark, d, CUST_ZIP_SQL).withColumn("zipcode_firstThree", R.postcode_prefix("zipcode", 8))
    out = E.left_lookup(cu, dim, "zipcode_firstThree")
    return out.withColumn("zipcode", F.col("zipcode_firstThree")).drop("zipcode_firstThree")


EXT_LIST_SQL = "SELECT concat('EX-', CAST(s_suppkey AS STRING)) AS id FROM supplier"


@query(
    "referral_from_list",
    f"SELECT healthCode, externalId, coalesce(externalId IN (SELECT replace(id, '-', '') FROM ({duck(EXT_LIST_SQL)})), false) "
    f"AS referred_by_clinician FROM ({_P})",
)
def referral_from_list(spark, d):
    p = standin(spark, d, PARTICIPANT_SQL).select("healthCode", "externalId")
    ids = standin(spark, d, EXT_LIST_SQL).select(F.regexp_replace("id", "-", "").alias("externalId"))
    return E.mark_member(p, ids, "externalId", "referred_by_clinician")


@query(
    "deidentify",
    f"SELECT recordId, healthCode, createdOn, userSharingScope, answer, score, rawData FROM ({_S})",
)
def deidentify(spark, d):
    s = standin(spark, d, SURVEY_SQL)
    return C.drop_if_present(s, "dataGroups", "externalId", "validationErrors", "substudyMemberships", "dayInStudy")


# --------------------------------------------------------------------------
# Composed jobs
# --------------------------------------------------------------------------

SURVEY_V1_SQL = (
    "SELECT recordId, healthCode, createdOn, userSharingScope, answer AS answer_v1, score, dataGroups, externalId, "
    f"validationErrors, substudyMemberships, dayInStudy, rawData FROM ({SURVEY_SQL}) WHERE score < 150000"
)
SURVEY_V2_SQL = f"SELECT * FROM ({SURVEY_SQL}) WHERE NOT (score < 150000)"


def _curate_oracle(src: str, start: str) -> str:
    return f"""
SELECT recordId, healthCode, createdOn, answer, score FROM ({src}) s
WHERE CAST(createdOn AS DATE) >= DATE '{start}'
  AND NOT EXISTS (SELECT 1 FROM ({_EXC}) x WHERE x.healthCode IS NOT DISTINCT FROM s.healthCode)
  AND NOT EXISTS (SELECT 1 FROM ({_WD}) w WHERE w.healthCode IS NOT DISTINCT FROM s.healthCode)
  AND userSharingScope = 'ALL_QUALIFIED_RESEARCHERS'
"""


SURVEY_SPEC = TableSpec(name="Survey", sources=[Source("survey")], date_col="createdOn")
SURVEY_TWO = TableSpec(
    name="Survey (two versions)",
    sources=[Source("survey_v1", {"answer_v1": "answer"}), Source("survey_v2")],
    date_col="createdOn",
)


@query("curate_standard", _curate_oracle(_S, ORDERS_START))
def curate_standard(spark, d):
    return curate(
        SURVEY_SPEC,
        {"survey": standin(spark, d, SURVEY_SQL)},
        standin(spark, d, EXCLUDED_SQL),
        standin(spark, d, WITHDREW_SQL),
        start=ORDERS_START,
    )


@query("align_and_union", _curate_oracle(_S, ORDERS_START))
def align_and_union(spark, d):
    frames = {"survey_v1": standin(spark, d, SURVEY_V1_SQL), "survey_v2": standin(spark, d, SURVEY_V2_SQL)}
    return curate(SURVEY_TWO, frames, standin(spark, d, EXCLUDED_SQL), standin(spark, d, WITHDREW_SQL),
                  start=ORDERS_START)


@query(
    "choice_answers",
    f"""
SELECT event_id AS recordId, CAST(answers AS JSON)::VARCHAR[] AS choices, to_json(CAST(answers AS JSON)::VARCHAR[])::VARCHAR AS document,
       sha256(to_json(CAST(answers AS JSON)::VARCHAR[])::VARCHAR) AS handle
FROM ({duck(CHOICE_SQL)}) WHERE json_valid(answers)
UNION ALL
SELECT event_id, NULL, NULL, NULL FROM ({duck(CHOICE_SQL)}) WHERE NOT json_valid(answers)
""",
)
def choice_answers(spark, d):
    return ATT.choice_documents(standin(spark, d, CHOICE_SQL), "answers", record="event_id").withColumnRenamed(
        "event_id", "recordId"
    )


# Trial stand-in: one trial per line item; the order key is the external id
# (mapped to the participant through the order crosswalk), line status the
# block, 'R' the correct answers, the price the duration in ms.
TRIALS_SQL = """
SELECT CAST(l_orderkey AS STRING) AS externalId, l_linestatus AS blockId, l_shipdate AS createdOn,
       CASE WHEN l_returnflag = 'R' THEN 'y' ELSE 'n' END AS accuracy, l_extendedprice AS durationMS
FROM lineitem
"""
CROSSWALK_SQL = "SELECT CAST(o_orderkey AS STRING) AS externalId, CAST(o_custkey AS STRING) AS healthCode FROM orders"
COHORT_SQL = "SELECT CAST(c_custkey AS STRING) AS healthCode FROM customer WHERE c_mktsegment <> 'AUTOMOBILE'"
TRIALS_START = "1996-01-01"


@query(
    "trial_block_summary",
    f"""
WITH t AS (SELECT t.*, cw.healthCode FROM ({duck(TRIALS_SQL)}) t
           LEFT JOIN (SELECT DISTINCT externalId, healthCode FROM ({duck(CROSSWALK_SQL)})) cw ON t.externalId = cw.externalId),
g AS (SELECT healthCode, blockId, count(*) AS numDigits,
             CASE WHEN count(createdOn) = count(*) THEN min(createdOn) END AS activityStartTime_GMT,
             CASE WHEN count(accuracy) = count(*) THEN CAST(count_if(accuracy = 'y') AS BIGINT) END AS numCorrect,
             round_even(avg(durationMS / 1000.0), 3) AS avgTime,
             round_even(stddev_samp(durationMS / 1000.0), 3) AS sdTime,
             coalesce(sum(durationMS / 1000.0), 0.0) AS totalTime
      FROM t GROUP BY healthCode, blockId)
SELECT healthCode, blockId, numDigits, activityStartTime_GMT, numCorrect,
       100.0 * round_even(numCorrect / numDigits, 2) AS percentCorrect, avgTime, sdTime,
       {present_sql('totalTime', 4)} AS totalTime
FROM g s
WHERE CAST(activityStartTime_GMT AS DATE) >= DATE '{TRIALS_START}'
  AND NOT EXISTS (SELECT 1 FROM ({_EXC}) x WHERE x.healthCode IS NOT DISTINCT FROM s.healthCode)
  AND NOT EXISTS (SELECT 1 FROM ({_WD}) w WHERE w.healthCode IS NOT DISTINCT FROM s.healthCode)
  AND EXISTS (SELECT 1 FROM ({duck(COHORT_SQL)}) c WHERE c.healthCode IS NOT DISTINCT FROM s.healthCode)
""",
)
def trial_block_summary(spark, d):
    out = trial_summary(
        standin(spark, d, TRIALS_SQL),
        standin(spark, d, CROSSWALK_SQL),
        standin(spark, d, EXCLUDED_SQL),
        standin(spark, d, WITHDREW_SQL),
        standin(spark, d, COHORT_SQL),
        start=TRIALS_START,
    )
    return out.withColumn("totalTime", present(F.col("totalTime"), 4))


# --------------------------------------------------------------------------
# B. sinks (write to a fresh folder under the checkpoint dir, read back)
# --------------------------------------------------------------------------

@query(
    "publish_inferred",
    "SELECT o_custkey, count(*) AS n_orders, max(o_orderdate) AS last_order FROM orders GROUP BY o_custkey",
)
def publish_inferred(spark, d):
    out = table(spark, d, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("n_orders"), F.max("o_orderdate").alias("last_order")
    )
    path = scratch(spark, "publish")
    PUB.publish(out, path)
    return spark.read.parquet(path)


@query(
    "publish_typed",
    "SELECT p_partkey, TRY_CAST(p_brand AS INTEGER) AS p_brand, CAST(p_size AS VARCHAR) AS p_size, "
    "p_retailprice, CAST(NULL AS VARCHAR) AS p_container FROM part",
)
def publish_typed(spark, d):
    path = scratch(spark, "publish-typed")
    PUB.publish_typed(table(spark, d, "part"), PART_TARGET, path, drop=["p_type"], strict=False)
    return spark.read.parquet(path)


# Every document is a file; the payloads of those without a label are missing.
ATTACH_SQL = (
    "SELECT CAST(d.doc_id AS STRING) AS handle, CASE WHEN l.doc_id IS NOT NULL THEN d.text END AS content "
    "FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id"
)
REFS_SQL = (
    "SELECT CAST(doc_id AS STRING) AS recordId, CAST(doc_id AS STRING) AS `file.json`, "
    "CASE WHEN doc_id % 3 = 0 THEN CAST(doc_id + 1 AS STRING) END AS `second.json`, lang FROM documents"
)


@query(
    "rehome_attachments",
    f"SELECT handle AS old_handle, sha256(content) AS new_handle FROM ({duck(ATTACH_SQL)}) WHERE content IS NOT NULL",
)
def rehome_attachments(spark, d):
    return ATT.rehome(standin(spark, d, ATTACH_SQL))


@query(
    "substitute_handles",
    f"WITH a AS (SELECT handle AS old_handle, sha256(content) AS new_handle FROM ({duck(ATTACH_SQL)})) "
    f"SELECT r.recordId, a1.new_handle AS \"file.json\", a2.new_handle AS \"second.json\", r.lang FROM ({duck(REFS_SQL)}) r "
    "LEFT JOIN a a1 ON r.\"file.json\" = a1.old_handle LEFT JOIN a a2 ON r.\"second.json\" = a2.old_handle",
)
def substitute_handles(spark, d):
    mapping = ATT.rehome(standin(spark, d, ATTACH_SQL))
    return ATT.substitute_handles(standin(spark, d, REFS_SQL), mapping, ["file.json", "second.json"])


@query(
    "json_documents",
    "SELECT DISTINCT sha256(doc) AS handle, doc AS document FROM (SELECT to_json(CAST(answers AS JSON)::VARCHAR[])::VARCHAR AS doc "
    f"FROM ({duck(CHOICE_SQL)}) WHERE json_valid(answers))",
)
def json_documents(spark, d):
    """The choice documents of all answer cells in their store; the second run adds none."""
    store = scratch(spark, "documents")
    for _ in range(2):
        ATT.store_documents(ATT.choice_documents(standin(spark, d, CHOICE_SQL), "answers", record="event_id"), store)
    return spark.read.parquet(store)


@query(
    "attachment_store",
    "SELECT DISTINCT sha256(text || chr(10)) AS handle, CAST(strlen(text) + 1 AS BIGINT) AS n_bytes FROM documents "
    "WHERE text IS NOT NULL AND doc_id IS NOT NULL",
)
def attachment_store(spark, d):
    """Every document as a file of its own, read as payloads into the content-addressed store; the second run adds none."""
    files, store = scratch(spark, "files"), scratch(spark, "store")
    docs = table(spark, d, "documents").where("text IS NOT NULL AND doc_id IS NOT NULL")
    one = docs.select(F.col("doc_id").cast("string").alias("handle"), F.col("text").alias("value"))
    write_attachments(one, files)
    payloads = attachment_files(spark, files, "*.txt", ATTACHMENT)
    for _ in range(2):
        ATT.store_payloads(payloads, payloads.select("handle").distinct(), store)
    return spark.read.parquet(store).select("handle", F.octet_length("content").cast("bigint").alias("n_bytes"))


PROVENANCE_SQL = (
    "SELECT '{target}' AS target, {used} AS used, 'curate_standard' AS executed, "
    "(SELECT count(*) FROM ({rows})) AS n_rows, TIMESTAMP '" + AS_OF + " 00:00:00' AS as_of"
)
_USED = "['survey', 'excluded', 'withdrew']"


@query("provenance_rows", PROVENANCE_SQL.format(target="Survey", used=_USED, rows=_curate_oracle(_S, ORDERS_START)))
def provenance_rows(spark, d):
    out = curate_standard(spark, d)
    return without_zone(PUB.provenance_with_count(out, "Survey", ["survey", "excluded", "withdrew"], "curate_standard", AS_OF))


def _release_runs(spark, d) -> str:
    """A release folder with two committed runs of two tables and a run that was killed between its tables."""
    root = scratch(spark, "release")
    lists = (standin(spark, d, EXCLUDED_SQL), standin(spark, d, WITHDREW_SQL))
    jobs = {"survey": ReleaseJob(SURVEY_SPEC, {"survey": standin(spark, d, SURVEY_SQL)}),
            "symptoms": ReleaseJob(SYMPTOMS_SPEC, {"symptoms": standin(spark, d, SYMPTOMS_SQL)})}
    early = {"survey": ReleaseJob(SURVEY_SPEC, {"survey": standin(spark, d, SURVEY_SQL + " WHERE o_orderkey % 2 = 0")})}
    release_set(early, *lists, root, "run-1", "curate_standard", AS_OF, start=ORDERS_START)
    PUB.publish(curate_standard(spark, d).limit(1), f"{root}/runs/run-2/survey")  # what a killed job leaves
    release_set(jobs, *lists, root, "run-2", "curate_standard", AS_OF, start=ORDERS_START)
    release_set(early, *lists, root, "run-2", "curate_standard", AS_OF, start=ORDERS_START)  # committed: nothing happens
    return root


SYMPTOMS_SPEC = TableSpec(name="symptoms", sources=[Source("symptoms")], date_col="createdOn", json_columns=["answer"])
SYMPTOMS_SQL = SURVEY_SQL.replace("o_orderpriority AS answer", "concat('[\"', o_orderpriority, '\"]') AS answer")
_SYMPTOMS = (f"SELECT * REPLACE (sha256(to_json(CAST(answer AS JSON)::VARCHAR[])::VARCHAR) AS answer) "
             f"FROM ({_curate_oracle(duck(SYMPTOMS_SQL), ORDERS_START)})")


@query(
    "release_manifest",
    PROVENANCE_SQL.format(target="survey", used="['survey']", rows=_curate_oracle(_S, ORDERS_START)) + ", 'run-2' AS run UNION ALL "
    + PROVENANCE_SQL.format(target="symptoms", used="['symptoms']", rows=_SYMPTOMS) + ", 'run-2'",
)
def release_manifest(spark, d):
    """Lineage rows of the current release, after an older run and one that was killed and run again."""
    return without_zone(MF.current(spark, _release_runs(spark, d)).drop("path", "committed"))


@query("release_table", f"SELECT recordId, healthCode, createdOn, answer, score FROM ({_SYMPTOMS})")
def release_table(spark, d):
    """A table of the current release, found by the manifest."""
    return MF.read_current(spark, _release_runs(spark, d), "symptoms")


# --------------------------------------------------------------------------
# Baseline characteristics on stand-in demographics and profiles
# --------------------------------------------------------------------------

_FLAG_COLS = ", ".join(
    f"o.o_orderpriority = '{p}' AS `race.json.answer.{lbl}`" for p, lbl in zip(PRIORITIES, RACE_FLAG_LABELS)
)
DEMOG_SQL = f"""
SELECT CAST(o.o_custkey AS STRING) AS healthCode,
       CASE WHEN c.c_nationkey IN (2, 9) THEN concat('EX', CAST(c.c_custkey AS STRING)) END AS externalId,
       CASE c.c_mktsegment WHEN 'BUILDING' THEN 'control' WHEN 'AUTOMOBILE' THEN 'other' ELSE 'ms_patient' END AS dataGroups,
       CASE o.o_orderstatus WHEN 'O' THEN 'SPONSORS_AND_PARTNERS' ELSE 'ALL_QUALIFIED_RESEARCHERS' END AS userSharingScope,
       o.o_orderdate AS `metadata.json.startDate`,
       'g' AS `metadata.json.dataGroups`,
       CAST(NULL AS STRING) AS substudyMemberships,
       CAST(o.o_orderkey AS STRING) AS recordId,
       CAST(NULL AS INT) AS dayInStudy,
       CASE WHEN o.o_totalprice > 200000 THEN 'Female' ELSE 'Male' END AS `gender.json.answer`,
       150.0 + CAST(o.o_orderkey AS DOUBLE) / 8.0 AS `height.json.answer`,
       (c.c_acctbal + 1000.0) / 10.0 AS `weight.json.answer`,
       concat(CAST(100 + c.c_nationkey AS STRING), CAST(o.o_orderkey AS STRING)) AS `zipcode.json.answer`,
       CASE o.o_orderpriority {' '.join(f"WHEN '{p}' THEN '{e}'" for p, e in zip(PRIORITIES, EDU_VALUES))} END AS `education.json.answer`,
       CASE o.o_orderpriority {' '.join(f"WHEN '{p}' THEN '{i}'" for p, i in zip(PRIORITIES, INS_VALUES))} END AS `health_insurance.json.answer`,
       o.o_orderstatus AS `employment.json.answer`,
       {_FLAG_COLS},
       o.o_orderkey AS __seq
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""
PROFILES_SQL = """
SELECT CAST(o.o_custkey AS STRING) AS healthCode,
       CASE WHEN c.c_nationkey IN (2, 9) THEN concat('EX', CAST(c.c_custkey AS STRING)) END AS externalId,
       CASE c.c_mktsegment WHEN 'MACHINERY' THEN 'control' WHEN 'BUILDING' THEN NULL ELSE 'ms_patient' END AS dataGroups,
       CASE o.o_orderstatus WHEN 'P' THEN 'sponsors_and_partners' ELSE 'all_qualified_researchers' END AS userSharingScope,
       CASE WHEN o.o_totalprice > 250000 THEN 'Female' END AS `demographics.gender`,
       160.0 + CAST(o.o_orderkey AS DOUBLE) / 4.0 AS `demographics.height`,
       (c.c_acctbal + 1200.0) / 10.0 AS `demographics.weight`,
       concat(CAST(100 + c.c_nationkey AS STRING), '77') AS `demographics.zipcode`,
       CASE WHEN o.o_orderstatus = 'F' THEN 'some_college' ELSE 'masters' END AS `demographics.education`,
       CASE WHEN c.c_acctbal > 4000 THEN 'Medicaid' ELSE 'employer' END AS `demographics.health_insurance`,
       o.o_orderpriority AS `demographics.employment`,
       concat('["', CASE WHEN o.o_totalprice > 300000 THEN 'asian","pacific_islander' ELSE 'caucasian' END, '"]') AS race,
       o.o_orderdate AS createdOn,
       CAST(CASE WHEN o.o_orderpriority = '5-LOW' THEN NULL ELSE 20 + year(o.o_orderdate) - 1995 END AS INT) AS age,
       CAST(o.o_orderkey AS STRING) AS recordId,
       concat('raw', CAST(o.o_orderkey AS STRING)) AS rawData,
       CASE WHEN o.o_orderstatus = 'F' THEN 'RRMS' END AS initialDiagnosis,
       CASE WHEN o.o_orderstatus = 'F' THEN '2001' END AS initialDiagnosisYear,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Yes' WHEN '2-HIGH' THEN 'No' WHEN '3-MEDIUM' THEN 'NotSure' END AS currentDiagnosis,
       CASE WHEN o.o_orderstatus = 'F' THEN CAST(1990 + c.c_nationkey AS STRING) WHEN c.c_nationkey = 20 THEN 'abc' END AS currentDiagnosisYear,
       CASE WHEN o.o_totalprice > 350000 THEN 'DMT-A' END AS currentDMT,
       CASE WHEN o.o_totalprice > 350000 THEN CAST(2000 + c.c_nationkey AS STRING) END AS firstDMTYear,
       CASE WHEN c.c_acctbal > 5000 THEN 'Yes' ELSE 'No' END AS msFamilyHistory,
       CASE WHEN o.o_orderstatus = 'O' AND c.c_acctbal < 0 THEN 'Mild' END AS overallPhysicalAbility,
       o.o_orderkey AS __seq
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
"""
ZIPS_SQL = """
SELECT concat(CAST(100 + s.s_nationkey AS STRING), CAST(s.s_suppkey AS STRING)) AS zip,
       CASE WHEN s.s_acctbal > 5000 THEN CAST(n.n_regionkey AS STRING) ELSE CAST(4 - n.n_regionkey AS STRING) END AS state
FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
"""
EXT_IDS_SQL = "SELECT concat('ex-', CAST(s_suppkey AS STRING)) AS id FROM supplier"
BASELINE_START = ORDERS_START

_DEMOG_FEATS = ["externalId", "dataGroups", "userSharingScope", "gender", "height", "weight", "zipcode",
                "education", "health_insurance", "employment", "race"]
_DIS_COLS = ["initialDiagnosis", "initialDiagnosisYear", "currentDiagnosis", "currentDiagnosisYear", "currentDMT",
             "firstDMTYear", "msFamilyHistory", "overallPhysicalAbility"]


def _baseline_oracle() -> str:
    race_case = RACE_CASE_DUCK
    flags = ", ".join(
        f"CASE WHEN bool_or(\"race.json.answer.{lbl}\") THEN '{lbl}' END" for lbl in RACE_FLAG_LABELS
    )
    latest_demo = ", ".join(
        f"arg_max({f}, (date_of_entry, src, __seq)) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in _DEMOG_FEATS
    )
    latest_dis = ", ".join(
        f"arg_max({f}, (date_of_entry, __seq)) FILTER (WHERE {f} IS NOT NULL) AS {f}" for f in _DIS_COLS[2:]
    )
    demog_keys = ", ".join(["healthCode", *_DEMOG_FEATS])
    dis_keys = ", ".join(["healthCode", *_DIS_COLS])
    lowered = ", ".join(f"lower({c}) AS {c}" for c in ["externalId", "dataGroups", "userSharingScope", "gender",
                                                        "zipcode", "education", "health_insurance", "employment", "race"])
    return f"""
WITH demog0 AS ({duck(DEMOG_SQL)}),
d1 AS (SELECT healthCode, externalId, dataGroups, userSharingScope, "gender.json.answer" AS gender,
              "height.json.answer" AS height, "weight.json.answer" AS weight, "zipcode.json.answer" AS zipcode,
              "education.json.answer" AS education, "health_insurance.json.answer" AS health_insurance,
              "employment.json.answer" AS employment, CAST("metadata.json.startDate" AS DATE) AS date_of_entry, __seq,
              {", ".join(f'"race.json.answer.{lbl}"' for lbl in RACE_FLAG_LABELS)}
       FROM demog0 WHERE dataGroups IN ('control', 'ms_patient')
         AND CAST("metadata.json.startDate" AS DATE) >= DATE '{BASELINE_START}'),
race AS (SELECT * FROM (SELECT healthCode, concat_ws(',', {flags}) AS race FROM d1 GROUP BY healthCode) WHERE race <> ''),
d2 AS (SELECT d1.healthCode, externalId, dataGroups, userSharingScope, gender, height, weight / 2.2 AS weight, zipcode,
              education, health_insurance, employment, date_of_entry, {race_case} AS race, __seq
       FROM d1 JOIN race ON d1.healthCode IS NOT DISTINCT FROM race.healthCode),
p0 AS ({duck(PROFILES_SQL)}),
p1 AS (SELECT healthCode, externalId, dataGroups, userSharingScope, "demographics.gender" AS gender,
              "demographics.height" AS height, "demographics.weight" AS weight, "demographics.zipcode" AS zipcode,
              "demographics.education" AS education, "demographics.health_insurance" AS health_insurance,
              "demographics.employment" AS employment, regexp_replace(race, '[\\["\\]]', '', 'g') AS race,
              CAST(createdOn AS DATE) AS date_of_entry, age, {", ".join(_DIS_COLS)}, __seq
       FROM p0 WHERE CAST(createdOn AS DATE) >= DATE '{BASELINE_START}'),
u AS (SELECT healthCode, externalId, dataGroups, userSharingScope, gender, height, weight, zipcode, education,
             health_insurance, employment, date_of_entry, race, __seq, 0 AS src FROM d2
      UNION ALL
      SELECT healthCode, externalId, dataGroups, userSharingScope, gender, height, weight, zipcode, education,
             health_insurance, employment, date_of_entry, race, __seq, 1 AS src FROM p1),
u2 AS (SELECT lower(healthCode) AS healthCode, {lowered}, round_even(height, 1) AS height, round_even(weight, 1) AS weight,
              date_of_entry, __seq, src FROM u),
kf AS (SELECT * FROM u2 QUALIFY row_number() OVER (PARTITION BY {demog_keys} ORDER BY src, __seq) = 1),
demo AS (SELECT healthCode, {latest_demo} FROM kf GROUP BY healthCode),
demo2 AS (SELECT *, coalesce(externalId IN (SELECT replace(id, '-', '') FROM ({duck(EXT_IDS_SQL)})), false) AS referred_by_clinician
          FROM demo WHERE dataGroups IN ('ms_patient', 'control')),
dis0 AS (SELECT lower(healthCode) AS healthCode, {", ".join(f"lower(CAST({c} AS VARCHAR)) AS {c}" for c in _DIS_COLS)},
                date_of_entry, __seq FROM p1),
dis1 AS (SELECT * FROM dis0 QUALIFY row_number() OVER (PARTITION BY {dis_keys} ORDER BY __seq) = 1),
dis AS (SELECT healthCode, {latest_dis} FROM dis1 GROUP BY healthCode),
age AS (SELECT healthCode, arg_max(age, (date_of_entry, s)) AS age FROM (
          SELECT healthCode, date_of_entry, age, min(__seq) AS s FROM p1 WHERE age IS NOT NULL GROUP BY ALL) GROUP BY healthCode),
j1 AS (SELECT coalesce(a.healthCode, b.healthCode) AS healthCode, a.* EXCLUDE (healthCode), b.* EXCLUDE (healthCode)
       FROM demo2 a FULL OUTER JOIN dis b ON a.healthCode IS NOT DISTINCT FROM b.healthCode),
j2 AS (SELECT coalesce(j1.healthCode, g.healthCode) AS healthCode, j1.* EXCLUDE (healthCode), g.age
       FROM j1 FULL OUTER JOIN age g ON j1.healthCode IS NOT DISTINCT FROM g.healthCode),
r1 AS (SELECT * REPLACE (
          CASE WHEN education IN ('some_high_school', 'high_school_diploma_ged') THEN 'high_school_diploma_ged'
               WHEN education IN ('some_college') THEN 'college_degree' ELSE education END AS education,
          TRY_CAST(height AS DOUBLE) AS height, TRY_CAST(weight AS DOUBLE) AS weight)
       FROM j2
       WHERE NOT EXISTS (SELECT 1 FROM ({_EXC}) x WHERE x.healthCode IS NOT DISTINCT FROM j2.healthCode)
         AND NOT EXISTS (SELECT 1 FROM ({_WD}) w WHERE w.healthCode IS NOT DISTINCT FROM j2.healthCode)),
r2 AS (SELECT *, {ERROR_CASE_SQL} AS error FROM r1),
r3 AS (SELECT * REPLACE ({REASSIGN_SQL} AS dataGroups,
          CASE WHEN health_insurance IN ('government insurance', 'medicare', 'medicaid') THEN 'government insurance'
               WHEN health_insurance IN ('other', 'rather not say') THEN 'other' ELSE health_insurance END AS health_insurance),
          year(DATE '{AS_OF}') - TRY_CAST(currentDiagnosisYear AS DOUBLE) AS YearsSinceDiagnosis,
          year(DATE '{AS_OF}') - TRY_CAST(firstDMTYear AS DOUBLE) AS YearsSinceFirstDMT
       FROM r2),
zd2 AS (SELECT z.zip, z.state, s."state.name" FROM ({duck(ZIPS_SQL)}) z JOIN ({duck(STATES_SQL)}) s ON z.state = s.state),
pre AS (SELECT substring(zip, 1, 3) AS zipcode_firstThree, arg_min("state.name", zip) AS state FROM zd2 GROUP BY 1)
SELECT r3.* EXCLUDE (zipcode, externalId, userSharingScope, error), substring(r3.zipcode, 1, 3) AS zipcode, pre.state
FROM r3 LEFT JOIN pre ON substring(r3.zipcode, 1, 3) = pre.zipcode_firstThree
WHERE r3.userSharingScope = 'all_qualified_researchers'
"""


@query("baseline_characteristics", _baseline_oracle())
def baseline_characteristics(spark, d):
    from curatio.plans.baseline import baseline_characteristics as job

    return job(
        standin(spark, d, DEMOG_SQL),
        standin(spark, d, PROFILES_SQL),
        standin(spark, d, EXT_IDS_SQL),
        standin(spark, d, EXCLUDED_SQL),
        standin(spark, d, WITHDREW_SQL),
        standin(spark, d, ZIPS_SQL),
        standin(spark, d, STATES_SQL),
        order="__seq",
        start=BASELINE_START,
        as_of=AS_OF,
    )


@query("curate_standard_stream", _curate_oracle(_S, ORDERS_START))
def curate_standard_stream(spark, d):
    """The standard curate steps run as a Structured Streaming query over
    survey files (written by Spark from the test tables), into a Parquet sink."""
    from curatio.streaming.curate_stream import start_curate_stream

    base = scratch(spark, "stream")
    src = standin(spark, d, SURVEY_SQL)
    src.write.parquet(f"{base}/source")
    q = start_curate_stream(
        spark, f"{base}/source", src.schema, SURVEY_SPEC,
        standin(spark, d, EXCLUDED_SQL), standin(spark, d, WITHDREW_SQL),
        f"{base}/sink", f"{base}/checkpoint", start=ORDERS_START,
    )
    q.awaitTermination()
    return spark.read.parquet(f"{base}/sink")
