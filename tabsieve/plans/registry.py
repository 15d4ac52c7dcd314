"""Registered queries: one per operator of the inventory, each over whole
driver tables (or views derived from them), each with the DuckDB SQL that
computes the same answer independently.

Floating results are rounded to a fixed number of places on both sides
(summation order differs between engines); nothing else is changed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COLUMN
from ..functions.stats import inverse_normal_sql
from ..operators import profile as prof
from ..operators import quality as qual
from ..operators import schema as sch
from .views import oracle_with, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def stable(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round floating columns for the cross-engine comparison."""
    conv = {f.name: F.round(F.col(f.name), digits) for f in df.schema.fields
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(conv) if conv else df


def R(sql: str, cols: list[str], digits: int = 6) -> str:
    """Round ``cols`` of a DuckDB query (``+ 0.0`` folds -0.0 into 0.0)."""
    if not cols:
        return sql
    rep = ", ".join(f'round("{c}", {digits}) + 0.0 AS "{c}"' for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{sql}\n) AS _q"


def register(name: str, sql: str | None = None, digits: int = 6):
    def deco(fn):
        QUERIES[name] = lambda spark, sf_dir: stable(fn(spark, sf_dir), digits)
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def union_sql(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# =========================================================== A1 numeric profile

def numeric_profile_sql(tbl: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        x = f"CAST({c} AS DOUBLE)"
        parts.append(f"""SELECT '{c}' AS column_name, count({x}) AS "count", avg({x}) AS mean,
            stddev_samp({x}) AS std, min({x}) AS "min", quantile_cont({x}, 0.25) AS q25,
            quantile_cont({x}, 0.5) AS q50, quantile_cont({x}, 0.75) AS q75, max({x}) AS "max",
            max({x}) - min({x}) AS "range", count(*) - count({x}) AS missing_count,
            CAST((count(*) - count({x})) * 100.0 / count(*) AS DOUBLE) AS missing_pct,
            skewness({x}) AS skewness, kurtosis({x}) AS kurtosis FROM {tbl}""")
    return union_sql(parts)


NUM_PROFILE_COLS = ["mean", "std", "min", "q25", "q50", "q75", "max", "range", "missing_pct",
                    "skewness", "kurtosis"]
LINEITEM_NUM = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("a01_numeric_profile_customer",
          R(oracle_with(numeric_profile_sql("customer_dirty", ["c_acctbal", "c_nationkey"]), "customer_dirty"),
            NUM_PROFILE_COLS))
def _a01c(spark, d):
    return prof.numeric_profile(table(spark, d, "customer_dirty"), id_column="c_custkey")


@register("a01_numeric_profile_lineitem", R(numeric_profile_sql("lineitem", LINEITEM_NUM), NUM_PROFILE_COLS, 4),
          digits=4)
def _a01l(spark, d):
    return prof.numeric_profile(table(spark, d, "lineitem"), cols=LINEITEM_NUM)


# =========================================================== A2 categorical profile

def categorical_profile_sql(tbl: str, cols: list[str]) -> str:
    long = union_sql([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {tbl}" for c in cols])
    return f"""WITH long AS ({long}),
    vc AS (SELECT column_name, value, count(*) AS cnt FROM long GROUP BY column_name, value),
    top AS (SELECT column_name, value AS top, cnt AS freq FROM (
              SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY cnt DESC, value) AS rn
              FROM vc WHERE value IS NOT NULL) AS t WHERE rn = 1),
    agg AS (SELECT column_name,
              CAST(coalesce(sum(cnt) FILTER (WHERE value IS NOT NULL), 0) AS BIGINT) AS "count",
              count(value) AS "unique",
              CAST(coalesce(sum(cnt) FILTER (WHERE value IS NULL), 0) AS BIGINT) AS missing_count
            FROM vc GROUP BY column_name),
    n AS (SELECT count(*) AS n_rows FROM {tbl})
    SELECT agg.column_name, agg."count", agg."unique", top.top, top.freq, agg.missing_count,
           CAST(agg.missing_count * 100.0 / n.n_rows AS DOUBLE) AS missing_pct,
           agg."unique" AS unique_count, CAST(agg."unique" * 100.0 / n.n_rows AS DOUBLE) AS cardinality_pct
    FROM agg LEFT JOIN top ON agg.column_name = top.column_name, n"""


@register("a02_categorical_profile_customer",
          R(oracle_with(categorical_profile_sql("customer_dirty", ["c_mktsegment", "c_name"]), "customer_dirty"),
            ["missing_pct", "cardinality_pct"]))
def _a02c(spark, d):
    return prof.categorical_profile(table(spark, d, "customer_dirty"))


@register("a02_categorical_profile_orders",
          R(categorical_profile_sql("orders", ["o_orderstatus", "o_orderpriority"]),
            ["missing_pct", "cardinality_pct"]))
def _a02o(spark, d):
    return prof.categorical_profile(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


# =========================================================== A4, A6, F3 nulls

CUSTOMER_DIRTY_COLS = ["c_custkey", "c_acctbal", "c_mktsegment", "c_nationkey", "c_name"]


def null_counts_sql(tbl: str, cols: list[str]) -> str:
    return union_sql([f"""SELECT '{c}' AS column_name, count(*) - count({c}) AS missing_count,
                          count(*) AS n_rows FROM {tbl}""" for c in cols])


@register("a04_null_counts", oracle_with(null_counts_sql("customer_dirty", CUSTOMER_DIRTY_COLS), "customer_dirty"))
def _a04(spark, d):
    return prof.null_counts(table(spark, d, "customer_dirty"))


@register("f03_columns_with_nulls", oracle_with(
    f"SELECT * FROM ({null_counts_sql('customer_dirty', CUSTOMER_DIRTY_COLS)}) AS t WHERE missing_count > 0",
    "customer_dirty"))
def _f03(spark, d):
    return prof.columns_with_nulls(table(spark, d, "customer_dirty"))


@register("a05_missing_report", oracle_with(f"""
    SELECT column_name, missing_count, round_even(missing_count / n_rows, 4) AS missing_fraction,
           CASE WHEN round_even(missing_count / n_rows, 4) >= 0.30 THEN 'CRITICAL'
                WHEN round_even(missing_count / n_rows, 4) >= 0.05 THEN 'WARNING' ELSE 'INFO' END AS severity
    FROM ({null_counts_sql('customer_dirty', CUSTOMER_DIRTY_COLS)}) AS t WHERE missing_count > 0""",
                                          "customer_dirty"))
def _a05(spark, d):
    return qual.missing_report(table(spark, d, "customer_dirty"))


@register("a06_overall_missing_pct", R(oracle_with(f"""
    SELECT CAST(sum(missing_count) * 100.0 / (max(n_rows) * 5) AS DOUBLE) AS missing_pct_overall,
           CAST(sum(missing_count) AS BIGINT) AS missing_total
    FROM ({null_counts_sql('customer_dirty', CUSTOMER_DIRTY_COLS)}) AS t""", "customer_dirty"),
    ["missing_pct_overall"]))
def _a06(spark, d):
    return prof.overall_missing_pct(table(spark, d, "customer_dirty"))


# =========================================================== A7-A10 duplicates

DUP_COLS = "l_returnflag, l_linestatus, l_linenumber, l_quantity"


@register("a07_duplicate_summary", R(oracle_with("""
    SELECT count(*) AS n_rows,
           (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem_dup) AS d) AS n_distinct,
           count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem_dup) AS d) AS n_duplicates,
           CAST((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem_dup) AS d)) * 100.0 / count(*)
                AS DOUBLE) AS duplicate_pct
    FROM lineitem_dup""", "lineitem_dup"), ["duplicate_pct"]))
def _a07(spark, d):
    return qual.duplicate_summary(table(spark, d, "lineitem_dup"))


_DUP_MEMBERS = f"""
    SELECT {DUP_COLS}, row_number() OVER (PARTITION BY {DUP_COLS}) AS copy_no,
           count(*) OVER (PARTITION BY {DUP_COLS}) AS copies
    FROM lineitem_dup"""


@register("a09_duplicate_rows", oracle_with(
    f"SELECT {DUP_COLS}, copy_no FROM ({_DUP_MEMBERS}) AS t WHERE copies > 1", "lineitem_dup"))
def _a09(spark, d):
    return qual.duplicate_rows(table(spark, d, "lineitem_dup"))


@register("a10_later_copies", oracle_with(
    f"SELECT {DUP_COLS}, copy_no FROM ({_DUP_MEMBERS}) AS t WHERE copy_no > 1", "lineitem_dup"))
def _a10(spark, d):
    return qual.later_copies(table(spark, d, "lineitem_dup"))


# =========================================================== A11, F4 outliers

def iqr_bounds_sql(tbl: str, cols: list[str]) -> str:
    return union_sql([f"""SELECT '{c}' AS column_name, quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1,
                          quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM {tbl}""" for c in cols])


def iqr_summary_sql(tbl: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name,
            count(*) FILTER (WHERE CAST(t.{c} AS DOUBLE) < b.lower_bound OR CAST(t.{c} AS DOUBLE) > b.upper_bound)
              AS "count",
            CAST(count(*) FILTER (WHERE CAST(t.{c} AS DOUBLE) < b.lower_bound OR CAST(t.{c} AS DOUBLE) > b.upper_bound)
              * 100.0 / count(*) AS DOUBLE) AS percentage,
            any_value(b.lower_bound) AS lower_bound, any_value(b.upper_bound) AS upper_bound,
            any_value(b.q1) AS q1, any_value(b.q3) AS q3, any_value(b.iqr) AS iqr
            FROM {tbl} AS t, bounds AS b WHERE b.column_name = '{c}'""")
    return f"""WITH q AS ({iqr_bounds_sql(tbl, cols)}),
    bounds AS (SELECT column_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound,
                      q3 + 1.5 * (q3 - q1) AS upper_bound FROM q)
    SELECT *, percentage > 10.0 AS high_outliers FROM ({union_sql(parts)}) AS s"""


@register("a11_iqr_outliers", R(iqr_summary_sql("events", ["user_id", "value"]),
                                ["percentage", "lower_bound", "upper_bound", "q1", "q3", "iqr"]))
def _a11(spark, d):
    return qual.iqr_outlier_summary(table(spark, d, "events"), exclude=["event_id"])


@register("a11_iqr_outliers_lineitem", R(iqr_summary_sql("lineitem", LINEITEM_NUM),
                                         ["percentage", "lower_bound", "upper_bound", "q1", "q3", "iqr"], 4),
          digits=4)
def _a11l(spark, d):
    return qual.iqr_outlier_summary(table(spark, d, "lineitem"), cols=LINEITEM_NUM)


@register("f04_outlier_rows", R(f"""
    WITH q AS ({iqr_bounds_sql('events', ['value'])}),
    b AS (SELECT q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound FROM q)
    SELECT e.event_id, 'value' AS column_name, e.value, b.lower_bound, b.upper_bound
    FROM events e, b WHERE e.value < b.lower_bound OR e.value > b.upper_bound""",
    ["value", "lower_bound", "upper_bound"]))
def _f04(spark, d):
    ev = table(spark, d, "events")
    return prof.outlier_rows(ev, qual.fit_iqr_bounds(ev, ["value"]), key="event_id")


# =========================================================== A12-A18

@register("a12_value_counts", R("""
    SELECT o_orderpriority AS value, count(*) AS "count",
           count(*) / sum(count(*)) OVER () AS share
    FROM orders GROUP BY o_orderpriority""", ["share"]))
def _a12(spark, d):
    return prof.value_counts(table(spark, d, "orders"), "o_orderpriority")


@register("a13_target_distribution", R(oracle_with("""
    SELECT is_purchase, count(*) AS "count", count(*) * 100.0 / sum(count(*)) OVER () AS percent
    FROM events_labeled GROUP BY is_purchase""", "events_labeled"), ["percent"]))
def _a13(spark, d):
    return prof.target_distribution(table(spark, d, "events_labeled"), "is_purchase")


@register("a14_class_counts", """
    WITH c AS (SELECT CAST(quality AS INTEGER) AS label, count(*) AS cnt FROM labels
               WHERE quality IS NOT NULL GROUP BY 1),
    g AS (SELECT CAST(unnest(range(0, (SELECT max(label) FROM c) + 1)) AS INTEGER) AS label)
    SELECT g.label, coalesce(c.cnt, 0) AS "count" FROM g LEFT JOIN c ON g.label = c.label""")
def _a14(spark, d):
    return prof.class_counts(table(spark, d, "labels"), "quality")


@register("a15_min_max", union_sql([
    f"""SELECT '{c}' AS column_name, CAST(min({c}) AS DOUBLE) AS "min", CAST(max({c}) AS DOUBLE) AS "max"
        FROM lineitem""" for c in LINEITEM_NUM]))
def _a15(spark, d):
    return prof.min_max(table(spark, d, "lineitem"), LINEITEM_NUM)


def distinct_preview_sql(tbl: str, cols: list[str], k: int = 4) -> str:
    long = union_sql([f"SELECT DISTINCT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value FROM {tbl} "
                      f"WHERE {c} IS NOT NULL" for c in cols])
    return f"""SELECT column_name, n_distinct, CAST(value_rank AS INTEGER) AS value_rank, value FROM (
        SELECT column_name, value, count(*) OVER (PARTITION BY column_name) AS n_distinct,
               row_number() OVER (PARTITION BY column_name ORDER BY value) AS value_rank
        FROM ({long}) AS l) AS t WHERE value_rank <= {k}"""


@register("a16_distinct_preview", distinct_preview_sql(
    "orders", ["o_orderstatus", "o_orderpriority", "o_custkey"]))
def _a16(spark, d):
    return prof.distinct_preview(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority", "o_custkey"])


@register("a17_conditional_mean", R(oracle_with(
    "SELECT is_purchase, avg(value) AS mean_value FROM events_labeled GROUP BY is_purchase",
    "events_labeled"), ["mean_value"]))
def _a17(spark, d):
    return prof.conditional_mean(table(spark, d, "events_labeled"), "value", "is_purchase")


@register("a18_shape_kinds", oracle_with("""
    SELECT kind, n_columns, (SELECT count(*) FROM customer_dirty) AS n_rows
    FROM (VALUES ('categorical', 2), ('numeric', 3)) AS k(kind, n_columns)""", "customer_dirty"))
def _a18(spark, d):
    return prof.shape_and_kinds(table(spark, d, "customer_dirty"))


# =========================================================== P1, P3, P4, P7, P9

CUSTOMER_EXPECTED = ["c_custkey", "c_name", "c_acctbal", "c_mktsegment", "c_phone"]


@register("p01_schema_check", """
    SELECT * FROM (VALUES ('column', 'c_custkey', 'ok'), ('column', 'c_name', 'ok'),
        ('column', 'c_acctbal', 'ok'), ('column', 'c_mktsegment', 'ok'), ('column', 'c_phone', 'missing'),
        ('column', 'c_nationkey', 'extra')) AS v("check", column_name, status)
    UNION ALL
    SELECT 'rows', NULL, CASE WHEN count(*) > 0 THEN 'ok' ELSE 'empty' END FROM customer""")
def _p01(spark, d):
    return sch.validate_schema(table(spark, d, "customer"), CUSTOMER_EXPECTED)


@register("p03_coerce_int", oracle_with("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority,
           CAST(trunc(coalesce(TRY_CAST(o_totalprice_text AS DOUBLE), 0.0)) AS BIGINT) AS o_totalprice_text
    FROM orders_text""", "orders_text"))
def _p03(spark, d):
    return sch.coerce_to_int(table(spark, d, "orders_text"), ["o_totalprice_text", "not_there"])


@register("p04_drop_columns", "SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate FROM orders")
def _p04(spark, d):
    return sch.drop_columns(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


@register("p07_sanitize", R(oracle_with("""
    SELECT c_custkey, CASE WHEN isinf(c_acctbal) OR isnan(c_acctbal) OR c_acctbal IS NULL THEN 0.0
                           ELSE c_acctbal END AS c_acctbal, c_nationkey
    FROM customer_inf""", "customer_inf"), ["c_acctbal"]))
def _p07(spark, d):
    return sch.sanitize(table(spark, d, "customer_inf"))


@register("p07_sanitize_counts", oracle_with("""
    SELECT 'c_acctbal' AS column_name, count(*) FILTER (WHERE isinf(c_acctbal)) AS n_infinite,
           count(*) FILTER (WHERE c_acctbal IS NULL OR isnan(c_acctbal)) AS n_missing
    FROM customer_inf""", "customer_inf"))
def _p07c(spark, d):
    return sch.sanitize_counts(table(spark, d, "customer_inf"))


@register("p09_head", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5")
def _p09h(spark, d):
    return prof.head(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


@register("p09_tail", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey DESC LIMIT 5")
def _p09t(spark, d):
    return prof.tail(table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")


# =========================================================== C1-C10 cleaning

from ..operators import clean as cln  # noqa: E402
from ..operators import split as spl  # noqa: E402


@register("c01_drop_duplicates", oracle_with("SELECT DISTINCT * FROM lineitem_dup", "lineitem_dup"))
def _c01(spark, d):
    return cln.drop_duplicate_rows(table(spark, d, "lineitem_dup"))


@register("c02_impute_mean", R(oracle_with("""
    SELECT c_custkey,
           coalesce(CAST(c_acctbal AS DOUBLE), (SELECT avg(c_acctbal) FROM customer_dirty)) AS c_acctbal,
           coalesce(CAST(c_nationkey AS DOUBLE), (SELECT avg(c_nationkey) FROM customer_dirty)) AS c_nationkey
    FROM customer_dirty""", "customer_dirty"), ["c_acctbal", "c_nationkey"]))
def _c02(spark, d):
    df = table(spark, d, "customer_dirty").select("c_custkey", "c_acctbal", "c_nationkey")
    return cln.apply_impute(df, cln.fit_numeric_impute(df, ["c_acctbal", "c_nationkey"], "mean"))


@register("c02_impute_median", R(oracle_with("""
    SELECT c_custkey,
           coalesce(CAST(c_acctbal AS DOUBLE), (SELECT quantile_cont(c_acctbal, 0.5) FROM customer_dirty)) AS c_acctbal,
           coalesce(CAST(c_nationkey AS DOUBLE),
                    (SELECT quantile_cont(CAST(c_nationkey AS DOUBLE), 0.5) FROM customer_dirty)) AS c_nationkey
    FROM customer_dirty""", "customer_dirty"), ["c_acctbal", "c_nationkey"]))
def _c02m(spark, d):
    df = table(spark, d, "customer_dirty").select("c_custkey", "c_acctbal", "c_nationkey")
    return cln.apply_impute(df, cln.fit_numeric_impute(df, ["c_acctbal", "c_nationkey"], "median"))


@register("c03_impute_mode", oracle_with("""
    SELECT c_custkey, coalesce(c_mktsegment, (
        SELECT value FROM (SELECT c_mktsegment AS value, count(*) AS n FROM customer_dirty
                           WHERE c_mktsegment IS NOT NULL GROUP BY 1) AS m
        ORDER BY n DESC, value LIMIT 1)) AS c_mktsegment
    FROM customer_dirty""", "customer_dirty"))
def _c03(spark, d):
    df = table(spark, d, "customer_dirty").select("c_custkey", "c_mktsegment")
    return cln.apply_impute(df, categorical=cln.fit_mode_impute(df, ["c_mktsegment"]))


def _one_hot_sql(levels: dict[str, list[str]], key: str, tbl: str) -> str:
    cols = [f"CAST(coalesce({c} = '{lv}', false) AS INTEGER) AS \"{c}_{lv}\""
            for c, lvs in levels.items() for lv in lvs[1:]]
    return f"SELECT {key}, {', '.join(cols)} FROM {tbl}"


SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@register("c05_one_hot", oracle_with(_one_hot_sql({"c_mktsegment": SEGMENTS}, "c_custkey", "customer_dirty"),
                                     "customer_dirty"))
def _c05(spark, d):
    df = table(spark, d, "customer_dirty").select("c_custkey", "c_mktsegment")
    return cln.apply_one_hot(df, cln.fit_one_hot(df, ["c_mktsegment"]))


@register("c05_one_hot_orders", """
    SELECT o_orderkey, o_totalprice,
        CAST(o_orderstatus = 'O' AS INTEGER) AS o_orderstatus_O,
        CAST(o_orderstatus = 'P' AS INTEGER) AS o_orderstatus_P,
        CAST(o_orderpriority = '2-HIGH' AS INTEGER) AS "o_orderpriority_2-HIGH",
        CAST(o_orderpriority = '3-MEDIUM' AS INTEGER) AS "o_orderpriority_3-MEDIUM",
        CAST(o_orderpriority = '4-NOT SPECIFIED' AS INTEGER) AS "o_orderpriority_4-NOT SPECIFIED",
        CAST(o_orderpriority = '5-LOW' AS INTEGER) AS "o_orderpriority_5-LOW"
    FROM orders""")
def _c05o(spark, d):
    df = table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    return cln.apply_one_hot(df, cln.fit_one_hot(df, ["o_orderstatus", "o_orderpriority"]))


@register("c08_iqr_bounds", R(f"""
    SELECT column_name, q1, q3, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_bound, q3 + 1.5 * (q3 - q1) AS upper_bound
    FROM ({iqr_bounds_sql('events', ['value', 'user_id'])}) AS q""",
    ["q1", "q3", "iqr", "lower_bound", "upper_bound"]))
def _c08(spark, d):
    return qual.fit_iqr_bounds(table(spark, d, "events"), ["value", "user_id"])


@register("c09_flag_outliers", f"""
    WITH q AS ({iqr_bounds_sql('events', ['value', 'user_id'])}),
    b AS (SELECT column_name, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM q)
    SELECT e.event_id, CAST(
        coalesce(e.value < bv.lo OR e.value > bv.hi, false)
        OR coalesce(CAST(e.user_id AS DOUBLE) < bu.lo OR CAST(e.user_id AS DOUBLE) > bu.hi, false) AS INTEGER)
        AS is_outlier
    FROM events e, b bv, b bu WHERE bv.column_name = 'value' AND bu.column_name = 'user_id'""")
def _c09(spark, d):
    ev = table(spark, d, "events")
    b = cln.fit_outlier_bounds(ev, ["value", "user_id"])
    return cln.flag_outliers(ev, b).select("event_id", "is_outlier")


@register("c10_log1p", R("""
    SELECT c_custkey, c_acctbal,
        CASE WHEN c_acctbal = -1 THEN CAST('-Infinity' AS DOUBLE)
             WHEN c_acctbal < -1 THEN CAST('NaN' AS DOUBLE) ELSE ln(1 + c_acctbal) END AS c_acctbal_log
    FROM customer""", ["c_acctbal", "c_acctbal_log"]))
def _c10(spark, d):
    return cln.log1p_columns(table(spark, d, "customer").select("c_custkey", "c_acctbal"), ["c_acctbal"])


# =========================================================== C6, C7, L5, L6 splits and folds

def _quota_sql(counts_cte: str, size: str, n_col: str, out: str) -> str:
    return f"""(SELECT cls, {n_col}, base + CASE WHEN row_number() OVER (ORDER BY rem DESC, cls)
                     <= {size} - sum(base) OVER () THEN 1 ELSE 0 END AS {out}
               FROM (SELECT *, ({size} * {n_col}) // (sum({n_col}) OVER ()) AS base,
                            ({size} * {n_col}) % (sum({n_col}) OVER ()) AS rem FROM {counts_cte}) AS x)"""


SPLIT_SQL = oracle_with(f"""
    WITH c AS (SELECT is_purchase AS cls, count(*) AS n FROM events_labeled GROUP BY 1),
    t AS {_quota_sql('c', '500', 'n', 'tq')},
    r AS (SELECT cls, n - tq AS rest, tq FROM t),
    dv AS {_quota_sql('r', '610', 'rest', 'dq')},
    q AS (SELECT r.cls, r.tq, dv.dq FROM r JOIN dv ON r.cls = dv.cls),
    ranked AS (SELECT e.*, row_number() OVER (PARTITION BY is_purchase
                   ORDER BY md5(CAST(event_id AS VARCHAR) || '-42'), event_id) - 1 AS rk FROM events_labeled e)
    SELECT ranked.event_id, ranked.user_id, ranked.event_type, ranked.value, ranked.is_purchase,
           CASE WHEN rk < tq THEN 'test' WHEN rk < tq + dq THEN 'dev' ELSE 'train' END AS split
    FROM ranked JOIN q ON ranked.is_purchase = q.cls""", "events_labeled")


def _split_events(spark, d):
    return spl.stratified_split(table(spark, d, "events_labeled"), "event_id", "is_purchase", 500, 610, "-42")


@register("c06_stratified_split", R(SPLIT_SQL, ["value"]))
def _c06(spark, d):
    return _split_events(spark, d)


@register("c07_split_report", R(f"""
    WITH s AS ({SPLIT_SQL.replace('WITH ', 'WITH ', 1)}),
    per AS (SELECT split, is_purchase, count(*) AS "count" FROM s GROUP BY 1, 2
            UNION ALL SELECT 'full', is_purchase, count(*) FROM s GROUP BY 2)
    SELECT split, is_purchase, "count", "count" / sum("count") OVER (PARTITION BY split) AS share,
           CAST(sum("count") OVER (PARTITION BY split) AS BIGINT) AS split_rows FROM per""", ["share"]))
def _c07(spark, d):
    return spl.split_report(_split_events(spark, d), "is_purchase")


@register("l05_class_weights", R("""
    SELECT l.*, (SELECT count(*) FROM labels) / (2.0 * c.n) AS weight
    FROM labels l JOIN (SELECT quality, count(*) AS n FROM labels GROUP BY 1) c ON l.quality = c.quality""",
    ["weight"]))
def _l05(spark, d):
    return spl.class_weights(table(spark, d, "labels"), "quality")


@register("l06_stratified_folds", oracle_with("""
    SELECT event_id, user_id, event_type, value, is_purchase, CAST((row_number() OVER (PARTITION BY is_purchase
               ORDER BY md5(CAST(event_id AS VARCHAR) || '-42'), event_id) - 1) % 10 AS INTEGER) AS fold
    FROM events_labeled""", "events_labeled"))
def _l06(spark, d):
    return spl.stratified_folds(table(spark, d, "events_labeled"), "event_id", "is_purchase", 10, "-42")


# =========================================================== T1-T11 statistical tests

from ..operators import stat_tests as st  # noqa: E402


def _long_sql(tbl: str, cols: list[str], extra: str = "", where: str = "") -> str:
    w = f" AND {where}" if where else ""
    return union_sql([f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x{extra} FROM {tbl} "
                      f"WHERE {c} IS NOT NULL{w}" for c in cols])


EV_COLS = ["value", "user_id"]


@register("t01_normality_jb", R(f"""
    WITH s AS ({_long_sql('events', EV_COLS)}),
    m AS (SELECT column_name, count(*) AS n, avg(x) AS mu FROM s GROUP BY 1),
    c AS (SELECT s.column_name, any_value(m.n) AS n, avg(power(x - mu, 2)) AS m2, avg(power(x - mu, 3)) AS m3,
                 avg(power(x - mu, 4)) AS m4 FROM s JOIN m ON s.column_name = m.column_name GROUP BY 1),
    k AS (SELECT column_name, n, m3 / power(m2, 1.5) AS skewness_pop, m4 / (m2 * m2) - 3 AS kurtosis_pop FROM c)
    SELECT column_name, 'Jarque-Bera' AS test, n, skewness_pop, kurtosis_pop,
           n / 6.0 * (skewness_pop * skewness_pop + kurtosis_pop * kurtosis_pop / 4.0) AS statistic,
           exp(-(n / 6.0 * (skewness_pop * skewness_pop + kurtosis_pop * kurtosis_pop / 4.0)) / 2.0) AS p_value,
           exp(-(n / 6.0 * (skewness_pop * skewness_pop + kurtosis_pop * kurtosis_pop / 4.0)) / 2.0) >= 0.05 AS normal
    FROM k""", ["skewness_pop", "kurtosis_pop", "statistic", "p_value"], 4), digits=4)
def _t01(spark, d):
    return st.normality_jb(table(spark, d, "events"), EV_COLS)


@register("t01_normality_order", R(f"""
    WITH s AS ({_long_sql('events', EV_COLS)}),
    r AS (SELECT column_name, x, count(*) OVER (PARTITION BY column_name) AS n,
                 (row_number() OVER (PARTITION BY column_name ORDER BY x) - CAST(0.375 AS DOUBLE))
                   / (count(*) OVER (PARTITION BY column_name) + CAST(0.25 AS DOUBLE)) AS p FROM s),
    m AS (SELECT column_name, x, n, {inverse_normal_sql('p')} AS m FROM r)
    SELECT column_name, 'Shapiro-Francia' AS test, any_value(n) AS n, corr(x, m) * corr(x, m) AS statistic
    FROM m GROUP BY 1""", ["statistic"], 8), digits=8)
def _t01o(spark, d):
    """All columns but p, whose tail SQL has no function for (tests hold it)."""
    return st.normality_order(table(spark, d, "events"), EV_COLS).drop("p_value", "normal")



@register("t02_mean_std_error", R(f"""
    SELECT column_name, count(*) AS n, avg(x) AS mean, stddev_samp(x) / sqrt(count(*)) AS std_error
    FROM ({_long_sql('events', EV_COLS)}) AS s GROUP BY 1""", ["mean", "std_error"]))
def _t02(spark, d):
    return st.mean_standard_error(table(spark, d, "events"), EV_COLS)


# t quantile of the 95 % interval: the normal quantile with its first terms in 1 / df
_Z = 1.959963984540054
_T_CRIT = (f"({_Z} + {(_Z ** 3 + _Z) / 4!r} / ({{df}}) + {(5 * _Z ** 5 + 16 * _Z ** 3 + 3 * _Z) / 96!r} "
           "/ power({df}, 2))")


@register("t02_confidence_interval", R(f"""
    SELECT column_name, n, mean, std_error, {_T_CRIT.format(df='n - 1')} AS t_critical,
           mean - {_T_CRIT.format(df='n - 1')} * std_error AS lower_bound,
           mean + {_T_CRIT.format(df='n - 1')} * std_error AS upper_bound, 0.95::DOUBLE AS confidence
    FROM (SELECT column_name, count(*) AS n, avg(x) AS mean, stddev_samp(x) / sqrt(count(*)) AS std_error
          FROM ({_long_sql('events', EV_COLS)}) AS s GROUP BY 1) AS m""",
    ["mean", "std_error", "t_critical", "lower_bound", "upper_bound", "confidence"]))
def _t02ci(spark, d):
    return st.confidence_interval(table(spark, d, "events"), EV_COLS, 0.95)


_G_LONG = _long_sql("events_labeled", EV_COLS, ", CAST(is_purchase = 1 AS INTEGER) AS g1", "is_purchase IN (1, 0)")
_G_MOM = f"""SELECT column_name,
        count(*) FILTER (WHERE g1 = 1) AS group1_n, count(*) FILTER (WHERE g1 = 0) AS group2_n,
        avg(x) FILTER (WHERE g1 = 1) AS group1_mean, avg(x) FILTER (WHERE g1 = 0) AS group2_mean,
        stddev_samp(x) FILTER (WHERE g1 = 1) AS group1_std, stddev_samp(x) FILTER (WHERE g1 = 0) AS group2_std
    FROM ({_G_LONG}) AS s GROUP BY 1"""


@register("t04_welch_t", R(oracle_with(f"""
    SELECT *, (group1_mean - group2_mean) / sqrt(a + b) AS t_statistic,
           (a + b) * (a + b) / (a * a / (group1_n - 1) + b * b / (group2_n - 1)) AS welch_df
    FROM (SELECT *, group1_std * group1_std / group1_n AS a, group2_std * group2_std / group2_n AS b
          FROM ({_G_MOM}) AS m) AS w""".replace("SELECT *, (group1", "SELECT column_name, group1_n, group2_n, "
                                                "group1_mean, group2_mean, group1_std, group2_std, (group1"),
    "events_labeled"), ["group1_mean", "group2_mean", "group1_std", "group2_std", "t_statistic", "welch_df"]))
def _t04(spark, d):
    return st.welch_t(table(spark, d, "events_labeled"), EV_COLS, "is_purchase", 1, 0)


@register("t05_mann_whitney", R(oracle_with(f"""
    WITH s AS ({_G_LONG}),
    r AS (SELECT column_name, x, g1, rank() OVER (PARTITION BY column_name ORDER BY x) AS rmin,
                 count(*) OVER (PARTITION BY column_name, x) AS t FROM s),
    a AS (SELECT column_name, sum(CASE WHEN g1 = 1 THEN rmin + (t - 1) / 2.0 ELSE 0 END) AS r1,
                 CAST(sum(g1) AS DOUBLE) AS n1, CAST(count(*) AS DOUBLE) AS n FROM r GROUP BY 1),
    ties AS (SELECT column_name, sum(power(t, 3) - t) AS tie FROM (SELECT DISTINCT column_name, x, t FROM r) AS d
             GROUP BY 1),
    u AS (SELECT a.*, ties.tie, r1 - n1 * (n1 + 1) / 2.0 AS u1 FROM a JOIN ties ON a.column_name = ties.column_name)
    SELECT column_name, CAST(n1 AS BIGINT) AS group1_n, CAST(n - n1 AS BIGINT) AS group2_n, u1 AS u_statistic,
           (greatest(u1, n1 * (n - n1) - u1) - n1 * (n - n1) / 2.0 - 0.5)
             / sqrt(n1 * (n - n1) / 12.0 * ((n + 1) - tie / (n * (n - 1)))) AS z
    FROM u""", "events_labeled"), ["u_statistic", "z"]))
def _t05(spark, d):
    return st.mann_whitney(table(spark, d, "events_labeled"), EV_COLS, "is_purchase", 1, 0)


@register("t06_cohens_d", R(oracle_with(f"""
    SELECT column_name, d AS cohens_d,
           CASE WHEN d < 0.2 THEN 'negligible' WHEN d < 0.5 THEN 'small' WHEN d < 0.8 THEN 'medium'
                ELSE 'large' END AS effect
    FROM (SELECT column_name, abs(group1_mean - group2_mean)
                 / sqrt((group1_std * group1_std + group2_std * group2_std) / 2.0) AS d
          FROM ({_G_MOM}) AS m) AS x""", "events_labeled"), ["cohens_d"]))
def _t06(spark, d):
    return st.cohens_d(table(spark, d, "events_labeled"), EV_COLS, "is_purchase", 1, 0)


def compare_sql(long: str) -> str:
    """Every column of the two-group comparison but the p-value; significance
    from the critical values instead of p."""
    def jb(g: int) -> str:
        return (f"exp(-(n{g} / 6.0 * (power(c{g} / power(v{g}, 1.5), 2) + power(q{g} / (v{g} * v{g}) - 3, 2) / 4.0))"
                " / 2.0)")
    sides = ", ".join(
        f"""count(*) FILTER (WHERE g1 = {f}) AS n{g}, avg(x) FILTER (WHERE g1 = {f}) AS mean{g},
            stddev_samp(x) FILTER (WHERE g1 = {f}) AS sd{g},
            avg(power(x - mu, 2)) FILTER (WHERE g1 = {f}) AS v{g}, avg(power(x - mu, 3)) FILTER (WHERE g1 = {f}) AS c{g},
            avg(power(x - mu, 4)) FILTER (WHERE g1 = {f}) AS q{g}""" for g, f in ((1, 1), (2, 0)))
    return f"""WITH s AS ({long}),
    m AS (SELECT column_name, {sides}
          FROM (SELECT *, avg(x) OVER (PARTITION BY column_name, g1) AS mu FROM s) AS w GROUP BY 1),
    r AS (SELECT column_name, x, g1, rank() OVER (PARTITION BY column_name ORDER BY x) AS rmin,
                 count(*) OVER (PARTITION BY column_name, x) AS t FROM s),
    a AS (SELECT column_name, sum(CASE WHEN g1 = 1 THEN rmin + (t - 1) / 2.0 ELSE 0 END) AS r1 FROM r GROUP BY 1),
    ties AS (SELECT column_name, sum(power(t, 3) - t) AS tie FROM (SELECT DISTINCT column_name, x, t FROM r) AS d
             GROUP BY 1),
    u AS (SELECT m.*, r1 - n1 * (n1 + 1) / 2.0 AS u1, CAST(n1 AS DOUBLE) * n2 AS nn, n1 + n2 AS n, tie,
                 sd1 * sd1 / n1 AS w1, sd2 * sd2 / n2 AS w2,
                 abs(mean1 - mean2) / sqrt((sd1 * sd1 + sd2 * sd2) / 2.0) AS d,
                 {jb(1)} >= 0.05 AND {jb(2)} >= 0.05 AS normal
          FROM m JOIN a ON m.column_name = a.column_name JOIN ties ON m.column_name = ties.column_name),
    z AS (SELECT *, (mean1 - mean2) / sqrt(w1 + w2) AS t,
                 power(w1 + w2, 2) / (w1 * w1 / (n1 - 1) + w2 * w2 / (n2 - 1)) AS df,
                 (greatest(u1, nn - u1) - nn / 2.0 - 0.5)
                   / sqrt(nn / 12.0 * ((n + 1) - tie / (CAST(n AS DOUBLE) * (n - 1)))) AS z FROM u)
    SELECT column_name, CASE WHEN normal THEN 'Welch''s t-test' ELSE 'mannwhitneyu' END AS test_type,
           mean1 AS group1_mean, mean2 AS group2_mean, sd1 AS group1_std, sd2 AS group2_std,
           n1 AS group1_n, n2 AS group2_n, CASE WHEN normal THEN t ELSE u1 END AS statistic,
           CASE WHEN normal THEN abs(t) > {_T_CRIT.format(df='df')} ELSE z > {_Z} END AS significant, d AS cohens_d,
           CASE WHEN d < 0.2 THEN 'negligible' WHEN d < 0.5 THEN 'small' WHEN d < 0.8 THEN 'medium' ELSE 'large' END
             AS effect
    FROM z"""


_COMPARE_COLS = ["group1_mean", "group2_mean", "group1_std", "group2_std", "statistic", "cohens_d"]


@register("t03_compare_two_groups", R(oracle_with(compare_sql(_G_LONG), "events_labeled"), _COMPARE_COLS))
def _t03(spark, d):
    """All columns but the p-value, which SQL has no function for (tests hold it)."""
    return st.compare_two_groups(table(spark, d, "events_labeled"), EV_COLS, "is_purchase", 1, 0).drop("p_value")


@register("t08_contingency", oracle_with("""
    SELECT o_orderpriority, is_filled, count(*) AS "count" FROM orders_status GROUP BY 1, 2""", "orders_status"))
def _t08(spark, d):
    return st.contingency(table(spark, d, "orders_status"), "o_orderpriority", "is_filled")


def chi_square_sql(tbl: str, cols: list[str], target: str) -> str:
    long = union_sql([f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, {target} AS y FROM {tbl} "
                      f"WHERE {c} IS NOT NULL AND {target} IS NOT NULL" for c in cols])
    return f"""WITH long AS ({long}),
    cells AS (SELECT column_name, value, y, count(*) AS o FROM long GROUP BY 1, 2, 3),
    rt AS (SELECT column_name, value, sum(o) AS rt FROM cells GROUP BY 1, 2),
    ct AS (SELECT column_name, y, sum(o) AS ct FROM cells GROUP BY 1, 2),
    nn AS (SELECT column_name, sum(o) AS n FROM cells GROUP BY 1),
    grid AS (SELECT rt.column_name, rt.value, ct.y, rt.rt, ct.ct, nn.n, coalesce(cells.o, 0) AS o,
                    rt.rt * ct.ct / nn.n AS e
             FROM rt JOIN ct ON rt.column_name = ct.column_name JOIN nn ON rt.column_name = nn.column_name
             LEFT JOIN cells ON cells.column_name = rt.column_name AND cells.value = rt.value AND cells.y = ct.y),
    s AS (SELECT column_name, any_value(n) AS n, count(DISTINCT value) AS r, count(DISTINCT y) AS c,
                 sum((o - e) * (o - e) / e) AS plain, sum(power(greatest(abs(o - e) - 0.5, 0), 2) / e) AS yates,
                 min(e) AS min_expected FROM grid GROUP BY 1),
    f AS (SELECT *, CASE WHEN (r - 1) * (c - 1) = 1 THEN yates ELSE plain END AS chi2 FROM s)
    SELECT column_name, chi2, CAST((r - 1) * (c - 1) AS BIGINT) AS dof, CAST(n AS BIGINT) AS n, min_expected,
           sqrt(chi2 / (n * (least(r, c) - 1))) AS cramers_v,
           CASE WHEN sqrt(chi2 / (n * (least(r, c) - 1))) < 0.1 THEN 'negligible'
                WHEN sqrt(chi2 / (n * (least(r, c) - 1))) < 0.3 THEN 'small'
                WHEN sqrt(chi2 / (n * (least(r, c) - 1))) < 0.5 THEN 'medium' ELSE 'high' END AS effect
    FROM f"""


@register("t09_chi_square", R(oracle_with(chi_square_sql("orders_status", ["o_orderpriority"], "is_filled"),
                                          "orders_status"), ["chi2", "min_expected", "cramers_v"]))
def _t09(spark, d):
    return st.chi_square(table(spark, d, "orders_status"), ["o_orderpriority"], "is_filled")


@register("t09_chi_square_yates", R(oracle_with(chi_square_sql("events_parity", ["user_parity", "event_type"],
                                                               "is_purchase"), "events_parity"),
                                    ["chi2", "min_expected", "cramers_v"]))
def _t09y(spark, d):
    return st.chi_square(table(spark, d, "events_parity"), ["user_parity", "event_type"], "is_purchase")


@register("t09_chi_square_p")
def _t09p(spark, d):
    return st.chi_square_with_p(table(spark, d, "orders_status"), ["o_orderpriority"], "is_filled")


@register("t11_chi_square_all", R(oracle_with(chi_square_sql("doc_features", ["lang", "source"], "quality"),
                                              "doc_features"), ["chi2", "min_expected", "cramers_v"]))
def _t11(spark, d):
    return st.chi_square(table(spark, d, "doc_features"), None, "quality")


# =========================================================== M2-M15 metrics, G1-G8 gates

from ..operators import gates as gt  # noqa: E402
from ..operators import metrics as mt  # noqa: E402
from .views import VIEWS  # noqa: E402

EPS_SQL = "2.220446049250313e-16"
ONE_MINUS_EPS_SQL = "0.9999999999999998"
BY = ["model", "split"]


def _scored_runs(spark, d):
    """Scored runs with the quota split of c06 attached (dev = validation)."""
    runs = table(spark, d, "scored_runs")
    sp = _split_events(spark, d).select("event_id", "split")
    return (runs.join(sp, "event_id")
            .withColumn("prediction", (F.col("probability") >= 0.5).cast("int")))


SCORED_CTE = f"""WITH sp AS ({SPLIT_SQL}),
    sr AS ({VIEWS['scored_runs']}),
    s AS (SELECT sr.*, sp.split, CAST(sr.probability >= 0.5 AS INTEGER) AS prediction
          FROM sr JOIN sp ON sr.event_id = sp.event_id)"""


def _counts_sql(by: str) -> str:
    return f"""SELECT {by},
        count(*) FILTER (WHERE label = 0 AND prediction = 0) AS tn,
        count(*) FILTER (WHERE label = 0 AND prediction = 1) AS fp,
        count(*) FILTER (WHERE label = 1 AND prediction = 0) AS fn,
        count(*) FILTER (WHERE label = 1 AND prediction = 1) AS tp, count(*) AS n,
        avg((probability - label) * (probability - label)) AS brier_score,
        avg(-(label * ln(least(greatest(probability, {EPS_SQL}), {ONE_MINUS_EPS_SQL})))
            - (1 - label) * ln(1 - least(greatest(probability, {EPS_SQL}), {ONE_MINUS_EPS_SQL}))) AS log_loss
        FROM s GROUP BY {by}"""


def _auc_sql(by: str) -> str:
    return f"""SELECT {by}, (sum(ar) FILTER (WHERE label = 1) - np * (np + 1) / 2.0) / (np * (n - np)) AS roc_auc
        FROM (SELECT {by}, label,
                     rank() OVER (PARTITION BY {by} ORDER BY probability)
                       + (count(*) OVER (PARTITION BY {by}, probability) - 1) / 2.0 AS ar,
                     CAST(sum(label) OVER (PARTITION BY {by}) AS DOUBLE) AS np,
                     CAST(count(*) OVER (PARTITION BY {by}) AS DOUBLE) AS n
              FROM s) AS r GROUP BY {by}, np, n"""


def _cum_sql(by: str) -> str:
    return f"""SELECT {by}, probability, cnt, pos,
            sum(cnt) OVER (PARTITION BY {by} ORDER BY probability DESC ROWS UNBOUNDED PRECEDING) AS k,
            sum(pos) OVER (PARTITION BY {by} ORDER BY probability DESC ROWS UNBOUNDED PRECEDING) AS tp,
            sum(pos) OVER (PARTITION BY {by}) AS p_tot, sum(cnt) OVER (PARTITION BY {by}) AS n_tot
        FROM (SELECT {by}, probability, count(*) AS cnt, sum(label) AS pos FROM s GROUP BY {by}, probability) AS g"""


def _ap_sql(by: str) -> str:
    return f"""SELECT {by}, sum((pos / p_tot) * (tp / k)) AS average_precision
        FROM ({_cum_sql(by)}) AS c GROUP BY {by}"""


def _evaluate_sql(by: str, keys: list[str]) -> str:
    on = " AND ".join(f"c.{k} = {t}.{k}" for t in ("a", "p") for k in keys)
    cols = ", ".join(f"c.{k}" for k in keys)
    return f"""SELECT {cols}, (tp + tn) / n AS accuracy,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision",
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
        CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score,
        a.roc_auc, p.average_precision, brier_score, log_loss
        FROM ({_counts_sql(by)}) AS c JOIN ({_auc_sql(by)}) AS a ON {on.split(' AND c.')[0] if False else ' AND '.join(f'c.{k} = a.{k}' for k in keys)}
        JOIN ({_ap_sql(by)}) AS p ON {' AND '.join(f'c.{k} = p.{k}' for k in keys)}"""


METRIC_COLS = ["accuracy", "precision", "recall", "f1_score", "roc_auc", "average_precision", "brier_score",
               "log_loss"]


@register("m02_evaluate", R(f"{SCORED_CTE}\n{_evaluate_sql('model, split', BY)}", METRIC_COLS))
def _m02(spark, d):
    return mt.evaluate(_scored_runs(spark, d), BY)


@register("m07_roc_auc", R(oracle_with(f"""
    SELECT (sum(ar) FILTER (WHERE label = 1) - any_value(np) * (any_value(np) + 1) / 2.0)
           / (any_value(np) * (any_value(n) - any_value(np))) AS roc_auc
    FROM (SELECT label, rank() OVER (ORDER BY probability)
                 + (count(*) OVER (PARTITION BY probability) - 1) / 2.0 AS ar,
                 CAST(sum(label) OVER () AS DOUBLE) AS np, CAST(count(*) OVER () AS DOUBLE) AS n
          FROM events_scored) AS r""", "events_scored"), ["roc_auc"], 9), digits=9)
def _m07(spark, d):
    return mt.roc_auc(table(spark, d, "events_scored"))


@register("m08_average_precision", R(oracle_with(f"""
    SELECT sum((pos / p_tot) * (tp / k)) AS average_precision FROM (
        SELECT probability, cnt, pos,
               sum(cnt) OVER (ORDER BY probability DESC ROWS UNBOUNDED PRECEDING) AS k,
               sum(pos) OVER (ORDER BY probability DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(pos) OVER () AS p_tot
        FROM (SELECT probability, count(*) AS cnt, sum(label) AS pos FROM events_scored GROUP BY 1) AS g) AS c""",
    "events_scored"), ["average_precision"], 9), digits=9)
def _m08(spark, d):
    return mt.average_precision(table(spark, d, "events_scored"))


@register("m03_threshold_metrics", R(oracle_with("""
    SELECT (tp + tn) / n AS accuracy,
        CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS "precision",
        CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall,
        CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0 * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1_score,
        brier_score, log_loss
    FROM (""" + _counts_sql("1 AS one").replace("GROUP BY 1 AS one", "").replace("FROM s", "FROM events_scored")
    + ") AS c", "events_scored"), ["accuracy", "precision", "recall", "f1_score", "brier_score", "log_loss"]))
def _m03(spark, d):
    return mt.threshold_metrics(table(spark, d, "events_scored"))


@register("m11_confusion_matrix", R(f"""{SCORED_CTE},
    g AS (SELECT model, split, l.label, p.prediction FROM (SELECT DISTINCT model, split FROM s) AS k,
          (VALUES (0), (1)) AS l(label), (VALUES (0), (1)) AS p(prediction)),
    c AS (SELECT model, split, label, prediction, count(*) AS cnt FROM s GROUP BY ALL)
    SELECT g.model, g.split, CAST(g.label AS INTEGER) AS label, CAST(g.prediction AS INTEGER) AS prediction,
           coalesce(c.cnt, 0) AS "count",
           CASE WHEN sum(coalesce(c.cnt, 0)) OVER (PARTITION BY g.model, g.split, g.label) > 0
                THEN coalesce(c.cnt, 0) / sum(coalesce(c.cnt, 0)) OVER (PARTITION BY g.model, g.split, g.label)
                ELSE 0.0 END AS share
    FROM g LEFT JOIN c ON g.model = c.model AND g.split = c.split AND g.label = c.label
                      AND g.prediction = c.prediction""", ["share"]))
def _m11(spark, d):
    return mt.confusion_matrix(_scored_runs(spark, d), BY)


@register("m12_classification_report", R(f"""{SCORED_CTE},
    c AS ({_counts_sql('model, split')}),
    k AS (SELECT model, split, n, tn + fp AS s0, tp + fn AS s1,
                 CASE WHEN tn + fn > 0 THEN tn / (tn + fn) ELSE 0.0 END AS p0,
                 CASE WHEN tn + fp > 0 THEN tn / (tn + fp) ELSE 0.0 END AS r0,
                 CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p1,
                 CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r1, (tp + tn) / n AS acc FROM c),
    f AS (SELECT *, CASE WHEN p0 + r0 > 0 THEN 2 * p0 * r0 / (p0 + r0) ELSE 0.0 END AS f0,
                    CASE WHEN p1 + r1 > 0 THEN 2 * p1 * r1 / (p1 + r1) ELSE 0.0 END AS f1 FROM k)
    SELECT model, split, '0' AS class_label, p0 AS "precision", r0 AS recall, f0 AS f1_score, s0 AS support FROM f
    UNION ALL SELECT model, split, '1', p1, r1, f1, s1 FROM f
    UNION ALL SELECT model, split, 'accuracy', NULL, NULL, acc, n FROM f
    UNION ALL SELECT model, split, 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM f
    UNION ALL SELECT model, split, 'weighted avg', (p0 * s0 + p1 * s1) / n, (r0 * s0 + r1 * s1) / n,
                     (f0 * s0 + f1 * s1) / n, n FROM f""", ["precision", "recall", "f1_score"]))
def _m12(spark, d):
    return mt.classification_report(_scored_runs(spark, d), BY)


@register("m13_roc_curve", R(f"""{SCORED_CTE}
    SELECT model, probability AS threshold,
           CASE WHEN n_tot - p_tot > 0 THEN (k - tp) / (n_tot - p_tot) ELSE 0.0 END AS fpr,
           CASE WHEN p_tot > 0 THEN tp / p_tot ELSE 0.0 END AS tpr
    FROM ({_cum_sql('model')}) AS c""", ["threshold", "fpr", "tpr"]))
def _m13(spark, d):
    return mt.roc_curve(_scored_runs(spark, d), ["model"])


@register("m14_pr_curve", R(f"""{SCORED_CTE}
    SELECT model, probability AS threshold, tp / k AS "precision",
           CASE WHEN p_tot > 0 THEN tp / p_tot ELSE 0.0 END AS recall
    FROM ({_cum_sql('model')}) AS c""", ["threshold", "precision", "recall"]))
def _m14(spark, d):
    return mt.pr_curve(_scored_runs(spark, d), ["model"])


_EVAL_CTE = f"""{SCORED_CTE},
    ev AS ({_evaluate_sql('model, split', BY)}),
    dev AS (SELECT * FROM ev WHERE split = 'dev'),
    gap AS (SELECT model, 'f1_score' AS metric, tr.f1_score AS train_score, dv.f1_score AS val_score,
                   tr.f1_score - dv.f1_score AS gap,
                   CASE WHEN tr.f1_score > 0 THEN (tr.f1_score - dv.f1_score) / tr.f1_score * 100 ELSE 0.0 END
                     AS gap_percentage
            FROM (SELECT model, f1_score FROM ev WHERE split = 'train') AS tr
            JOIN (SELECT model, f1_score FROM ev WHERE split = 'dev') AS dv USING (model))"""


def _gap_spark(spark, d, scored=None):
    scored = scored if scored is not None else _scored_runs(spark, d)
    long = mt.metrics_long(scored.where(F.col("split").isin("train", "dev")), BY, ["f1_score"])
    return mt.compare_train_val(long, "f1_score", ["model"], train="train", val="dev")


@register("m15_train_val_gap", R(f"""{_EVAL_CTE}
    SELECT *, CASE WHEN abs(gap) <= 0.10 THEN 'good' ELSE 'poor' END AS generalization_status,
           CASE WHEN gap > 0.10 THEN 'overfitting' WHEN gap < -0.05 THEN 'unusual' ELSE 'acceptable' END AS note
    FROM gap""", ["train_score", "val_score", "gap", "gap_percentage"]))
def _m15(spark, d):
    return _gap_spark(spark, d)


def _dev_results(spark, d):
    ev = mt.evaluate(_scored_runs(spark, d), BY).where(F.col("split") == "dev")
    seq = table(spark, d, "scored_runs").select("model", "seq").distinct()
    return ev.join(seq, "model").drop("split")


@register("g01_leaderboard", R(f"""{_EVAL_CTE}
    SELECT dev.* EXCLUDE (split), sr.seq FROM dev JOIN (SELECT DISTINCT model, seq FROM sr) AS sr USING (model)""",
    METRIC_COLS))
def _g01(spark, d):
    return gt.leaderboard(_dev_results(spark, d), "f1_score")


@register("g02_top_k", R(f"""{_EVAL_CTE}
    SELECT dev.* EXCLUDE (split), sr.seq FROM dev JOIN (SELECT DISTINCT model, seq FROM sr) AS sr USING (model)
    ORDER BY f1_score DESC, seq LIMIT 2""", METRIC_COLS))
def _g02(spark, d):
    return gt.top_k(_dev_results(spark, d), "f1_score", 2)


@register("g03_select_best", R(f"""{_EVAL_CTE}
    SELECT dev.* EXCLUDE (split), sr.seq, sr.model = 'm_tuned' AS is_tuned
    FROM dev JOIN (SELECT DISTINCT model, seq FROM sr) AS sr USING (model)
    ORDER BY roc_auc DESC, is_tuned, seq LIMIT 1""", METRIC_COLS))
def _g03(spark, d):
    res = _dev_results(spark, d)
    return gt.select_best(res.where(F.col("model") != "m_tuned"), res.where(F.col("model") == "m_tuned"),
                          "roc_auc")


_PERF_SQL = f"""{_EVAL_CTE},
    th AS (SELECT * FROM (VALUES ('f1_score', 0.70, 0.75, 0.85), ('roc_auc', 0.75, 0.80, 0.90))
           AS t(metric, mn, wn, tg)),
    lm AS (SELECT model, 'f1_score' AS metric, f1_score AS value FROM dev
           UNION ALL SELECT model, 'roc_auc', roc_auc FROM dev),
    perf AS (SELECT lm.model, lm.metric, lm.value, CAST(th.mn AS DOUBLE) AS "min", CAST(th.wn AS DOUBLE) AS warning,
                    CAST(th.tg AS DOUBLE) AS target,
                    CASE WHEN value < th.mn THEN 'FAIL' WHEN value < th.wn THEN 'WARNING'
                         WHEN value >= th.tg THEN 'EXCELLENT' ELSE 'PASS' END AS status,
                    value >= th.mn AS passed
             FROM lm JOIN th ON lm.metric = th.metric)"""


def _perf_spark(spark, d, scored=None):
    scored = scored if scored is not None else _scored_runs(spark, d)
    long = mt.metrics_long(scored.where(F.col("split") == "dev"), ["model"], ["f1_score", "roc_auc"])
    return gt.performance_gate(long, gt.thresholds_table(spark), ["model"])


@register("g04_performance_gate", R(f"{_PERF_SQL}\nSELECT * FROM perf", ["value"]))
def _g04(spark, d):
    return _perf_spark(spark, d)


_OVER_SQL = f"""{_PERF_SQL},
    ovf AS (SELECT model, metric, gap, gap_percentage, 0.15 AS max_allowed, gap <= 0.15 AS passed,
                   CASE WHEN gap > 0.15 THEN 'FAIL' WHEN gap > 0.10 THEN 'WARNING' ELSE 'PASS' END AS status
            FROM gap)"""


@register("g05_overfitting_gate", R(f"{_OVER_SQL}\nSELECT model, metric, gap, gap_percentage, "
                                    f"CAST(max_allowed AS DOUBLE) AS max_allowed, passed, status FROM ovf",
                                    ["gap", "gap_percentage"]))
def _g05(spark, d):
    return gt.overfitting_gate(_gap_spark(spark, d), ["model"])


_RULES_SQL = f"""{_OVER_SQL},
    cc AS ({_counts_sql('model').replace('FROM s GROUP', "FROM s WHERE split = 'dev' GROUP")}),
    rules AS (SELECT model, 'recall' AS rule, CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS value,
                     0.80 AS lim FROM cc
              UNION ALL SELECT model, 'false_positive_rate', CASE WHEN fp + tn > 0 THEN fp / (fp + tn) ELSE 0.0 END,
                     0.30 FROM cc),
    rr AS (SELECT model, rule, value, CAST(lim AS DOUBLE) AS "limit",
                  CASE WHEN rule = 'recall' THEN value >= lim ELSE value <= lim END AS passed FROM rules)"""


@register("g06_business_rules", R(f"""{_RULES_SQL}
    SELECT *, CASE WHEN passed THEN 'PASS' ELSE 'FAIL' END AS status FROM rr""", ["value"]))
def _g06(spark, d):
    cc = mt.confusion_counts(_scored_runs(spark, d).where(F.col("split") == "dev"), ["model"])
    return gt.business_rules_gate(cc, ["model"])


@register("g07_compare_production", R(f"""{_EVAL_CTE},
    prod AS (SELECT f1_score AS ps FROM dev WHERE model = 'm_random')
    SELECT model, f1_score AS new_model_score, ps AS production_score, f1_score - ps AS improvement,
           CASE WHEN ps > 0 THEN (f1_score - ps) / ps * 100 ELSE 0.0 END AS improvement_percentage,
           f1_score - ps >= 0.01 AS should_replace,
           CASE WHEN f1_score - ps >= 0.01 THEN 'better_performance' ELSE 'insufficient_improvement' END AS reason
    FROM dev, prod""", ["new_model_score", "production_score", "improvement", "improvement_percentage"]))
def _g07(spark, d):
    scores = _dev_results(spark, d).select("model", F.col("f1_score").alias("value"))
    stages = spark.createDataFrame([("m_random", "Production")], "model string, stage string")
    return gt.compare_with_production(scores, stages, "model")


@register("g08_overall_verdict", f"""{_RULES_SQL},
    u AS (SELECT model, passed FROM perf UNION ALL SELECT model, passed FROM ovf UNION ALL SELECT model, passed FROM rr)
    SELECT model, bool_and(passed) AS overall_passed, count(*) FILTER (WHERE NOT passed) AS failed_checks
    FROM u GROUP BY model""")
def _g08(spark, d):
    scored = mt.compact(_scored_runs(spark, d), BY).checkpoint(eager=True)  # shared by the three gates
    perf = _perf_spark(spark, d, scored)
    over = gt.overfitting_gate(_gap_spark(spark, d, scored), ["model"])
    cc = mt.confusion_counts(scored.where(F.col("split") == "dev"), ["model"])
    rules = gt.business_rules_gate(cc, ["model"])
    return gt.overall_verdict(perf, over, rules, ["model"])


# =========================================================== D1-D7 distributions

from ..operators import distribution as dist  # noqa: E402


def histogram_sql(tbl: str, cols: list[str], ints: set[str]) -> str:
    parts = []
    for c in cols:
        w = ("greatest(w0, 1.0)" if c in ints else "w0")
        parts.append(f"""SELECT * FROM (
            WITH st AS (SELECT count(x) AS n, min(x) AS mn, max(x) AS mx, quantile_cont(x, 0.25) AS q1,
                               quantile_cont(x, 0.75) AS q3 FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {tbl}) AS t),
            ww AS (SELECT *, CASE WHEN fd > 0 THEN least(fd, sturges) ELSE sturges END AS w0 FROM (
                     SELECT *, 2.0 * (q3 - q1) * pow(CAST(n AS DOUBLE), -1.0 / 3.0) AS fd,
                            (mx - mn) / (log2(CAST(n AS DOUBLE)) + 1.0) AS sturges FROM st) AS a),
            nb AS (SELECT *, CAST(CASE WHEN mx - mn > 0 THEN greatest(ceil((mx - mn) / {w}), 1) ELSE 1 END AS INTEGER)
                             AS n_bins FROM ww),
            p AS (SELECT mn, mx, n_bins, (mx - mn) / n_bins AS bw FROM nb),
            g AS (SELECT CAST(unnest(range(0, (SELECT n_bins FROM p))) AS INTEGER) AS bin),
            c AS (SELECT CAST(CASE WHEN p.bw > 0 THEN least(floor((CAST({c} AS DOUBLE) - p.mn) / p.bw), p.n_bins - 1)
                                   ELSE 0 END AS INTEGER) AS bin, count(*) AS cnt
                  FROM {tbl}, p WHERE {c} IS NOT NULL GROUP BY 1)
            SELECT '{c}' AS column_name, g.bin, p.mn + g.bin * p.bw AS lower, p.mn + (g.bin + 1) * p.bw AS upper,
                   coalesce(c.cnt, 0) AS "count"
            FROM g CROSS JOIN p LEFT JOIN c ON g.bin = c.bin) AS h{len(parts)}""")
    return union_sql(parts)


@register("d01_histogram", R(histogram_sql("events", ["value", "user_id"], {"user_id"}), ["lower", "upper"], 4),
          digits=4)
def _d01(spark, d):
    return dist.histogram(table(spark, d, "events"), ["value", "user_id"])


def density_sql(tbl: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT * FROM (
            WITH v AS (SELECT CAST({c} AS DOUBLE) AS x FROM {tbl} WHERE {c} IS NOT NULL),
            p AS (SELECT count(*) AS n, stddev_samp(x) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw,
                         min(x) AS mn, max(x) AS mx FROM v),
            g AS (SELECT CAST(unnest(range(0, 200)) AS INTEGER) AS point),
            gx AS (SELECT point, p.mn - 3.0 * p.bw + point * (((p.mx + 3.0 * p.bw) - (p.mn - 3.0 * p.bw)) / 199)
                          AS gx FROM g, p)
            SELECT '{c}' AS column_name, gx.point, gx.gx AS x,
                   sum(exp(-0.5 * ((gx.gx - v.x) / p.bw) * ((gx.gx - v.x) / p.bw)))
                     / (any_value(p.n) * any_value(p.bw) * sqrt(2 * pi())) AS density
            FROM gx, v, p GROUP BY gx.point, gx.gx) AS k{len(parts)}""")
    return union_sql(parts)


@register("d02_density_curve", R(density_sql("events", ["value", "user_id"]), ["x", "density"], 9), digits=9)
def _d02(spark, d):
    return dist.density_curve(table(spark, d, "events"), ["value", "user_id"])


@register("d03_category_counts", union_sql([
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" FROM orders "
    f"WHERE {c} IS NOT NULL GROUP BY 2" for c in ["o_orderstatus", "o_orderpriority"]]))
def _d03(spark, d):
    return dist.category_counts(table(spark, d, "orders"), ["o_orderstatus", "o_orderpriority"])


def box_sql(tbl: str, cols: list[str]) -> str:
    parts = []
    for c in cols:
        parts.append(f"""SELECT '{c}' AS column_name, q1, med AS median, q3,
            (SELECT min(x) FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {tbl}) AS t WHERE x >= q1 - 1.5 * (q3 - q1))
              AS whisker_low,
            (SELECT max(x) FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {tbl}) AS t WHERE x <= q3 + 1.5 * (q3 - q1))
              AS whisker_high,
            (SELECT count(*) FROM (SELECT CAST({c} AS DOUBLE) AS x FROM {tbl}) AS t
              WHERE x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) AS n_fliers, mean
            FROM (SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.5) AS med,
                         quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3, avg(CAST({c} AS DOUBLE)) AS mean
                  FROM {tbl}) AS s""")
    return union_sql(parts)


@register("d04_box_stats", R(box_sql("events", ["value", "user_id"]),
                             ["q1", "median", "q3", "whisker_low", "whisker_high", "mean"]))
def _d04(spark, d):
    return dist.box_stats(table(spark, d, "events"), ["value", "user_id"])


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _pairs_sql(select_for_pair) -> str:
    return union_sql([select_for_pair(a, b) for a in CORR_COLS for b in CORR_COLS])


@register("d05_correlation_pearson", R(_pairs_sql(
    lambda a, b: f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS correlation FROM lineitem"),
    ["correlation"], 9), digits=9)
def _d05p(spark, d):
    return dist.correlation_matrix(table(spark, d, "lineitem"), CORR_COLS, "pearson")


_RANKED = "SELECT " + ", ".join(
    f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in CORR_COLS
) + " FROM lineitem"


@register("d05_correlation_spearman", R(f"WITH rk AS ({_RANKED})\n" + _pairs_sql(
    lambda a, b: f"SELECT '{a}' AS column_a, '{b}' AS column_b, corr({a}, {b}) AS correlation FROM rk"),
    ["correlation"], 9), digits=9)
def _d05s(spark, d):
    return dist.correlation_matrix(table(spark, d, "lineitem"), CORR_COLS, "spearman")


@register("d05_correlation_spearman_nulls", R(oracle_with(f"""
    WITH b AS (SELECT CAST(c_acctbal AS DOUBLE) AS a, CAST(c_nationkey AS DOUBLE) AS k FROM customer_dirty
               WHERE c_acctbal IS NOT NULL AND c_nationkey IS NOT NULL),
    rk AS (SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS a,
                  rank() OVER (ORDER BY k) + (count(*) OVER (PARTITION BY k) - 1) / 2.0 AS k FROM b)
    SELECT 'c_acctbal' AS column_a, 'c_nationkey' AS column_b, corr(a, k) AS correlation FROM rk
    UNION ALL SELECT 'c_nationkey', 'c_acctbal', corr(a, k) FROM rk
    UNION ALL SELECT 'c_acctbal', 'c_acctbal', corr(c_acctbal, c_acctbal) FROM customer_dirty
    UNION ALL SELECT 'c_nationkey', 'c_nationkey', corr(c_nationkey, c_nationkey) FROM customer_dirty""",
    "customer_dirty"), ["correlation"], 9), digits=9)
def _d05n(spark, d):
    return dist.correlation_matrix(table(spark, d, "customer_dirty"), ["c_acctbal", "c_nationkey"], "spearman")


def _kendall_sql(tbl: str, cols: list[str]) -> str:
    """tau-b from all pairs of distinct cells of values."""
    def one(a: str, b: str) -> str:
        return f"""SELECT '{a}' AS column_a, '{b}' AS column_b, (SELECT
              (n0 - tx - ty + txy - 2 * d) / (sqrt(n0 - tx) * sqrt(n0 - ty)) FROM (SELECT
                (SELECT sum(c) * (sum(c) - 1) / 2.0 FROM k) AS n0,
                (SELECT sum(t * (t - 1) / 2.0) FROM (SELECT sum(c) AS t FROM k GROUP BY x)) AS tx,
                (SELECT sum(t * (t - 1) / 2.0) FROM (SELECT sum(c) AS t FROM k GROUP BY y)) AS ty,
                (SELECT sum(c * (c - 1) / 2.0) FROM k) AS txy,
                (SELECT coalesce(sum(p.c * q.c), 0) FROM k p JOIN k q ON p.x < q.x AND p.y > q.y) AS d)) AS correlation
            FROM (SELECT 1)"""

    def with_cells(a: str, b: str) -> str:
        return f"""(WITH k AS MATERIALIZED (SELECT CAST({a} AS DOUBLE) AS x, CAST({b} AS DOUBLE) AS y, CAST(count(*) AS DOUBLE) AS c FROM {tbl}
                    WHERE {a} IS NOT NULL AND {b} IS NOT NULL GROUP BY 1, 2) {one(a, b)})"""
    return union_sql([f"SELECT * FROM {with_cells(a, b)}" for a in cols for b in cols])


@register("d05_correlation_kendall", R(oracle_with(_kendall_sql("customer_dirty", ["c_acctbal", "c_nationkey"]), "customer_dirty"),
                                       ["correlation"], 9), digits=9)
def _d05k(spark, d):
    return dist.correlation_matrix(table(spark, d, "customer_dirty"), ["c_acctbal", "c_nationkey"], "kendall")


@register("d05_correlation_kendall_ties", R(_kendall_sql("lineitem", ["l_quantity", "l_discount", "l_tax"]), ["correlation"], 9), digits=9)
def _d05kt(spark, d):
    return dist.correlation_matrix(table(spark, d, "lineitem"), ["l_quantity", "l_discount", "l_tax"], "kendall")


@register("d06_target_distribution", R(oracle_with("""
    SELECT quality, count(*) AS "count", count(*) * 100.0 / sum(count(*)) OVER () AS percent
    FROM doc_features GROUP BY quality""", "doc_features"), ["percent"]))
def _d06(spark, d):
    return dist.target_bars(table(spark, d, "doc_features"), "quality")


@register("d07_run_all")
def _d07(spark, d):
    return dist.run_all(table(spark, d, "events_labeled"), "is_purchase", ["value", "user_id"], ["event_type"])


# =========================================================== A3, A19-A21, P2, P5 and sinks

import uuid  # noqa: E402

from ..sources import io as sio  # noqa: E402
from . import eda as eda_plan  # noqa: E402


@register("a03_describe_all", R(oracle_with(f"""
    SELECT *, 'numeric' AS kind, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top,
           CAST(NULL AS BIGINT) AS freq, CAST(NULL AS BIGINT) AS unique_count, CAST(NULL AS DOUBLE) AS cardinality_pct
    FROM ({numeric_profile_sql('customer_dirty', ['c_acctbal', 'c_nationkey'])}) AS n
    UNION ALL BY NAME
    SELECT *, 'categorical' AS kind FROM ({categorical_profile_sql('customer_dirty', ['c_mktsegment', 'c_name'])})
    AS c""", "customer_dirty"), NUM_PROFILE_COLS + ["cardinality_pct"]))
def _a03(spark, d):
    return prof.describe_all(table(spark, d, "customer_dirty"), id_column="c_custkey")


@register("a19_dataset_metadata", oracle_with(f"""
    WITH s AS ({SPLIT_SQL})
    SELECT split, CAST(sum(count(*)) OVER (PARTITION BY split) AS BIGINT) AS n_rows, 4 AS n_features,
           CAST(is_purchase AS INTEGER) AS label, count(*) AS "count"
    FROM s GROUP BY split, is_purchase""", "events_labeled"))
def _a19(spark, d):
    sp = _split_events(spark, d)
    parts = {s: sp.where(F.col("split") == s).drop("split") for s in ("train", "dev", "test")}
    return prof.dataset_metadata(parts, "is_purchase")


@register("a20_eda_report", R(oracle_with(f"""
    WITH nc AS ({null_counts_sql('customer_dirty', CUSTOMER_DIRTY_COLS)}),
    dd AS (SELECT count(*) AS n_distinct FROM (SELECT DISTINCT * FROM customer_dirty) AS x)
    SELECT CAST(max(n_rows) AS BIGINT) AS n_rows, 5 AS n_columns, 3 AS n_numeric, 2 AS n_categorical,
           CAST(sum(missing_count) AS BIGINT) AS missing_total,
           CAST(sum(missing_count) * 100.0 / (max(n_rows) * 5) AS DOUBLE) AS missing_pct_overall,
           CAST(max(n_rows) - any_value(dd.n_distinct) AS BIGINT) AS n_duplicates,
           CAST((max(n_rows) - any_value(dd.n_distinct)) * 100.0 / max(n_rows) AS DOUBLE) AS duplicate_pct
    FROM nc, dd""", "customer_dirty"), ["missing_pct_overall", "duplicate_pct"]))
def _a20(spark, d):
    return eda_plan.eda_report(table(spark, d, "customer_dirty"))


@register("a21_run_all_checks", R(oracle_with(f"""
    SELECT 'missing' AS "check", column_name, 'missing_fraction' AS metric,
           round_even(missing_count / n_rows, 4) AS value,
           CASE WHEN round_even(missing_count / n_rows, 4) >= 0.30 THEN 'CRITICAL'
                WHEN round_even(missing_count / n_rows, 4) >= 0.05 THEN 'WARNING' ELSE 'INFO' END AS status
    FROM ({null_counts_sql('customer_dirty', CUSTOMER_DIRTY_COLS)}) AS t WHERE missing_count > 0
    UNION ALL
    SELECT 'duplicates', NULL, 'n_duplicates', CAST(n - nd AS DOUBLE), CASE WHEN n > nd THEN 'WARNING' ELSE 'OK' END
    FROM (SELECT count(*) AS n, (SELECT count(*) FROM (SELECT DISTINCT * FROM customer_dirty) AS x) AS nd
          FROM customer_dirty) AS d
    UNION ALL
    SELECT 'outliers', column_name, 'percentage', percentage, CASE WHEN high_outliers THEN 'WARNING' ELSE 'OK' END
    FROM ({iqr_summary_sql('customer_dirty', ['c_acctbal', 'c_nationkey'])}) AS o""", "customer_dirty"), ["value"]))
def _a21(spark, d):
    return qual.run_all_checks(table(spark, d, "customer_dirty"), exclude=["c_custkey"])


@register("p02_column_kinds", """
    SELECT column_name,
           CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' WHEN 'DOUBLE' THEN 'double'
                WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'BOOLEAN' THEN 'boolean'
                ELSE lower(data_type) END AS data_type,
           CASE WHEN data_type IN ('BIGINT', 'INTEGER', 'DOUBLE', 'SMALLINT', 'TINYINT', 'FLOAT', 'HUGEINT')
                     OR data_type LIKE 'DECIMAL%' THEN 'numeric'
                WHEN data_type IN ('VARCHAR', 'BOOLEAN') THEN 'categorical' ELSE 'other' END AS kind
    FROM information_schema.columns WHERE table_name = 'orders'""")
def _p02(spark, d):
    return prof.schema_overview(table(spark, d, "orders"))


def _narrow_sql() -> str:
    ints = ['l_orderkey', 'l_partkey', 'l_suppkey', 'l_linenumber']
    rest = [('l_quantity', 'double', 'numeric'), ('l_extendedprice', 'double', 'numeric'), ('l_discount', 'double', 'numeric'), ('l_tax', 'double', 'numeric'), ('l_returnflag', 'string', 'categorical'), ('l_linestatus', 'string', 'categorical'), ('l_shipdate', 'timestamp_ntz', 'other')]
    parts = [f"""SELECT '{c}' AS column_name, CASE WHEN min({c}) >= -128 AND max({c}) <= 127 THEN 'tinyint'
                     WHEN min({c}) >= -32768 AND max({c}) <= 32767 THEN 'smallint'
                     WHEN min({c}) >= -2147483648 AND max({c}) <= 2147483647 THEN 'int' ELSE 'bigint' END
                     AS data_type, 'numeric' AS kind FROM lineitem""" for c in ints]
    parts += [f"SELECT '{c}', '{t}', '{k}'" for c, t, k in rest]
    return union_sql(parts)


@register("p05_narrow_types", _narrow_sql())
def _p05(spark, d):
    narrowed = sch.narrow_types(table(spark, d, "lineitem"))
    return prof.schema_overview(narrowed)


def _scratch(spark, name: str) -> str:
    from ..session import ensure_checkpoint_dir
    return f"{ensure_checkpoint_dir(spark)}/tabsieve-io/{name}-{uuid.uuid4().hex[:10]}"


@register("s01_csv_roundtrip", oracle_with("""
    SELECT o_orderkey, o_orderstatus, o_orderpriority, TRY_CAST(o_totalprice_text AS DOUBLE) AS o_totalprice_text
    FROM orders_text""", "orders_text"))
def _s01(spark, d):
    path = _scratch(spark, "csv")
    sio.write_csv(table(spark, d, "orders_text"), path)
    return sio.read_csv(spark, path)


@register("s04_splits_roundtrip", R(SPLIT_SQL, ["value"]))
def _s04(spark, d):
    sp = _split_events(spark, d)
    parts = {s: sp.where(F.col("split") == s).drop("split") for s in ("train", "dev", "test")}
    path = _scratch(spark, "splits")
    sio.write_splits(parts, path)
    back = sio.read_splits(spark, path)
    out = None
    for s, df in back.items():
        part = df.withColumn("split", F.lit(s))
        out = part if out is None else out.unionByName(part)
    return out


@register("s05_params_roundtrip", ORACLE["c02_impute_mean"])
def _s05(spark, d):
    df = table(spark, d, "customer_dirty").select("c_custkey", "c_acctbal", "c_nationkey")
    params = {"impute_numeric": cln.fit_numeric_impute(df, ["c_acctbal", "c_nationkey"], "mean")}
    path = _scratch(spark, "params")
    sio.save_params(spark, params, path)
    back = sio.load_params(spark, path)
    return cln.apply_impute(df, back["impute_numeric"])


# =========================================================== C11, L1-L13, M1, M16-M19 (rows-only)

from ..operators import importance as imp  # noqa: E402
from ..operators import train as trn  # noqa: E402
from . import preprocess as pre  # noqa: E402

DOC_CFG = dict(key="doc_id", target="quality", test_size=60, dev_size=60, seed="-42",
               outlier_cols=("n_chars",), log1p_cols=("n_chars",), drop_cols=("toxic",))


def _prepared_docs(spark, d, keep_key: bool = True):
    """C11 on the labelled documents: split, fitted on train, applied to all."""
    cfg = pre.PreprocessConfig(**DOC_CFG)
    splits, params = pre.fit_transform(table(spark, d, "doc_features"), cfg, keep_key=keep_key)
    splits = {s: df.checkpoint(eager=True) for s, df in splits.items()}  # reused by every fit and score
    feats = [c for c in splits["train"].columns if c not in ("doc_id", "quality")]
    return splits, feats


LANGS = ["de", "en", "es", "fr"]
SOURCES = sorted(f"src{i}" for i in range(20))
_HOT = ", ".join(f"CAST({c} = '{v}' AS INTEGER) AS {c}_{v}" for c, vs in (("lang", LANGS), ("source", SOURCES))
                 for v in vs[1:])


@register("c11_preprocess", R(oracle_with(f"""
    WITH c AS (SELECT quality AS cls, count(*) AS n FROM doc_features GROUP BY 1),
    t AS {_quota_sql('c', '60', 'n', 'tq')},
    r AS (SELECT cls, n - tq AS rest, tq FROM t),
    dv AS {_quota_sql('r', '60', 'rest', 'dq')},
    q AS (SELECT r.cls, r.tq, dv.dq FROM r JOIN dv ON r.cls = dv.cls),
    ranked AS (SELECT e.*, row_number() OVER (PARTITION BY quality
                   ORDER BY md5(CAST(doc_id AS VARCHAR) || '-42'), doc_id) - 1 AS rk FROM doc_features e),
    sp AS (SELECT ranked.*, CASE WHEN rk < tq THEN 'test' WHEN rk < tq + dq THEN 'dev' ELSE 'train' END AS split
           FROM ranked JOIN q ON ranked.quality = q.cls),
    f AS (SELECT avg(n_chars) AS fill, mode(lang) AS fill_lang FROM sp WHERE split = 'train'),
    b AS (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi
          FROM (SELECT quantile_cont(n_chars, 0.25) AS q1, quantile_cont(n_chars, 0.75) AS q3 FROM sp
                WHERE split = 'train') AS x)
    SELECT doc_id, coalesce(n_chars, fill) AS n_chars, quality, {_HOT},
           CAST(coalesce(n_chars < lo OR n_chars > hi, false) AS INTEGER) AS is_outlier,
           ln(1 + coalesce(n_chars, fill)) AS n_chars_log, split
    FROM sp, f, b""", "doc_features"), ["n_chars", "n_chars_log"]))
def _c11(spark, d):
    splits, _ = _prepared_docs(spark, d)
    out = None
    for s, df in splits.items():
        part = df.withColumn("split", F.lit(s))
        out = part if out is None else out.unionByName(part)
    return out


def _fit_score(spark, d, name: str):
    splits, feats = _prepared_docs(spark, d)
    model = trn.fit_model(name, splits["train"], feats, "quality", key="doc_id")
    return trn.score(model, splits["dev"], "quality", keep=["doc_id"])


@register("l01_logistic_regression")
def _l01(spark, d):
    return _fit_score(spark, d, "logistic_regression")


@register("l02_random_forest")
def _l02(spark, d):
    return _fit_score(spark, d, "random_forest")


@register("l03_boosted_trees_weighted")
def _l03(spark, d):
    return _fit_score(spark, d, "xgboost")


@register("l04_boosted_trees_balanced")
def _l04(spark, d):
    return _fit_score(spark, d, "lightgbm")


@register("l07_cross_validation")
def _l07(spark, d):
    splits, feats = _prepared_docs(spark, d)
    return trn.cv_summary(trn.cross_validate("logistic_regression", splits["train"], feats, "quality", "doc_id",
                                             k=10)).drop("cv_scores")


@register("l10_random_search")
def _l10(spark, d):
    splits, feats = _prepared_docs(spark, d)
    # the configured search: 50 trials, 3,600 s (the operator stops at whichever comes first)
    return trn.random_search("logistic_regression", splits["train"], feats, "quality", "doc_id", n_trials=50, k=5)


@register("l11_baseline_leaderboard")
def _l11(spark, d):
    splits, feats = _prepared_docs(spark, d)
    runs = trn.train_baselines(list(trn.PRESETS), splits["train"], splits["dev"], feats, "quality", "doc_id")
    return trn.run_status(runs).join(trn.leaderboard_of(runs, "f1_score").drop("model_name"), "seq", "left")


@register("l13_tune_top_models")
def _l13(spark, d):
    """The three best presets, each searched with 50 trials of 5 folds, and the
    best of each retrained in a whole run."""
    splits, feats = _prepared_docs(spark, d)
    args = (splits["train"], splits["dev"], feats, "quality", "doc_id")
    runs = trn.train_baselines(list(trn.PRESETS), *args, cv_folds=0, importance=False)  # ranked by validation score only
    tuned = trn.tune_top(runs, *args)
    return trn.leaderboard_of(tuned, "f1_score").select("seq", "model_name", "is_tuned", "f1_score")


@register("m18_native_importance")
def _m18(spark, d):
    splits, feats = _prepared_docs(spark, d)
    model = trn.fit_model("random_forest", splits["train"], feats, "quality", key="doc_id")
    return imp.native_importance(model, feats, top=20)


@register("m19_permutation_importance")
def _m19(spark, d):
    splits, feats = _prepared_docs(spark, d)
    model = trn.fit_model("random_forest", splits["train"], feats, "quality", key="doc_id")
    return imp.permutation_importance(model, splits["dev"], feats, "quality", "doc_id", n_repeats=10)


# =========================================================== per-operator entries for A8, F1, F2, T7, T10, G9, L12, M17

@register("a08_duplicate_pct", R(oracle_with("""
    SELECT CAST((count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM lineitem_dup) AS d)) * 100.0 / count(*)
                AS DOUBLE) AS duplicate_pct FROM lineitem_dup""", "lineitem_dup"), ["duplicate_pct"]))
def _a08(spark, d):
    return qual.duplicate_summary(table(spark, d, "lineitem_dup")).select("duplicate_pct")


@register("f01_range_predicate", "SELECT event_id, value FROM events WHERE value < 10.0 OR value > 100.0")
def _f01(spark, d):
    ev = table(spark, d, "events")
    return ev.where(prof.outside_range("value", 10.0, 100.0)).select("event_id", "value")


@register("f02_group_values", "SELECT value FROM events WHERE event_type = 'purchase' AND value IS NOT NULL")
def _f02(spark, d):
    return prof.group_values(table(spark, d, "events"), "value", "event_type", "purchase")


LI_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@register("t07_compare_all_columns", R(compare_sql(_long_sql(
    "lineitem", LI_COLS, ", CAST(l_returnflag = 'R' AS INTEGER) AS g1", "l_returnflag IN ('R', 'A')")), _COMPARE_COLS))
def _t07(spark, d):
    return st.compare_two_groups(table(spark, d, "lineitem"), LI_COLS, "l_returnflag", "R", "A").drop("p_value")


@register("t10_cramers_v", R(oracle_with(
    f"SELECT column_name, cramers_v, effect FROM ({chi_square_sql('doc_features', ['lang', 'source'], 'quality')}) AS c",
    "doc_features"), ["cramers_v"]))
def _t10(spark, d):
    return st.chi_square(table(spark, d, "doc_features"), None, "quality").select(COLUMN, "cramers_v", "effect")


@register("g09_promote", ORACLE["g08_overall_verdict"].replace(
    "SELECT model, bool_and(passed) AS overall_passed, count(*) FILTER (WHERE NOT passed) AS failed_checks\n"
    "    FROM u GROUP BY model",
    "SELECT model, 'Staging' AS stage FROM u GROUP BY model HAVING bool_and(passed)"))
def _g09(spark, d):
    return gt.promote(_g08(spark, d), "model").select("model", "stage")


@register("l12_train_single")
def _l12(spark, d):
    splits, feats = _prepared_docs(spark, d)
    return trn.run_record(trn.train_single("random_forest", splits["train"], splits["dev"], feats, "quality", "doc_id"))


@register("m17_importance_analysis")
def _m17(spark, d):
    splits, feats = _prepared_docs(spark, d)
    model = trn.fit_model("random_forest", splits["train"], feats, "quality", key="doc_id")
    return imp.analyze(model, splits["dev"], feats, "quality", "doc_id", n_repeats=10)


@register("d08_model_plot_data", R(f"""{SCORED_CTE},
    g AS (SELECT model, l.label, p.prediction FROM (SELECT DISTINCT model FROM s) AS k,
          (VALUES (0), (1)) AS l(label), (VALUES (0), (1)) AS p(prediction)),
    c AS (SELECT model, label, prediction, count(*) AS cnt FROM s GROUP BY ALL),
    cum AS ({_cum_sql('model')})
    SELECT g.model, 'confusion' AS chart, CAST(g.label AS DOUBLE) AS x, CAST(g.prediction AS DOUBLE) AS y,
           CAST(NULL AS DOUBLE) AS threshold, coalesce(c.cnt, 0) AS "count", CAST(NULL AS VARCHAR) AS feature
    FROM g LEFT JOIN c ON g.model = c.model AND g.label = c.label AND g.prediction = c.prediction
    UNION ALL
    SELECT model, 'roc', CASE WHEN n_tot - p_tot > 0 THEN (k - tp) / (n_tot - p_tot) ELSE 0.0 END,
           CASE WHEN p_tot > 0 THEN tp / p_tot ELSE 0.0 END, probability, NULL, NULL FROM cum
    UNION ALL
    SELECT model, 'pr', CASE WHEN p_tot > 0 THEN tp / p_tot ELSE 0.0 END, tp / k, probability, NULL, NULL
    FROM cum""", ["x", "y", "threshold"]))
def _d08(spark, d):
    return mt.model_plot_data(_scored_runs(spark, d), ["model"])


# =========================================================== attributions, learning curve, neighbours, oversampling

from ..operators import attribution as att  # noqa: E402
from ..operators import learning_curve as lcv  # noqa: E402
from ..operators import neighbours as nbr  # noqa: E402


@register("m20_shap_values")
def _m20(spark, d):
    splits, feats = _prepared_docs(spark, d)
    model = trn.fit_model("xgboost", splits["train"], feats, "quality", key="doc_id")
    return att.shap_values(model, splits["dev"], feats, "doc_id", background=splits["train"])


@register("m21_shap_summary")
def _m21(spark, d):
    splits, feats = _prepared_docs(spark, d)
    model = trn.fit_model("random_forest", splits["train"], feats, "quality", key="doc_id")
    return att.shap_summary(att.shap_values(model, splits["dev"], feats, "doc_id", background=splits["train"]))


@register("l14_learning_curve")
def _l14(spark, d):
    splits, feats = _prepared_docs(spark, d)
    return lcv.learning_curve([(n, {}) for n in trn.PRESETS], splits["train"], splits["dev"], feats, "quality", "doc_id",
                              metrics=("f1_score", "accuracy", "log_loss"))


_POINTS = """p AS (SELECT c_custkey AS k, CAST(c_acctbal AS DOUBLE) AS a, CAST(c_nationkey AS DOUBLE) AS b, c_mktsegment AS y
              FROM customer)"""


@register("d09_nearest_neighbours", R(f"""
    WITH {_POINTS},
    j AS (SELECT x.k, z.k AS other, (x.a - z.a) * (x.a - z.a) + (x.b - z.b) * (x.b - z.b) AS sq
          FROM p AS x JOIN p AS z ON x.k <> z.k),
    r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY sq, other) AS place FROM j)
    SELECT k AS c_custkey, other AS neighbour, sqrt(sq) AS distance, CAST(place AS INTEGER) AS place FROM r WHERE place <= 5""",
    ["distance"]))
def _d09(spark, d):
    return nbr.nearest_neighbours(table(spark, d, "customer"), "c_custkey", ["c_acctbal", "c_nationkey"], 5)


def _draw_sql(tag: str) -> str:
    return f"CAST('0x' || substr(md5(CAST(k AS VARCHAR) || '/' || CAST(i AS VARCHAR) || '/{tag}/42'), 1, 8) AS BIGINT)"


@register("c12_smote", R(f"""
    WITH {_POINTS},
    n AS (SELECT y, count(*) AS n FROM p GROUP BY y),
    need AS (SELECT y, n, (SELECT max(n) FROM n) - n AS need FROM n),
    r AS (SELECT p.*, need.n, need.need,
                 row_number() OVER (PARTITION BY p.y ORDER BY md5(CAST(k AS VARCHAR) || '42'), k) - 1 AS rk
          FROM p JOIN need ON p.y = need.y),
    j AS (SELECT x.k, z.a AS ta, z.b AS tb, row_number() OVER (PARTITION BY x.k ORDER BY
                 (x.a - z.a) * (x.a - z.a) + (x.b - z.b) * (x.b - z.b), z.k) AS place
          FROM p AS x JOIN p AS z ON x.y = z.y AND x.k <> z.k),
    c AS (SELECT r.*, unnest(generate_series(1, need // n + CASE WHEN rk < need % n THEN 1 ELSE 0 END)) AS i FROM r),
    g AS (SELECT c.*, {_draw_sql('neighbour')} % least(5, n - 1) + 1 AS pick, {_draw_sql('gap')} / 4294967296.0 AS gap FROM c)
    SELECT CAST(NULL AS BIGINT) AS c_custkey, g.y AS c_mktsegment, g.a + gap * (j.ta - g.a) AS c_acctbal,
           g.b + gap * (j.tb - g.b) AS c_nationkey, true AS synthetic, g.k AS base, CAST(g.i AS INTEGER) AS "copy"
    FROM g JOIN j ON g.k = j.k AND j.place = g.pick
    UNION ALL
    SELECT k, y, a, b, false, NULL, NULL FROM p""", ["c_acctbal", "c_nationkey"]))
def _c12(spark, d):
    return nbr.smote(table(spark, d, "customer"), ["c_acctbal", "c_nationkey"], "c_mktsegment", "c_custkey")
