"""Data-quality checks: missing report, duplicates, IQR outliers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import COLUMN, clean_double, numeric_columns, require_columns
from ..functions.ranks import quantile_table
from ..session import shuffle_partitions
from .profile import N_ROWS, _explode_structs, null_counts, outside_range

# Severity thresholds on the missing fraction, and the IQR fence.
MISSING_WARNING = 0.05
MISSING_CRITICAL = 0.30
IQR_FENCE = 1.5
HIGH_OUTLIER_PCT = 10.0
# Rows of one duplicate group expanded by one task when listing duplicates.
EXPAND_CHUNK = 100_000


# ----------------------------------------------------------------- A5 missing report

def missing_report(df: DataFrame, warning: float = MISSING_WARNING,
                   critical: float = MISSING_CRITICAL) -> DataFrame:
    """Columns with nulls: count, fraction of rows rounded half-even to 4
    places, severity (CRITICAL >= critical, WARNING >= warning, else INFO) on
    the rounded fraction; ordered by count descending.  No nulls -> no rows."""
    nc = null_counts(df).where(F.col("missing_count") > 0)
    frac = F.bround(F.try_divide(F.col("missing_count"), F.col("n_rows")), 4)
    sev = (F.when(frac >= critical, "CRITICAL").when(frac >= warning, "WARNING").otherwise("INFO"))
    return (nc.select(COLUMN, "missing_count", frac.alias("missing_fraction"), sev.alias("severity"))
            .orderBy(F.col("missing_count").desc(), F.col(COLUMN)))


# ----------------------------------------------------------------- A7-A10 duplicates

def _row_groups(df: DataFrame, ignore: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    cols = [c for c in df.columns if c not in set(ignore)]
    # groupBy treats NULL = NULL like pandas.duplicated; partial aggregation
    # collapses a hot row before the shuffle
    return df.groupBy(*cols).agg(F.count(F.lit(1)).alias("_copies")), cols


def duplicate_summary(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """A7 + A8: one row ``(n_rows, n_distinct, n_duplicates, duplicate_pct)``;
    duplicates are the rows after the first of each identical row."""
    g, _ = _row_groups(df, ignore)
    out = g.agg(F.sum("_copies").alias("n_rows"), F.count(F.lit(1)).alias("n_distinct"),
                F.sum(F.col("_copies") - 1).alias("n_duplicates"))
    return out.select(
        F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
        F.col("n_distinct").cast("bigint").alias("n_distinct"),
        F.coalesce("n_duplicates", F.lit(0)).cast("bigint").alias("n_duplicates"),
        F.coalesce(F.try_divide(F.coalesce("n_duplicates", F.lit(0)) * 100.0, F.col("n_rows")), F.lit(0.0))
        .alias("duplicate_pct"))


def _expand(groups: DataFrame, cols: list[str], first_copy: int) -> DataFrame:
    """Repeat each group row ``_copies - first_copy + 1`` times.  A group is
    first cut into chunks of EXPAND_CHUNK copies that are spread over tasks,
    so a group holding a third of all rows is not expanded by one task."""
    g = groups.where(F.col("_copies") >= F.lit(max(first_copy, 2)))
    chunk = F.lit(EXPAND_CHUNK)
    n_chunks = F.floor((F.col("_copies") - 1) / chunk).cast("int")
    chunks = g.select(*cols, "_copies", F.explode(F.sequence(F.lit(0), n_chunks)).alias("_chunk"))
    # a partition number, so that the few chunk rows are not merged into one task
    n = max(shuffle_partitions(groups.sparkSession), groups.sparkSession.sparkContext.defaultParallelism)
    chunks = chunks.repartition(n, F.xxhash64(*[F.col(c) for c in cols], F.col("_chunk")))
    lo = F.greatest(F.col("_chunk") * chunk + 1, F.lit(first_copy))
    hi = F.least((F.col("_chunk") + 1) * chunk, F.col("_copies"))
    rows = chunks.where(lo <= hi).select(*cols, F.explode(F.sequence(lo, hi)).alias("copy_no"))
    return rows


def duplicate_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """All members of duplicated rows (every copy), sorted by all columns."""
    groups, cols = _row_groups(df, ignore)
    return _expand(groups, cols, 1).select(*cols, "copy_no").orderBy(*cols, "copy_no")


def later_copies(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """A10: only the copies after the first (``df[df.duplicated()]``)."""
    groups, cols = _row_groups(df, ignore)
    return _expand(groups, cols, 2).select(*cols, "copy_no")


# ----------------------------------------------------------------- A11 IQR outliers

def fit_iqr_bounds(df: DataFrame, cols: Sequence[str], fence: float = IQR_FENCE,
                   quantile_method: str = "exact") -> DataFrame:
    """C8 / A11 pass 1: ``(column_name, q1, q3, iqr, lower_bound, upper_bound)``
    from exact quartiles of all columns in one job."""
    q = quantile_table(df, cols, [0.25, 0.75], ["q1", "q3"], method=quantile_method)
    iqr = F.col("q3") - F.col("q1")
    return q.select(COLUMN, "q1", "q3", iqr.alias("iqr"),
                    (F.col("q1") - fence * iqr).alias("lower_bound"),
                    (F.col("q3") + fence * iqr).alias("upper_bound"))


def bounds_dict(bounds: DataFrame) -> dict[str, tuple[float, float]]:
    """Fitted bounds as driver literals: one small row per column."""
    return {r[COLUMN]: (r["lower_bound"], r["upper_bound"]) for r in bounds.collect()}


OUTLIER_SCHEMA = (f"{COLUMN} string, count bigint, percentage double, lower_bound double, upper_bound double, "
                  "q1 double, q3 double, iqr double, high_outliers boolean")


def iqr_outlier_summary(df: DataFrame, cols: Sequence[str] | None = None,
                        exclude: Sequence[str] = (), fence: float = IQR_FENCE) -> DataFrame:
    """Per numeric column (minus ``exclude``): outlier count, percent of
    all rows, bounds, q1, q3, iqr and a flag for more than 10 %; a column
    without values has none and NULL bounds.  Pass 1 finds
    the quartiles; pass 2 is one aggregate with the bounds as literals."""
    cols = list(cols) if cols is not None else numeric_columns(df, exclude)
    require_columns(df, cols)
    bounds = fit_iqr_bounds(df, cols, fence)
    if not cols:
        return df.sparkSession.createDataFrame([], OUTLIER_SCHEMA)
    b = {r[COLUMN]: r.asDict() for r in bounds.collect()}
    nothing = dict.fromkeys(("q1", "q3", "iqr", "lower_bound", "upper_bound"), F.lit(None).cast("double"))
    structs = []
    for c in cols:
        r = b.get(c)
        if r is None or r["q1"] is None:
            r = nothing  # a column without values: no bounds, no outliers
        structs.append(F.struct(
            F.lit(c).alias(COLUMN),
            F.count_if(outside_range(clean_double(c), r["lower_bound"], r["upper_bound"])).alias("count"),
            *(F.lit(r[k]).alias(k) for k in ("lower_bound", "upper_bound", "q1", "q3", "iqr"))))
    out = _explode_structs(df, structs)
    pct = F.coalesce(F.try_divide(F.col("count") * 100.0, F.col(N_ROWS)), F.lit(0.0))
    return out.select(COLUMN, "count", pct.alias("percentage"), "lower_bound", "upper_bound",
                      "q1", "q3", "iqr", (pct > HIGH_OUTLIER_PCT).alias("high_outliers"))


# ----------------------------------------------------------------- A21 all checks

def run_all_checks(df: DataFrame, exclude: Sequence[str] = (), ignore_for_duplicates: Sequence[str] = (),
                   check_duplicates: bool = True, check_outliers: bool = True) -> DataFrame:
    """Missing -> duplicates -> outliers as one long table
    ``(check, column_name, metric, value, status)``."""
    parts = []
    mr = missing_report(df)
    parts.append(mr.select(F.lit("missing").alias("check"), COLUMN, F.lit("missing_fraction").alias("metric"),
                           F.col("missing_fraction").cast("double").alias("value"),
                           F.col("severity").alias("status")))
    if check_duplicates:
        ds = duplicate_summary(df, ignore_for_duplicates)
        parts.append(ds.select(F.lit("duplicates").alias("check"), F.lit(None).cast("string").alias(COLUMN),
                               F.lit("n_duplicates").alias("metric"), F.col("n_duplicates").cast("double").alias("value"),
                               F.when(F.col("n_duplicates") > 0, "WARNING").otherwise("OK").alias("status")))
    if check_outliers:
        oc = iqr_outlier_summary(df, exclude=exclude)
        parts.append(oc.select(F.lit("outliers").alias("check"), COLUMN, F.lit("percentage").alias("metric"),
                               F.col("percentage").alias("value"),
                               F.when(F.col("high_outliers"), "WARNING").otherwise("OK").alias("status")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
