"""Cleaning and transformation steps.

Each fitted step is a pair: ``fit_x(df, ...) -> params`` (a small dict of
per-column scalars, found by one aggregate) and ``apply_x(df, params) -> df``
(a projection with the parameters as literals).  Because ``apply_x`` is a
pure row-wise projection it also runs unchanged on a streaming DataFrame."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COLUMN, VALUE, clean_double, require_columns
from ..functions.ranks import quantile_table
from .profile import outside_range, value_counts_long
from .quality import fit_iqr_bounds

# Fill for categorical columns without any value, and the most
# levels one categorical column may expand into.
UNKNOWN = "Unknown"
MAX_LEVELS = 1000


# ----------------------------------------------------------------- C1 duplicates

def drop_duplicate_rows(df: DataFrame, enabled: bool = True, ignore: Sequence[str] = ()) -> DataFrame:
    """Keep one row of each set of identical rows.  With ``ignore`` the
    listed columns (an id) are left out of the comparison and the row with
    the smallest ignored values, taken together in order, is kept."""
    if not enabled:
        return df
    if not ignore:
        return df.dropDuplicates()
    cols = [c for c in df.columns if c not in set(ignore)]
    keep = df.groupBy(*cols).agg(F.min(F.struct(*ignore)).alias("_first"))
    return keep.select(*cols, "_first.*").select(*df.columns)


# ----------------------------------------------------------------- C2, C3 imputation

def fit_numeric_impute(df: DataFrame, cols: Sequence[str], strategy: str = "mean") -> dict[str, float]:
    """Fill value per column (mean, or exact median), fitted for every
    listed column so later data with nulls is always covered."""
    require_columns(df, cols)
    if not cols:
        return {}
    if strategy == "mean":
        row = df.agg(*[F.avg(clean_double(c)).alias(c) for c in cols]).first()
        return {c: row[c] for c in cols}
    if strategy == "median":
        q = quantile_table(df, cols, [0.5], ["median"]).collect()
        got = {r[COLUMN]: r["median"] for r in q}
        return {c: got.get(c) for c in cols}
    raise ValueError(f"unknown strategy {strategy!r}")


def fit_mode_impute(df: DataFrame, cols: Sequence[str]) -> dict[str, str]:
    """Most frequent value per column, tie -> smallest value, no value at
    all -> ``Unknown``."""
    require_columns(df, cols)
    if not cols:
        return {}
    vc = value_counts_long(df, cols).where(F.col(VALUE).isNotNull())
    modes = vc.groupBy(COLUMN).agg(
        F.min_by(VALUE, F.struct((-F.col("cnt")).alias("c"), F.col(VALUE).alias("v"))).alias("mode"))
    got = {r[COLUMN]: r["mode"] for r in modes.collect()}
    return {c: got.get(c) if got.get(c) is not None else UNKNOWN for c in cols}


def apply_impute(df: DataFrame, numeric: dict[str, float] | None = None,
                 categorical: dict[str, str] | None = None) -> DataFrame:
    """Fill NULL (and NaN) with fitted values; numeric columns become double."""
    conv = {}
    for c, v in (numeric or {}).items():
        if c in df.columns and v is not None:
            conv[c] = F.coalesce(clean_double(c), F.lit(float(v)))
    for c, v in (categorical or {}).items():
        if c in df.columns:
            dt = df.schema[c].dataType
            if isinstance(dt, T.BooleanType):
                conv[c] = F.coalesce(F.col(c), F.lit(str(v).lower() == "true"))
            else:
                conv[c] = F.coalesce(F.col(c), F.lit(v))
    return df.withColumns(conv) if conv else df


# ----------------------------------------------------------------- C5 one-hot

def fit_one_hot(df: DataFrame, cols: Sequence[str], max_levels: int = MAX_LEVELS) -> dict[str, list[str]]:
    """C5 fit: sorted distinct non-null levels per column.  A column with more
    than ``max_levels`` levels is an error, checked before any level is
    fetched: give a larger limit, or use :func:`one_hot_vectors`."""
    require_columns(df, cols)
    if not cols:
        return {}
    vc = value_counts_long(df, cols).where(F.col(VALUE).isNotNull())
    sizes = {r[COLUMN]: r["n"] for r in vc.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("n")).collect()}
    big = {c: n for c, n in sizes.items() if n > max_levels}
    if big:
        raise ValueError(f"too many levels to one-hot encode: {big}")
    levels: dict[str, list[str]] = {c: [] for c in cols}
    for r in vc.select(COLUMN, VALUE).collect():
        levels[r[COLUMN]].append(r[VALUE])
    out = {}
    for c in cols:
        lv = sorted(levels[c])
        if isinstance(df.schema[c].dataType, T.BooleanType):
            lv = sorted("True" if v == "true" else "False" for v in lv)
        out[c] = lv
    return out


def one_hot_vectors(df: DataFrame, cols: Sequence[str], drop_first: bool = True):
    """C5 for columns of many levels: a fitted Spark ML pipeline that adds
    ``<col>_vector``, one sparse 0/1 vector a column over its sorted levels
    (first level dropped; NULL and unseen levels all zeros), so the table does
    not grow a column a level and no level count is too large."""
    from pyspark.ml import Pipeline
    from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer

    require_columns(df, cols)
    idx = [f"_{c}_index" for c in cols]
    last = "alphabetDesc" if drop_first else "alphabetAsc"  # the encoder drops the last category
    indexer = StringIndexer(inputCols=list(cols), outputCols=idx, stringOrderType=last, handleInvalid="keep")
    stages = [indexer]
    if drop_first:
        # categories by falling level: [..., first level, unseen]; both end as zeros through slicing
        from pyspark.ml.feature import VectorSlicer
        fitted = indexer.fit(df)
        hot = OneHotEncoder(inputCols=idx, outputCols=[f"_{c}_all" for c in cols], dropLast=True)
        stages = [fitted, hot]
        for c, levels in zip(cols, fitted.labelsArray):
            stages.append(VectorSlicer(inputCol=f"_{c}_all", outputCol=f"{c}_vector",
                                       indices=list(range(len(levels) - 2, -1, -1))))
    else:
        stages.append(OneHotEncoder(inputCols=idx, outputCols=[f"{c}_vector" for c in cols], dropLast=True))
    keep = ", ".join(f"`{c}`" for c in [*df.columns, *(f"{c}_vector" for c in cols)])
    return Pipeline(stages=[*stages, SQLTransformer(statement=f"SELECT {keep} FROM __THIS__")]).fit(df)


def apply_one_hot(df: DataFrame, levels: dict[str, list[str]], drop_first: bool = True) -> DataFrame:
    """C5 apply: 0/1 int columns ``<col>_<level>`` for the fitted levels (first
    level dropped), originals removed, new columns at the end.  NULL and
    unseen levels give all zeros."""
    new_cols = []
    for c, lv in levels.items():
        if c not in df.columns:
            continue
        is_bool = isinstance(df.schema[c].dataType, T.BooleanType)
        for level in (lv[1:] if drop_first else lv):
            target = F.lit(level == "True") if is_bool else F.lit(level)
            new_cols.append(F.coalesce((F.col(c) == target).cast("int"), F.lit(0)).alias(f"{c}_{level}"))
    keep = [c for c in df.columns if c not in levels]
    return df.select(*keep, *new_cols)


# ----------------------------------------------------------------- C8, C9 outliers

def fit_outlier_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float, float]]:
    """``{column: (Q1 - 1.5 IQR, Q3 + 1.5 IQR)}`` from exact quartiles."""
    require_columns(df, cols)
    if not cols:
        return {}
    return {r[COLUMN]: (r["lower_bound"], r["upper_bound"]) for r in fit_iqr_bounds(df, cols).collect()
            if r["lower_bound"] is not None}


def flag_outliers(df: DataFrame, bounds: dict[str, tuple[float, float]], enabled: bool = True,
                  flag: str = "is_outlier") -> DataFrame:
    """``is_outlier`` = 1 when a row is outside any fitted bound; rows are
    kept; columns without bounds are skipped."""
    if not enabled:
        return df
    preds = [outside_range(clean_double(c), lo, hi) for c, (lo, hi) in bounds.items() if c in df.columns]
    if not preds:
        return df.withColumn(flag, F.lit(0))
    anyp = preds[0]
    for p in preds[1:]:
        anyp = anyp | p
    return df.withColumn(flag, anyp.cast("int"))


def outlier_share(df: DataFrame, flag: str = "is_outlier") -> DataFrame:
    """C9 report: flagged rows and their share."""
    return df.agg(F.sum(flag).cast("bigint").alias("n_flagged"), F.avg(flag).alias("flagged_share"))


# ----------------------------------------------------------------- C10 log1p

def log1p_columns(df: DataFrame, cols: Sequence[str], suffix: str = "_log",
                  drop_original: bool = False) -> DataFrame:
    """``<col>_log = log1p(col)``; -1 -> -inf and below -1 -> NaN as in
    NumPy (Spark's ``log1p`` would give NULL).  Absent columns are skipped."""
    present = [c for c in cols if c in df.columns]
    conv = {}
    for c in present:
        x = clean_double(c)
        conv[f"{c}{suffix}"] = (F.when(x == -1.0, F.lit(-math.inf))
                                .when(x < -1.0, F.lit(math.nan))
                                .otherwise(F.log1p(x)))
    out = df.withColumns(conv) if conv else df
    return out.drop(*present) if drop_original else out
