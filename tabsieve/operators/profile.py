"""Column profiles, null counts, value counts and the filters used by the
quality checks (A1-A4, A12-A20, F1-F4).

Every profile is one wide aggregate over all columns, exploded to a long
table with one row per column, so a profile costs one scan however many
columns are profiled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import (COLUMN, VALUE, categorical_columns, clean_double, column_kinds,
                                 numeric_columns, require_columns, to_long)
from ..functions.ranks import quantile_table
from ..functions.stats import sample_excess_kurtosis, sample_skewness

N_ROWS = "_n_rows"


def _explode_structs(df: DataFrame, structs: list[Column], extra: Sequence[Column] = ()) -> DataFrame:
    """One row per struct; at least one struct."""
    row = df.agg(F.count(F.lit(1)).alias(N_ROWS), *extra, F.array(*structs).alias("_s"))
    return row.select("*", F.explode("_s").alias("_one")).drop("_s").select("*", "_one.*").drop("_one")


# ----------------------------------------------------------------- A1 numeric profile

NUMERIC_PROFILE_SCHEMA = (
    f"{COLUMN} string, count bigint, mean double, std double, min double, q25 double, q50 double, q75 double, "
    "max double, range double, missing_count bigint, missing_pct double, skewness double, kurtosis double")


def numeric_profile(df: DataFrame, cols: Sequence[str] | None = None, id_column: str | None = None,
                    quantile_method: str = "exact") -> DataFrame:
    """No numeric column gives an empty table.  Per numeric column: count, mean, std (n-1), min, q25, q50, q75 (linear
    interpolation), max, range, missing_count, missing_pct (of all rows),
    bias-corrected skewness and excess kurtosis.  The id column is left out."""
    cols = list(cols) if cols is not None else numeric_columns(df, [id_column] if id_column else [])
    require_columns(df, cols)
    if not cols:
        return df.sparkSession.createDataFrame([], NUMERIC_PROFILE_SCHEMA)
    structs = []
    for c in cols:
        x = clean_double(c)
        structs.append(F.struct(
            F.lit(c).alias(COLUMN), F.count(x).alias("count"), F.avg(x).alias("mean"),
            F.stddev_samp(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"),
            F.count_if(x.isNull()).alias("missing_count"),
            F.skewness(x).alias("_g1"), F.kurtosis(x).alias("_g2")))
    moments = _explode_structs(df, structs)
    quart = quantile_table(df, cols, [0.25, 0.5, 0.75], ["q25", "q50", "q75"], method=quantile_method)
    out = moments.join(F.broadcast(quart), COLUMN, "left")
    n = F.col("count")
    return out.select(
        COLUMN, "count", "mean", "std", "min", "q25", "q50", "q75", "max",
        (F.col("max") - F.col("min")).alias("range"),
        "missing_count",
        F.try_divide(F.col("missing_count") * 100.0, F.col(N_ROWS)).alias("missing_pct"),
        sample_skewness(F.col("_g1"), n).alias("skewness"),
        sample_excess_kurtosis(F.col("_g2"), n).alias("kurtosis"))


# ----------------------------------------------------------------- A2 categorical profile

def value_counts_long(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column_name, value, cnt)`` for every column and value, NULL included.
    One shuffle with map-side combine: a value held by a third of all rows
    is one row per task before the shuffle."""
    long = to_long(df, cols, as_type="string")
    return long.groupBy(COLUMN, VALUE).agg(F.count(F.lit(1)).alias("cnt"))


def categorical_profile(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per categorical column: count, unique, top (most frequent; tie -> smallest
    value), freq, missing_count, missing_pct, unique_count, cardinality_pct
    (percent of all rows)."""
    cols = list(cols) if cols is not None else categorical_columns(df)
    require_columns(df, cols)
    vc = value_counts_long(df, cols)
    n_rows = df.agg(F.count(F.lit(1))).scalar()
    nn = F.col(VALUE).isNotNull()
    agg = vc.groupBy(COLUMN).agg(
        F.sum(F.when(nn, F.col("cnt")).otherwise(0)).alias("count"),
        F.count(F.col(VALUE)).alias("unique"),
        F.min_by(F.when(nn, F.col(VALUE)),
                 F.when(nn, F.struct((-F.col("cnt")).alias("c"), F.col(VALUE).alias("v")))).alias("top"),
        F.max(F.when(nn, F.col("cnt"))).alias("freq"),
        F.sum(F.when(~nn, F.col("cnt")).otherwise(0)).alias("missing_count"))
    out = agg.withColumn(N_ROWS, n_rows)
    return out.select(
        COLUMN, F.col("count").cast("bigint").alias("count"), F.col("unique").cast("bigint").alias("unique"),
        "top", F.col("freq").cast("bigint").alias("freq"),
        F.col("missing_count").cast("bigint").alias("missing_count"),
        F.try_divide(F.col("missing_count") * 100.0, F.col(N_ROWS)).alias("missing_pct"),
        F.col("unique").cast("bigint").alias("unique_count"),
        F.try_divide(F.col("unique") * 100.0, F.col(N_ROWS)).alias("cardinality_pct"))


# ----------------------------------------------------------------- A3 describe everything

def describe_all(df: DataFrame, id_column: str | None = None) -> DataFrame:
    """Numeric and categorical profiles in one table; statistics that do not
    apply to a kind are NULL."""
    num = numeric_profile(df, id_column=id_column)
    cat = categorical_profile(df)
    return (num.withColumn("kind", F.lit("numeric"))
            .unionByName(cat.withColumn("kind", F.lit("categorical")), allowMissingColumns=True))


# ----------------------------------------------------------------- A4 / A6 null counts

def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, missing_count, n_rows)`` for every column, one scan.
    NaN in floating columns counts as missing."""
    cols = list(cols) if cols is not None else df.columns
    structs = []
    fl = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    for c in cols:
        miss = F.col(c).isNull() | F.isnan(c) if c in fl else F.col(c).isNull()
        structs.append(F.struct(F.lit(c).alias(COLUMN), F.count_if(miss).alias("missing_count")))
    out = _explode_structs(df, structs)
    return out.select(COLUMN, "missing_count", F.col(N_ROWS).alias("n_rows"))


def overall_missing_pct(df: DataFrame) -> DataFrame:
    """Nulls / (rows · columns) · 100 as one row."""
    nc = null_counts(df)
    return nc.agg(F.try_divide(F.sum("missing_count") * 100.0, F.max("n_rows") * F.lit(len(df.columns)))
                  .alias("missing_pct_overall"),
                  F.sum("missing_count").alias("missing_total"))


def columns_with_nulls(df: DataFrame) -> DataFrame:
    """the null-count table restricted to columns that have nulls."""
    return null_counts(df).where(F.col("missing_count") > 0)


# ----------------------------------------------------------------- A12, A13, A14, A17

def value_counts(df: DataFrame, col: str, dropna: bool = True) -> DataFrame:
    """``(value, count, share)``; share of the counted rows."""
    base = df.where(F.col(col).isNotNull()) if dropna else df
    vc = base.groupBy(F.col(col).alias(VALUE)).agg(F.count(F.lit(1)).alias("count"))
    tot = vc.agg(F.sum("count")).scalar()
    return vc.select(VALUE, "count", F.try_divide(F.col("count"), tot).alias("share"))


def target_distribution(df: DataFrame, target: str) -> DataFrame:
    """Count and percent per class."""
    return (value_counts(df, target, dropna=False)
            .select(F.col(VALUE).alias(target), "count", (F.col("share") * 100).alias("percent")))


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """Counts for integer labels 0..max, zero classes kept (bincount); a
    negative label is an error.  The label range is a distributed
    ``spark.range``, whatever its length."""
    counts = df.where(F.col(label).isNotNull()).groupBy(F.col(label).cast("int").alias("label")) \
        .agg(F.count(F.lit(1)).alias("count"))
    low, top = counts.agg(F.min("label"), F.max("label")).first()
    if low is not None and low < 0:
        raise ValueError(f"{label!r} has the negative label {low}")
    grid = df.sparkSession.range(0, 0 if top is None else max(top, 0) + 1).select(F.col("id").cast("int").alias("label"))
    return grid.join(counts, "label", "left").select("label", F.coalesce("count", F.lit(0)).alias("count"))


def conditional_mean(df: DataFrame, col: str, by: str) -> DataFrame:
    """Mean of ``col`` per value of ``by``."""
    return df.groupBy(by).agg(F.avg(clean_double(col)).alias(f"mean_{col}"))


# ----------------------------------------------------------------- A15, A16

def min_max(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column_name, min, max)`` for numeric columns."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    structs = [F.struct(F.lit(c).alias(COLUMN), F.min(clean_double(c)).alias("min"),
                        F.max(clean_double(c)).alias("max")) for c in cols]
    return _explode_structs(df, structs).select(COLUMN, "min", "max")


def distinct_preview(df: DataFrame, cols: Sequence[str] | None = None, k: int = 4) -> DataFrame:
    """Distinct count per column and its ``k`` smallest distinct values,
    as ``(column_name, n_distinct, value_rank, value)``.  The top-k filter on a
    row_number lets Spark cut each task to k rows before the shuffle."""
    cols = list(cols) if cols is not None else df.columns
    vc = value_counts_long(df, cols).where(F.col(VALUE).isNotNull())
    nd = vc.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("n_distinct"))
    w = Window.partitionBy(COLUMN).orderBy(VALUE)
    first = vc.withColumn("value_rank", F.row_number().over(w)).where(F.col("value_rank") <= k)
    return first.join(F.broadcast(nd), COLUMN).select(COLUMN, "n_distinct", "value_rank", VALUE)


# ----------------------------------------------------------------- A18, A19

def schema_overview(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, kind)``; built from the schema only."""
    kinds = column_kinds(df)
    rows = [(f.name, f.dataType.simpleString(), kinds[f.name]) for f in df.schema.fields]
    return df.sparkSession.createDataFrame(rows, f"{COLUMN} string, data_type string, kind string")


def shape_and_kinds(df: DataFrame) -> DataFrame:
    """``(kind, n_columns, n_rows)`` with the row count from one scan."""
    kinds = column_kinds(df)
    per = {}
    for k in kinds.values():
        per[k] = per.get(k, 0) + 1
    n = df.agg(F.count(F.lit(1))).scalar()
    kd = df.sparkSession.createDataFrame(sorted(per.items()), "kind string, n_columns int")
    return kd.withColumn("n_rows", n)


def dataset_metadata(splits: dict[str, DataFrame], label: str) -> DataFrame:
    """Per split and class, the row count, feature count and class count."""
    parts = []
    for name, d in splits.items():
        n_feat = len([c for c in d.columns if c != label])
        parts.append(class_counts(d, label).withColumn("split", F.lit(name))
                     .withColumn("n_features", F.lit(n_feat)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    w = Window.partitionBy("split")
    return out.withColumn("n_rows", F.sum("count").over(w)).select(
        "split", "n_rows", "n_features", "label", "count")


# ----------------------------------------------------------------- F1, F2, F4

def outside_range(c: str | Column, lower: float | Column, upper: float | Column) -> Column:
    """strict ``x < lower OR x > upper``; NULL counts as inside."""
    x = F.col(c) if isinstance(c, str) else c
    lo = lower if isinstance(lower, Column) else F.lit(lower)
    hi = upper if isinstance(upper, Column) else F.lit(upper)
    return F.coalesce((x < lo) | (x > hi), F.lit(False))


def group_values(df: DataFrame, col: str, group_col: str, group_value) -> DataFrame:
    """values of ``col`` in one group, nulls dropped."""
    return df.where((F.col(group_col) == F.lit(group_value)) & F.col(col).isNotNull()).select(col)


def outlier_rows(df: DataFrame, bounds: DataFrame, key: str) -> DataFrame:
    """every (row, column) outside its bounds, stacked long:
    ``(key, column_name, value, lower_bound, upper_bound)``.  ``bounds`` has one
    row per column (small, broadcast)."""
    # the bounds are fitted once; their few rows go in as literals
    fixed = {r[COLUMN]: (r["lower_bound"], r["upper_bound"]) for r in bounds.collect()}
    long = to_long(df, list(fixed), keep=[key])
    if not fixed:
        return long.withColumn("lower_bound", F.lit(None).cast("double")).withColumn(
            "upper_bound", F.lit(None).cast("double"))
    limits = F.create_map(*[x for c, (lo, hi) in fixed.items() for x in (
        F.lit(c), F.struct(F.lit(lo).cast("double").alias("lo"), F.lit(hi).cast("double").alias("hi")))])[F.col(COLUMN)]
    j = long.withColumn("lower_bound", limits["lo"]).withColumn("upper_bound", limits["hi"])
    return j.where(outside_range(F.col(VALUE), F.col("lower_bound"), F.col("upper_bound"))).select(
        key, COLUMN, VALUE, "lower_bound", "upper_bound")


# ----------------------------------------------------------------- P9 preview

def head(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """First ``n`` rows by ``key`` (a top-k report)."""
    return df.orderBy(F.col(key).asc()).limit(n)


def tail(df: DataFrame, key: str, n: int = 5) -> DataFrame:
    """Last ``n`` rows by ``key``."""
    return df.orderBy(F.col(key).desc()).limit(n)
