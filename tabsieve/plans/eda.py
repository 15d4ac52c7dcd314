"""EDA plan (A20, A21, S6, S7): load -> normalise nulls -> profiles,
quality checks, distribution data -> summary tables and one report row.

The report shares its aggregates: row count, null counts and the
duplicate count are each one job, whatever the column count."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import categorical_columns, column_kinds, nan_to_null, numeric_columns
from ..operators import profile as prof
from ..operators import quality as qual
from ..sources import io
from .views import table


def eda_flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IQR outlier summary of ``events`` (exact quartiles, then one counting
    pass with the bounds as literals)."""
    return qual.iqr_outlier_summary(table(spark, sf_dir, "events"), exclude=["event_id"])


def eda_report(df: DataFrame, target: str | None = None, ignore_for_duplicates: Sequence[str] = ()) -> DataFrame:
    """One row with shape, column kinds, missing totals, duplicates and
    (if given) the target's class counts."""
    kinds = column_kinds(df)
    nc = prof.null_counts(df).agg(F.sum("missing_count").alias("missing_total"), F.max("n_rows").alias("n_rows"))
    dup = qual.duplicate_summary(df, ignore_for_duplicates).select("n_duplicates", "duplicate_pct")
    n_cols = len(df.columns)
    row = nc.select(
        F.col("n_rows").cast("bigint").alias("n_rows"), F.lit(n_cols).alias("n_columns"),
        F.lit(sum(1 for k in kinds.values() if k == "numeric")).alias("n_numeric"),
        F.lit(sum(1 for k in kinds.values() if k == "categorical")).alias("n_categorical"),
        F.col("missing_total").cast("bigint").alias("missing_total"),
        F.try_divide(F.col("missing_total") * 100.0, F.col("n_rows") * n_cols).alias("missing_pct_overall"))
    row = row.withColumns({"n_duplicates": dup.select("n_duplicates").scalar(),
                           "duplicate_pct": dup.select("duplicate_pct").scalar()})
    if target:
        td = prof.target_distribution(df, target)
        classes = td.agg(F.sort_array(F.collect_list(F.struct(F.col(target).cast("string").alias("class"),
                                                              "count", "percent")))).scalar()
        row = row.withColumn("target_distribution", classes)
    return row


def run(spark: SparkSession, df: DataFrame, out_dir: str, target: str | None = None, id_column: str | None = None,
        outlier_exclude: Sequence[str] = ()) -> dict:
    """The whole EDA with its sinks: numeric and categorical profiles,
    missing report, outlier summary, duplicate rows (S6) and the report
    (S7), and the list of feature names for later schema checks.  Returns the
    report as a dict."""
    df = nan_to_null(df)
    num = prof.numeric_profile(df, numeric_columns(df, [c for c in (id_column, target) if c]))
    cat = prof.categorical_profile(df, categorical_columns(df))
    io.write_csv(num, f"{out_dir}/numeric_summary")
    io.write_csv(cat, f"{out_dir}/categorical_summary")
    io.write_csv(qual.missing_report(df), f"{out_dir}/missing_values")
    io.write_csv(qual.iqr_outlier_summary(df, exclude=[*outlier_exclude, *(c for c in (id_column,) if c)]),
                 f"{out_dir}/outlier_summary")
    io.write_csv(qual.duplicate_rows(df), f"{out_dir}/duplicate_rows")
    report = eda_report(df, target, [id_column] if id_column else []).first().asDict(recursive=True)
    io.write_json_report(spark, report, f"{out_dir}/report")
    io.write_json_report(spark, {"expected_columns": df.columns}, f"{out_dir}/expected_columns")
    return report
