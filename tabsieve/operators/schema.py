"""Schema checks, projections and cleaning casts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COLUMN, numeric_columns


def validate_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """``(check, column_name, status)``.  Missing column -> ``missing``
    (an error), extra column -> ``extra`` (a warning), present -> ``ok``,
    duplicate names -> ``duplicate``; plus one ``rows`` check that fails on an
    empty table.  Only the emptiness test touches data (``isEmpty`` reads one
    row at most)."""
    cols = df.columns
    seen, dups = set(), set()
    for c in cols:
        (dups if c in seen else seen).add(c)
    rows = [("column", c, "ok" if c in seen else "missing") for c in expected]
    rows += [("column", c, "extra") for c in cols if c not in set(expected)]
    rows += [("column", c, "duplicate") for c in sorted(dups)]
    spark = df.sparkSession
    checks = spark.createDataFrame(rows, f"check string, {COLUMN} string, status string")
    non_empty = df.limit(1).agg(F.count(F.lit(1))).scalar()
    rows_check = spark.range(1).select(F.lit("rows").alias("check"), F.lit(None).cast("string").alias(COLUMN),
                                       F.when(non_empty > 0, "ok").otherwise("empty").alias("status"))
    return checks.unionByName(rows_check)


def assert_valid(check: DataFrame) -> None:
    """Raise on missing or duplicate columns or an empty table."""
    bad = check.where(F.col("status").isin("missing", "duplicate", "empty")).collect()
    if bad:
        raise ValueError("schema check failed: " + ", ".join(f"{r['check']}:{r[COLUMN]}:{r['status']}" for r in bad))


def coerce_to_int(df: DataFrame, cols: Sequence[str], plain: bool = False) -> DataFrame:
    """Text or number -> bigint; unparseable -> NULL -> 0 and fractions cut
    toward zero.  Absent columns are skipped.  ``plain=True`` is a plain cast
    that keeps NULL."""
    present = [c for c in cols if c in df.columns]
    conv = {}
    for c in present:
        # whole numbers go straight to bigint: a double holds them only up to 2^53
        x = F.coalesce(F.col(f"`{c}`").try_cast("bigint"), F.col(f"`{c}`").try_cast("double").try_cast("bigint"))
        conv[c] = x if plain else F.coalesce(x, F.lit(0).cast("bigint"))
    return df.withColumns(conv) if conv else df


def drop_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop columns; an absent name is an error (Spark would ignore it)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"cannot drop absent columns {missing}")
    return df.drop(*cols)


def narrow_types(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P5 (opt-in): integer columns to the smallest signed type holding their
    range, found by one min/max aggregate."""
    ints = [f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))]
    cols = [c for c in (cols or ints) if c in ints]
    if not cols:
        return df
    mm = df.agg(*[F.min(c).alias(f"mn_{i}") for i, c in enumerate(cols)],
                *[F.max(c).alias(f"mx_{i}") for i, c in enumerate(cols)]).first()
    casts = {}
    for i, c in enumerate(cols):
        lo, hi = mm[f"mn_{i}"], mm[f"mx_{i}"]
        if lo is None:
            continue
        for t, a, b in (("tinyint", -128, 127), ("smallint", -32768, 32767),
                        ("int", -2**31, 2**31 - 1), ("bigint", -2**63, 2**63 - 1)):
            if a <= lo and hi <= b:
                casts[c] = F.col(c).cast(t)
                break
    return df.withColumns(casts)


def assert_numeric(df: DataFrame) -> None:
    """Every column must be numeric before training."""
    bad = [f.name for f in df.schema.fields if not isinstance(f.dataType, T.NumericType)]
    if bad:
        raise TypeError(f"non-numeric columns: {bad}")


def sanitize(df: DataFrame, cols: Sequence[str] | None = None, fill: float = 0.0) -> DataFrame:
    """+-inf and NaN -> NULL -> ``fill`` for floating columns."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = [c for c in (cols or fl) if c in fl]
    inf = float("inf")
    conv = {c: F.coalesce(F.when(F.col(c).isin(inf, -inf) | F.isnan(c), F.lit(None)).otherwise(F.col(c)),
                          F.lit(fill)) for c in cols}
    return df.withColumns(conv) if conv else df


def sanitize_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P7 report: per floating column, how many values were inf, NaN or NULL."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    cols = [c for c in (cols or fl) if c in fl]
    inf = float("inf")
    structs = [F.struct(F.lit(c).alias(COLUMN),
                        F.count_if(F.col(c).isin(inf, -inf)).alias("n_infinite"),
                        F.count_if(F.col(c).isNull() | F.isnan(c)).alias("n_missing")) for c in cols]
    return df.agg(F.array(*structs).alias("_s")).select(F.explode("_s").alias("s")).select("s.*")


def feature_target(df: DataFrame, target: str, drop: Sequence[str] = ()) -> tuple[list[str], str]:
    """Feature names (all columns but target and ``drop``); target must exist."""
    if target not in df.columns:
        raise KeyError(f"target {target!r} not in table")
    feats = [c for c in df.columns if c != target and c not in set(drop)]
    return feats, target


def check_same_features(a: Sequence[str], b: Sequence[str]) -> None:
    """Splits must carry the same feature names in the same order."""
    if list(a) != list(b):
        raise ValueError(f"feature lists differ: {sorted(set(a) ^ set(b))}")


__all__ = ["validate_schema", "assert_valid", "coerce_to_int", "drop_columns", "narrow_types",
           "assert_numeric", "sanitize", "sanitize_counts", "feature_target", "check_same_features",
           "numeric_columns"]
