"""Column selection by type, NaN normalisation and the long (unpivoted) layout
that every per-column summary in the package is built on."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COLUMN = "column_name"
VALUE = "value"

# Text read as null by the CSV scan, in addition to the empty string.
NULL_TOKENS = ("N/A", "NA", "NULL", "null", "NaN", "nan", "n/a", "#N/A", "None", "")


def _is_numeric(dt: T.DataType) -> bool:
    return isinstance(dt, T.NumericType)


def _is_categorical(dt: T.DataType) -> bool:
    return isinstance(dt, (T.StringType, T.BooleanType, T.VarcharType, T.CharType))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Numeric columns in schema order; booleans are not numeric."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if _is_numeric(f.dataType) and f.name not in ex]


def categorical_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """String and boolean columns; dates, timestamps and nested types are reported
    as ``other`` by :func:`column_kinds` and are never one-hot encoded."""
    ex = set(exclude)
    return [f.name for f in df.schema.fields if _is_categorical(f.dataType) and f.name not in ex]


def column_kinds(df: DataFrame) -> dict[str, str]:
    out = {}
    for f in df.schema.fields:
        out[f.name] = ("numeric" if _is_numeric(f.dataType)
                       else "categorical" if _is_categorical(f.dataType) else "other")
    return out


def clean_double(c: str | Column) -> Column:
    """Column as double with NaN mapped to NULL (Spark aggregates skip NULL, not NaN)."""
    col = F.col(c) if isinstance(c, str) else c
    d = col.cast("double")
    return F.when(F.isnan(d), F.lit(None).cast("double")).otherwise(d)


def nan_to_null(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Normalise NaN to NULL once, at load, for floating columns."""
    floating = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    targets = [c for c in (cols or df.columns) if c in floating]
    if not targets:
        return df
    return df.withColumns({c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c)) for c in targets})


def to_long(df: DataFrame, cols: Sequence[str], as_type: str = "double",
            keep: Sequence[str] = ()) -> DataFrame:
    """Unpivot ``cols`` into ``(keep..., column_name, value)`` rows (one per input
    row and column) with values cast to one type; NaN becomes NULL for doubles.
    No columns give an empty table of that schema."""
    if not cols:
        return (df.select(*keep).limit(0).withColumn(COLUMN, F.lit(None).cast("string"))
                .withColumn(VALUE, F.lit(None).cast(as_type)))
    if as_type == "double":
        vals = [clean_double(c).alias(c) for c in cols]
    else:
        vals = [F.col(c).cast(as_type).alias(c) for c in cols]
    wide = df.select(*keep, *vals)
    return wide.unpivot(list(keep) if keep else [], list(cols), COLUMN, VALUE)


def require_columns(df: DataFrame, cols: Iterable[str]) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not in table: {missing}")


def display_round(df: DataFrame, digits: int = 4, cols: Sequence[str] | None = None) -> DataFrame:
    """Floating columns rounded half-even for display; operators themselves
    return unrounded values."""
    fl = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    conv = {c: F.bround(F.col(c), digits) for c in (cols or fl) if c in fl}
    return df.withColumns(conv) if conv else df
