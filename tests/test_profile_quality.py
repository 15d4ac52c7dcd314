import math

import pytest
from pyspark.sql import functions as F

from tabsieve.operators import clean, profile, quality, schema


def test_numeric_profile_moments_fixture(spark):
    df = spark.createDataFrame([(float(v), 1) for v in (1, 2, 4, 9, 16)], "x double, id int")
    r = profile.numeric_profile(df, id_column="id").first()
    assert r["skewness"] == pytest.approx(1.135313, abs=1e-6)
    assert r["kurtosis"] == pytest.approx(0.348833, abs=1e-6)
    assert (r["q25"], r["q50"], r["q75"]) == (2.0, 4.0, 9.0)
    assert r["std"] == pytest.approx(6.188699, abs=1e-6)


def test_categorical_profile_top_tie_smallest(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "g string")
    r = profile.categorical_profile(df).first()
    assert (r["top"], r["freq"], r["count"], r["unique"], r["missing_count"]) == ("a", 2, 4, 2, 1)
    assert r["missing_pct"] == pytest.approx(20.0)


def test_mode_impute_fixture(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,)], "g string")
    assert clean.fit_mode_impute(df, ["g"]) == {"g": "a"}
    empty = spark.createDataFrame([(None,), (None,)], "g string")
    assert clean.fit_mode_impute(empty, ["g"]) == {"g": "Unknown"}


def test_log1p_edges(spark):
    df = spark.createDataFrame([(-1.0,), (-2.0,), (0.0,)], "x double")
    got = [r["x_log"] for r in clean.log1p_columns(df, ["x"]).collect()]
    assert got[0] == -math.inf and math.isnan(got[1]) and got[2] == 0.0


def test_one_hot_fixture(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "g string")
    lv = clean.fit_one_hot(df, ["g"])
    out = clean.apply_one_hot(df, lv)
    assert out.columns == ["g_b", "g_c"]
    assert [tuple(r) for r in out.collect()] == [(1, 0), (0, 0), (0, 0), (0, 1)]


def test_one_hot_level_cap(spark):
    df = spark.range(50).select(F.col("id").cast("string").alias("g"))
    with pytest.raises(ValueError):
        clean.fit_one_hot(df, ["g"], max_levels=10)


def test_missing_report_empty_and_severity(spark):
    df = spark.createDataFrame([(1, "a")], "x int, y string")
    assert quality.missing_report(df).count() == 0
    d2 = spark.createDataFrame([(None, "a"), (1, None), (2, "b"), (3, "c")] * 10, "x int, y string")
    rows = {r["column_name"]: r for r in quality.missing_report(d2).collect()}
    assert rows["x"]["severity"] == "WARNING" and rows["x"]["missing_fraction"] == 0.25


def test_duplicates_with_nulls(spark):
    rows = [(1, None), (1, None), (2, "a"), (2, "a"), (2, "a"), (3, "b")]
    df = spark.createDataFrame(rows, "k int, v string")
    s = quality.duplicate_summary(df).first()
    assert (s["n_duplicates"], s["n_distinct"]) == (3, 3)
    assert quality.duplicate_rows(df).count() == 5
    assert quality.later_copies(df).count() == 3


def test_duplicate_expansion_spreads_large_group(spark, monkeypatch):
    monkeypatch.setattr(quality, "EXPAND_CHUNK", 7)
    df = spark.range(100).select(F.lit(1).alias("k"))
    assert quality.duplicate_rows(df).count() == 100
    assert sorted(r["copy_no"] for r in quality.later_copies(df).collect()) == list(range(2, 101))


def test_outlier_flags_null_is_inside(spark):
    df = spark.createDataFrame([(1.0,), (None,), (100.0,)], "x double")
    out = clean.flag_outliers(df, {"x": (0.0, 10.0)}).collect()
    assert [r["is_outlier"] for r in out] == [0, 0, 1]


def test_schema_check_and_casts(spark):
    df = spark.createDataFrame([("1.7", 1), ("-1.7", 2), ("N/A", 3)], "a string, b int")
    chk = {(r["column_name"], r["status"]) for r in schema.validate_schema(df, ["a", "c"]).collect()}
    assert ("c", "missing") in chk and ("b", "extra") in chk and (None, "ok") in chk
    with pytest.raises(ValueError):
        schema.assert_valid(schema.validate_schema(df, ["a", "c"]))
    got = [r["a"] for r in schema.coerce_to_int(df, ["a", "zz"]).collect()]
    assert got == [1, -1, 0]
    with pytest.raises(KeyError):
        schema.drop_columns(df, ["zz"])
    with pytest.raises(TypeError):
        schema.assert_numeric(df)


def test_narrow_types(spark):
    df = spark.createDataFrame([(1, 100000), (2, 3)], "a bigint, b bigint")
    out = schema.narrow_types(df)
    assert dict(out.dtypes) == {"a": "tinyint", "b": "int"}


def test_sanitize(spark):
    df = spark.createDataFrame([(float("inf"),), (float("nan"),), (None,), (2.0,)], "x double")
    assert [r["x"] for r in schema.sanitize(df).collect()] == [0.0, 0.0, 0.0, 2.0]
