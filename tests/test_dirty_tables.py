"""Ordinary dirt: constant and all-NULL columns, empty tables, no numeric
column, groups of one class, NULL classes, hot duplicate rows."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.functions import stats
from tabsieve.operators import clean, distribution, metrics, profile, quality, schema, split, stat_tests
from tabsieve.sources import io


@pytest.fixture(scope="module")
def dirty(spark):
    rows = [(i, "ab"[i % 2], 5.0, None, float(i % 13), None if i % 4 == 0 else float(i % 5)) for i in range(80)]
    return spark.createDataFrame(rows, "id bigint, g string, flat double, void double, x double, holes double")


COLS = ["flat", "void", "x", "holes"]


def test_profiles_and_outliers_report_every_column(dirty):
    prof = {r["column_name"]: r for r in profile.numeric_profile(dirty, COLS).collect()}
    assert set(prof) == set(COLS) and prof["void"]["count"] == 0 and prof["void"]["q50"] is None
    assert prof["flat"]["std"] == 0 and prof["flat"]["q25"] == 5
    out = {r["column_name"]: r for r in quality.iqr_outlier_summary(dirty, COLS).collect()}
    assert set(out) == set(COLS) and out["void"]["count"] == 0 and out["void"]["lower_bound"] is None


def test_two_group_tests_on_a_constant_column(dirty):
    w = {r["column_name"]: r for r in stat_tests.welch_t(dirty, COLS, "g", "a", "b").collect()}
    assert w["flat"]["t_statistic"] is None and w["x"]["t_statistic"] is not None
    u = {r["column_name"]: r for r in stat_tests.mann_whitney(dirty, COLS, "g", "a", "b").collect()}
    assert u["flat"]["z"] is None and u["flat"]["u_statistic"] == 800
    c = {r["column_name"]: r for r in stat_tests.compare_two_groups(dirty, COLS, "g", "a", "b").collect()}
    assert c["flat"]["p_value"] is None and c["flat"]["cohens_d"] == 0 and c["x"]["p_value"] is not None


@pytest.mark.parametrize("method", ["pearson", "spearman"])
def test_correlation_equals_pandas(dirty, method):
    got = {(r["column_a"], r["column_b"]): r["correlation"]
           for r in distribution.correlation_matrix(dirty, COLS, method).collect()}
    want = dirty.select(COLS).toPandas().astype(float).corr(method)
    for a in COLS:
        for b in COLS:
            if math.isnan(want.loc[a, b]):
                assert got[(a, b)] is None
            else:
                assert got[(a, b)] == pytest.approx(want.loc[a, b], abs=1e-12)


def test_groups_of_one_class_have_no_ranking_metric(spark):
    rows = [("only0", 0, 0, 0.2), ("only0", 0, 1, 0.7), ("only1", 1, 1, 0.9), (None, 0, 0, 0.1), (None, 1, 1, 0.8)]
    scored = spark.createDataFrame(rows, "run string, label int, prediction int, probability double")
    got = {r["run"]: r for r in metrics.evaluate(scored, ["run"]).collect()}
    assert got["only0"]["average_precision"] is None and got["only0"]["roc_auc"] is None
    assert got["only1"]["average_precision"] == 1 and got["only1"]["roc_auc"] is None
    assert got[None]["roc_auc"] == 1 and got[None]["accuracy"] == 1


def test_threshold_metrics_do_not_shuffle_scores(spark, capsys):
    scored = spark.range(100).select((F.col("id") % 2).cast("int").alias("label"),
                                     (F.col("id") % 3 % 2).cast("int").alias("prediction"),
                                     (F.col("id") / 100).alias("probability"))
    metrics.threshold_metrics(scored).explain()
    assert "hashpartitioning(probability" not in capsys.readouterr().out


def test_empty_tables_and_no_numeric_column(spark, dirty):
    none = dirty.limit(0)
    assert {r["count"] for r in profile.numeric_profile(none, ["x"]).collect()} == {0}
    assert profile.numeric_profile(dirty.select("g")).count() == 0
    assert quality.iqr_outlier_summary(dirty.select("g")).count() == 0
    assert quality.duplicate_summary(none).first()["duplicate_pct"] == 0
    assert distribution.box_stats(dirty.select("g")).count() == 0
    assert distribution.correlation_matrix(dirty.select("g")).count() == 0
    assert distribution.histogram(dirty.select("g")).count() == 0
    assert profile.class_counts(none.select(F.col("id").cast("int").alias("y")), "y").count() == 0
    empty = spark.createDataFrame([], "label int, prediction int, probability double")
    assert metrics.evaluate(empty).first()["roc_auc"] is None


def test_null_class_is_a_class(spark):
    df = spark.createDataFrame([(i, None if i % 3 == 0 else "xy"[i % 2]) for i in range(300)], "k bigint, y string")
    s = split.stratified_split(df, "k", "y", 30, 60)
    assert s.count() == 300
    assert {(r["y"], r["split"]): r["count"] for r in s.groupBy("y", "split").count().collect()}[(None, "test")] == 10
    folds = split.stratified_folds(df, "k", "y", 5)
    assert folds.count() == 300 and {r["count"] for r in folds.groupBy("y", "fold").count().collect()} == {20}
    w = split.class_weights(df, "y")
    assert w.count() == 300 and {r["weight"] for r in w.collect()} == {1.0}


def test_copies_of_one_row_leave_in_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(quality, "EXPAND_CHUNK", 50)
    df = spark.range(1000).select(F.lit(7).alias("a"), F.lit("x").alias("b"))
    out = quality.later_copies(df)
    assert out.count() == 999
    assert out.select(F.spark_partition_id().alias("p")).distinct().count() > 1


def test_ignored_columns_are_kept_from_one_row(spark):
    df = spark.createDataFrame([(1, "z", "a"), (2, "b", "a")], "id int, note string, v string")
    assert [tuple(r) for r in clean.drop_duplicate_rows(df, ignore=["id", "note"]).collect()] == [(1, "z", "a")]


def test_histogram_names_the_column_with_too_many_bins(spark):
    df = spark.range(1000).select((F.col("id") / 1000).alias("v")).union(spark.createDataFrame([(1e13,)], "v double"))
    with pytest.raises(Exception, match="histogram of v needs"):
        distribution.histogram(df, ["v"]).count()


def test_csv_keeps_whole_doubles_and_large_numbers(spark, tmp_path):
    (tmp_path / "t.csv").write_text("a,b,c,d\n67.0,9223372036854775808,9007199254740993,x\n80.0,1,2,N/A\n")
    got = io.read_csv(spark, str(tmp_path / "t.csv"))
    assert [f.dataType.simpleString() for f in got.schema] == ["double", "double", "bigint", "string"]
    assert [tuple(r) for r in got.collect()] == [(67.0, 9223372036854775808.0, 9007199254740993, "x"), (80.0, 1.0, 2, None)]
    assert io.read_table(spark, str(tmp_path / "t.csv"), "csv").columns == ["a", "b", "c", "d"]


def test_coercion_keeps_seventeen_digits(spark):
    df = spark.createDataFrame([("9007199254740993",), ("3.9",), ("x",), (None,), ("1e30",)], "v string")
    assert [r[0] for r in schema.coerce_to_int(df, ["v"]).collect()] == [9007199254740993, 3, 0, 0, 0]


@pytest.mark.parametrize("df,value", [(1, 12.706205), (30, 2.042272), (1e6, 1.959966), (1e10, 1.959964),
                                      (1e13, 1.959964)])
def test_t_quantile(df, value):
    assert stats.t_ppf(0.975, df) == pytest.approx(value, abs=2e-6)
    assert stats.t_two_sided_p(value, df) == pytest.approx(0.05, abs=2e-6)


def test_density_reaches_every_point(spark):
    x = np.concatenate([np.random.default_rng(0).normal(size=300), [400.0]])
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    got = {r["point"]: r for r in distribution.density_curve(df, ["v"]).collect()}
    bw = x.std(ddof=1) * len(x) ** -0.2
    for p in (0, 50, 120, 199):
        want = np.exp(-0.5 * ((got[p]["x"] - x) / bw) ** 2).sum() / (len(x) * bw * math.sqrt(2 * math.pi))
        assert got[p]["density"] == pytest.approx(want, rel=1e-9, abs=1e-300)


def test_one_hot_vectors_equal_the_columns(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c"), (5, "b")], "k int, g string")
    out = clean.one_hot_vectors(df, ["g"]).transform(df)
    assert out.columns == ["k", "g", "g_vector"]
    wide = {r["k"]: [r["g_b"], r["g_c"]] for r in clean.apply_one_hot(df, clean.fit_one_hot(df, ["g"])).collect()}
    assert {r["k"]: r["g_vector"].toArray().tolist() for r in out.collect()} == wide
    unseen = clean.one_hot_vectors(df, ["g"]).transform(spark.createDataFrame([(9, "zz")], "k int, g string"))
    assert unseen.first()["g_vector"].toArray().tolist() == [0, 0]


def test_display_rounding_is_half_even(spark):
    from tabsieve.functions.columns import display_round

    df = spark.createDataFrame([(0.125, "x"), (0.375, "y")], "v double, s string")
    assert [r["v"] for r in display_round(df, 2).collect()] == [0.12, 0.38]
