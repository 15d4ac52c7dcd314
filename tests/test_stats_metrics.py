import math

import pytest
from pyspark.sql import functions as F

from tabsieve.functions import stats
from tabsieve.operators import metrics, stat_tests
from tabsieve.plans.views import table


def _scored(spark):
    rows = [(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8), (0, 0.4)]
    return spark.createDataFrame([(y, int(p >= 0.5), p) for y, p in rows], "label int, prediction int, probability double")


def test_auc_and_average_precision_fixture(spark):
    s = _scored(spark)
    assert metrics.roc_auc(s).first()["roc_auc"] == pytest.approx(4 / 6)
    assert metrics.average_precision(s).first()["average_precision"] == pytest.approx(0.75)


def test_threshold_metrics_zero_division(spark):
    s = spark.createDataFrame([(0, 0, 0.1), (1, 0, 0.2)], "label int, prediction int, probability double")
    r = metrics.threshold_metrics(s).first()
    assert (r["precision"], r["recall"], r["f1_score"], r["accuracy"]) == (0.0, 0.0, 0.0, 0.5)


def test_confusion_and_report(spark):
    s = _scored(spark)
    cm = {(r["label"], r["prediction"]): r["count"] for r in metrics.confusion_matrix(s).collect()}
    assert cm == {(0, 0): 3, (0, 1): 0, (1, 0): 1, (1, 1): 1}
    rep = {r["class_label"]: r for r in metrics.classification_report(s).collect()}
    assert rep["1"]["recall"] == 0.5 and rep["accuracy"]["f1_score"] == 0.8


def test_chi_square_yates_fixture(spark):
    rows = [("a", 0)] * 10 + [("a", 1)] * 20 + [("b", 0)] * 30 + [("b", 1)] * 15
    df = spark.createDataFrame(rows, "g string, y int")
    plain = stat_tests.chi_square(df, ["g"], "y", correction=False).first()
    yates = stat_tests.chi_square(df, ["g"], "y").first()
    assert plain["chi2"] == pytest.approx(8.0357, abs=1e-4)
    assert yates["chi2"] == pytest.approx(6.752232, abs=1e-6)
    assert yates["dof"] == 1


def test_distribution_functions_against_tables():
    assert stats.t_ppf(0.975, 10) == pytest.approx(2.228139, abs=1e-6)
    assert stats.t_ppf(0.975, 1000) == pytest.approx(1.962339, abs=1e-6)
    assert stats.chi2_sf(3.841459, 1) == pytest.approx(0.05, abs=1e-7)
    assert stats.chi2_sf(9.487729, 4) == pytest.approx(0.05, abs=1e-7)
    assert stats.t_two_sided_p(2.228139, 10) == pytest.approx(0.05, abs=1e-6)
    assert 2 * stats.norm_sf(1.959964) == pytest.approx(0.05, abs=1e-6)


def test_survey_values_on_events(spark, sf001):
    ev = table(spark, sf001, "events_labeled")
    u = stat_tests.mann_whitney(ev, ["value"], "is_purchase", 0, 1).first()
    assert u["u_statistic"] == pytest.approx(8073485.5)
    assert 2 * stats.norm_sf(u["z"]) == pytest.approx(0.256122, abs=1e-6)
    w = stat_tests.welch_t(ev, ["value"], "is_purchase", 1, 0).first()
    assert abs(w["t_statistic"]) == pytest.approx(1.487889, abs=1e-6)
    d = stat_tests.cohens_d(ev, ["value"], "is_purchase", 1, 0).first()
    assert d["cohens_d"] == pytest.approx(0.037012, abs=1e-6)
    jb = stat_tests.normality_jb(table(spark, sf001, "events"), ["value"]).first()
    assert jb["statistic"] == pytest.approx(17997.410788, abs=1e-4)
    cmp = {r["column_name"]: r for r in stat_tests.compare_two_groups(ev, ["value"], "is_purchase", 1, 0).collect()}
    assert cmp["value"]["test_type"] == "mannwhitneyu"
    assert cmp["value"]["p_value"] == pytest.approx(0.256122, abs=1e-6)


def test_chi_square_survey_value(spark, sf001):
    r = stat_tests.chi_square_with_p(table(spark, sf001, "orders_status"), ["o_orderpriority"], "is_filled").first()
    assert r["chi2"] == pytest.approx(1.732673, abs=1e-6) and r["dof"] == 4
    assert 0 < r["p_value"] < 1


def test_confidence_interval(spark):
    df = spark.createDataFrame([(float(v),) for v in range(1, 12)], "x double")
    r = stat_tests.confidence_interval(df, ["x"]).first()
    half = 2.228139 * math.sqrt(11.0) / math.sqrt(11)
    assert r["lower_bound"] == pytest.approx(6 - half, abs=1e-5)


def test_box_stats_survey_values(spark, sf001):
    from tabsieve.operators import distribution
    b = distribution.box_stats(table(spark, sf001, "events"), ["value"]).first()
    assert (b["q1"], b["q3"]) == (pytest.approx(14.56), pytest.approx(69.1475))
    assert (b["whisker_low"], b["whisker_high"]) == (pytest.approx(0.01), pytest.approx(150.89))
    assert b["n_fliers"] == 463


def test_histogram_bins_and_density(spark, sf001):
    from tabsieve.operators import distribution
    ev = table(spark, sf001, "events")
    h = distribution.histogram(ev, ["value"])
    assert h.count() == 97 and h.agg(F.sum("count")).first()[0] == ev.count()
    dens = distribution.density_curve(ev, ["value"]).toPandas().sort_values("x")
    area = (dens["density"].iloc[1:].to_numpy() * dens["x"].diff().iloc[1:].to_numpy()).sum()
    assert area == pytest.approx(1.0, abs=0.01)
