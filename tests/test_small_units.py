import random

import pytest
from pyspark.sql import functions as F

from tabsieve.operators import clean, gates, stat_tests, train
from tabsieve.plans import preprocess
from tabsieve.plans.views import table


def test_suggest_is_seeded_and_in_bounds():
    space = train.SPACES["xgboost"]
    a = [train.suggest(space, random.Random(1)) for _ in range(3)]
    b = [train.suggest(space, random.Random(1)) for _ in range(3)]
    assert a == b
    for p in (train.suggest(space, random.Random(s)) for s in range(50)):
        assert 50 <= p["n_estimators"] <= 500 and 0.001 <= p["learning_rate"] <= 0.3
        assert 0.6 <= p["subsample"] <= 1.0


def test_select_best_prefers_baseline_on_tie(spark):
    base = spark.createDataFrame([(0, "lr", 0.8), (1, "rf", 0.7)], "seq int, model string, f1 double")
    tuned = spark.createDataFrame([(2, "lr_t", 0.8)], "seq int, model string, f1 double")
    best = gates.select_best(base, tuned, "f1").first()
    assert best["model"] == "lr" and best["is_tuned"] is False
    top = [r["model"] for r in gates.top_k(base.unionByName(tuned), "f1", 2).collect()]
    assert top == ["lr", "lr_t"]


def test_performance_gate_statuses(spark):
    m = spark.createDataFrame([("f1_score", 0.6), ("f1_score", 0.72), ("f1_score", 0.8), ("f1_score", 0.9),
                               ("unknown", 0.1)], "metric string, value double")
    st = [r["status"] for r in gates.performance_gate(m, gates.thresholds_table(spark)).orderBy("value").collect()]
    assert st == ["FAIL", "WARNING", "PASS", "EXCELLENT"]


def test_switches(spark, sf001):
    df = table(spark, sf001, "customer_dirty")
    assert clean.drop_duplicate_rows(df, enabled=False) is df
    assert clean.flag_outliers(df, {"c_acctbal": (0.0, 1.0)}, enabled=False) is df
    cfg = preprocess.PreprocessConfig(key="c_custkey", target="c_nationkey", test_size=10, dev_size=10,
                                      impute=False, encode=False, outliers_enabled=False)
    base = df.where(F.col("c_nationkey").isNotNull())
    splits, params = preprocess.fit_transform(base, cfg)
    assert "impute_numeric" not in params and "one_hot" not in params and "outlier_bounds" not in params
    assert splits["test"].count() == 10 and splits["dev"].count() == 10


def test_dedup_ignoring_id_keeps_smallest(spark):
    df = spark.createDataFrame([(3, "a"), (1, "a"), (2, "b")], "id int, v string")
    out = sorted(tuple(r) for r in clean.drop_duplicate_rows(df, ignore=["id"]).collect())
    assert out == [(1, "a"), (2, "b")]


def test_normality_ks_and_jb_on_normal_data(spark):
    rng = random.Random(3)
    df = spark.createDataFrame([(rng.gauss(0, 1),) for _ in range(4000)], "x double")
    ks = stat_tests.normality_ks(df, "x")
    assert ks["normal"] and 0 <= ks["statistic"] < 0.05
    jb = stat_tests.normality_jb(df, ["x"]).first()
    assert jb["normal"]


def test_insufficient_group(spark):
    df = spark.createDataFrame([(1.0, "a"), (2.0, "a"), (3.0, "b"), (4.0, "b"), (5.0, "b")], "x double, g string")
    r = stat_tests.compare_two_groups(df, ["x"], "g", "a", "b").first()
    assert r["test_type"] == "insufficient data"
