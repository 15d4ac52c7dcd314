import random

import pytest
from pyspark.sql import functions as F

from tabsieve.operators import importance, split, train
from tabsieve.plans import preprocess
from tabsieve.plans.views import table
from tabsieve.sources import io


def test_allocate_largest_remainder():
    q = split.allocate({0: 8000, 1: 2000}, 500)
    assert sum(q.values()) == 500 and q == {0: 400, 1: 100}
    q = split.allocate({"a": 1, "b": 1, "c": 1}, 2)
    assert q == {"a": 1, "b": 1, "c": 0}


def test_stratified_split_sizes_disjoint_deterministic(spark, sf001):
    ev = table(spark, sf001, "events_labeled")
    a = split.stratified_split(ev, "event_id", "is_purchase", 500, 610, "-42")
    counts = {(r["split"], r["is_purchase"]): r["count"]
              for r in a.groupBy("split", "is_purchase").count().collect()}
    assert counts[("test", 0)] + counts[("test", 1)] == 500
    assert counts[("dev", 0)] + counts[("dev", 1)] == 610
    assert (counts[("test", 0)], counts[("test", 1)]) == (401, 99)
    assert (counts[("dev", 0)], counts[("dev", 1)]) == (489, 121)
    assert a.count() == ev.count() and a.select("event_id").distinct().count() == ev.count()
    b = split.stratified_split(ev.repartition(11), "event_id", "is_purchase", 500, 610, "-42")
    key = lambda d: sorted((r["event_id"], r["split"]) for r in d.select("event_id", "split").collect())
    assert key(a) == key(b)


def test_folds_balanced(spark, sf001):
    ev = table(spark, sf001, "events_labeled")
    f = split.stratified_folds(ev, "event_id", "is_purchase", 10)
    per = f.groupBy("is_purchase", "fold").count().groupBy("is_purchase").agg(
        (F.max("count") - F.min("count")).alias("spread"), F.count(F.lit(1)).alias("k")).collect()
    assert all(r["spread"] <= 1 and r["k"] == 10 for r in per)


def test_hash_split_fractions(spark):
    df = spark.range(20000).withColumnRenamed("id", "k")
    s = split.hash_split(df, "k", {"train": 0.8, "test": 0.2})
    share = s.where(F.col("split") == "test").count() / 20000
    assert 0.18 < share < 0.22


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    w = {r["y"]: r["weight"] for r in split.class_weights(df, "y").distinct().collect()}
    assert w == {0: pytest.approx(4 / 6), 1: pytest.approx(2.0)}


def _docs(spark, sf001):
    cfg = preprocess.PreprocessConfig(key="doc_id", target="quality", test_size=60, dev_size=60,
                                      outlier_cols=("n_chars",), log1p_cols=("n_chars",), drop_cols=("toxic",))
    splits, params = preprocess.fit_transform(table(spark, sf001, "doc_features"), cfg, keep_key=True)
    return {k: v.persist() for k, v in splits.items()}, params, cfg


def test_preprocess_fitted_on_train_and_reloadable(spark, sf001, tmp_path):
    splits, params, cfg = _docs(spark, sf001)
    assert set(splits["train"].columns) == set(splits["test"].columns)
    assert "is_outlier" in splits["train"].columns and "n_chars_log" in splits["train"].columns
    assert sum(d.count() for d in splits.values()) == table(spark, sf001, "doc_features").count()
    io.save_params(spark, params, str(tmp_path / "p"))
    back = io.load_params(spark, str(tmp_path / "p"))
    assert back["one_hot"] == params["one_hot"]
    assert back["outlier_bounds"]["n_chars"] == pytest.approx(params["outlier_bounds"]["n_chars"])
    raw = table(spark, sf001, "doc_features")
    a = preprocess.transform(raw, params).orderBy("quality", "n_chars").collect()
    b = preprocess.transform(raw, back).orderBy("quality", "n_chars").collect()
    assert a == b


def test_models_and_scores(spark, sf001):
    splits, _, _ = _docs(spark, sf001)
    feats = [c for c in splits["train"].columns if c not in ("doc_id", "quality")]
    for name in ("logistic_regression", "random_forest"):
        m = train.fit_model(name, splits["train"], feats, "quality")
        s = train.score(m, splits["dev"], "quality", keep=["doc_id"])
        r = s.agg(F.min("probability"), F.max("probability"), F.count(F.lit(1))).first()
        assert 0.0 <= r[0] <= r[1] <= 1.0 and r[2] == 60
    imp = importance.native_importance(m, feats)
    assert imp.agg(F.sum("importance")).first()[0] == pytest.approx(1.0)


def test_cross_validation_and_search(spark, sf001):
    splits, _, _ = _docs(spark, sf001)
    feats = [c for c in splits["train"].columns if c not in ("doc_id", "quality")]
    cv = train.cross_validate("logistic_regression", splits["train"], feats, "quality", "doc_id", k=3)
    assert cv.count() == 3
    summ = train.cv_summary(cv).first()
    assert summ["cv_min"] <= summ["cv_mean"] <= summ["cv_max"]
    trials = train.random_search("logistic_regression", splits["train"], feats, "quality", "doc_id",
                                 n_trials=2, k=2)
    assert trials.count() == 2 and trials.best_params


def test_permutation_importance_shape(spark, sf001):
    splits, _, _ = _docs(spark, sf001)
    feats = ["n_chars", "lang_en", "is_outlier"]
    m = train.fit_model("random_forest", splits["train"], feats, "quality", {"n_estimators": 10})
    p = importance.permutation_importance(m, splits["dev"], feats, "quality", "doc_id", n_repeats=2)
    assert sorted(r["feature"] for r in p.collect()) == sorted(feats)


def test_permutation_is_a_permutation(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 3).alias("x"))
    p = importance.permuted(df, "k", ["x"], seed=5)
    assert sorted(r["x__perm"] for r in p.collect()) == sorted(r["x"] for r in df.collect())
    assert p.where(F.col("x") != F.col("x__perm")).count() > 900


def test_quotas_without_the_driver_equal_allocate(spark):
    rng = random.Random(3)
    for total in (0, 1, 57, 500):
        counts = {None: 7, **{f"c{i}": rng.randint(1, 40) for i in range(60)}}
        df = spark.createDataFrame(list(counts.items()), "c string, n bigint")
        got = {r["c"]: r["q"] for r in split.quota_column(df, "c", "n", total, "q").collect()}
        assert got == split.allocate(counts, total)
    with pytest.raises(ValueError, match="cannot take"):
        split.quota_column(df, "c", "n", 10 ** 6, "q")
    many = spark.range(150_000).selectExpr("id", "id AS cls")
    parts = split.stratified_split(many, "id", "cls", 500, 610).groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in parts} == {"test": 500, "dev": 610, "train": 148_890}


def test_negative_labels_are_an_error(spark):
    from tabsieve.operators import profile
    with pytest.raises(ValueError, match="negative"):
        profile.class_counts(spark.createDataFrame([(1,), (-2,)], "y int"), "y")
