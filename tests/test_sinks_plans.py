import pytest
from pyspark.sql import functions as F

from tabsieve.operators import gates, schema, train
from tabsieve.plans import eda, preprocess, training
from tabsieve.plans.views import table
from tabsieve.sources import io


def test_csv_scan_null_tokens_and_errors(spark, tmp_path):
    p = tmp_path / "raw.csv"
    p.write_text("id,bmi,g\n1,N/A,a\n2,21.5,NA\n3,,b\n4,30,b\n")
    df = io.read_csv(spark, str(p))
    assert dict(df.dtypes) == {"id": "bigint", "bmi": "double", "g": "string"}
    assert [r["bmi"] for r in df.orderBy("id").collect()] == [None, 21.5, None, 30.0]
    empty = tmp_path / "empty.csv"
    empty.write_text("id,bmi\n")
    with pytest.raises(ValueError):
        io.read_csv(spark, str(empty))
    with pytest.raises(Exception):
        io.read_csv(spark, str(tmp_path / "missing.csv"))


def test_json_report_roundtrip(spark, tmp_path):
    rec = {"n_rows": 3, "nested": {"a": [1, 2]}}
    io.write_json_report(spark, rec, str(tmp_path / "r"))
    assert io.read_json_report(spark, str(tmp_path / "r")) == rec


def test_eda_plan_writes_everything(spark, sf001, tmp_path):
    df = table(spark, sf001, "customer_dirty")
    rep = eda.run(spark, df, str(tmp_path / "eda"), id_column="c_custkey")
    assert rep["n_rows"] == df.count() and rep["n_columns"] == 5
    for name in ("numeric_summary", "categorical_summary", "missing_values", "outlier_summary", "report"):
        assert (tmp_path / "eda" / name).exists()
    back = spark.read.option("header", True).csv(str(tmp_path / "eda" / "missing_values"))
    assert back.count() == 4


def test_feature_target_checks(spark):
    df = spark.createDataFrame([(1, 2.0, 0)], "id int, x double, y int")
    feats, tgt = schema.feature_target(df, "y", drop=["id"])
    assert feats == ["x"] and tgt == "y"
    with pytest.raises(KeyError):
        schema.feature_target(df, "zz")
    with pytest.raises(ValueError):
        schema.check_same_features(["a", "b"], ["a"])


def test_run_log_stage_and_training_plan(spark, sf001, tmp_path):
    cfg = preprocess.PreprocessConfig(key="doc_id", target="quality", test_size=60, dev_size=60,
                                      outlier_cols=("n_chars",), log1p_cols=("n_chars",), drop_cols=("toxic",))
    splits, _ = preprocess.fit_transform(table(spark, sf001, "doc_features"), cfg, keep_key=True)
    feats = [c for c in splits["train"].columns if c not in ("doc_id", "quality")]
    out = str(tmp_path / "runs")
    res = training.run(splits["train"], splits["dev"], feats, "quality", "doc_id", out,
                       models=["logistic_regression", "random_forest"], tune_top_n=1, n_trials=1, cv_folds=3)
    assert res["model_name"] in ("logistic_regression", "random_forest")
    rm = spark.read.parquet(f"{out}/run_metrics")
    assert rm.select("run_id").distinct().count() == 3          # two baselines and one tuned run
    assert rm.where(F.col("metric") == "training_time").count() == 3
    for split, metric in (("cv", "f1_score_mean"), ("cv", "f1_score_fold_2"), ("gap", "f1_score"), ("train", "n_rows"),
                          ("val", "n_class_1")):
        assert rm.where((F.col("split") == split) & (F.col("metric") == metric)).count() == 3, metric
    assert rm.where(F.col("metric") == "native:n_chars").count() >= 1
    # the twenty first features of each run, whichever they are
    ranked = rm.where(F.col("metric").startswith("permutation:")).groupBy("run_id").count().collect()
    assert [r["count"] for r in ranked] == [20, 20, 20]
    assert spark.read.parquet(f"{out}/run_params").count() > 0
    m = io.load_model(spark, f"{out}/best_model")
    assert train.score(m, splits["test"], "quality").count() == 60
    feats_back = [r["feature"] for r in spark.read.parquet(f"{out}/best_model/features").orderBy("position").collect()]
    assert feats_back == feats


def test_promote_and_stage_append(spark, tmp_path):
    v = spark.createDataFrame([("r1", True, 0), ("r2", False, 2)], "run_id string, overall_passed boolean, "
                                                                      "failed_checks bigint")
    rows = gates.promote(v, "run_id")
    io.append_stage(rows, str(tmp_path))
    io.append_stage(rows, str(tmp_path))
    st = spark.read.parquet(str(tmp_path / "run_stages"))
    assert [r["run_id"] for r in st.collect()] == ["r1", "r1"] and st.first()["stage"] == "Staging"


def test_compare_with_production_without_production(spark):
    scores = spark.createDataFrame([("a", 0.8)], "run string, value double")
    stages = spark.createDataFrame([("a", "Staging")], "run string, stage string")
    r = gates.compare_with_production(scores, stages, "run").first()
    assert r["should_replace"] and r["reason"] == "no_production_model"


def test_failed_learner_leaves_a_record(spark):
    df = spark.createDataFrame([(i, float(i % 7), i % 2) for i in range(40)], "k bigint, x double, y int")
    runs = train.train_baselines(["logistic_regression", "nonsense"], df, df, ["x"], "y", "k", cv_folds=0,
                                 importance=False)
    status = {r["model_name"]: r for r in train.run_status(runs).collect()}
    assert status["logistic_regression"]["status"] == "ok" and "nonsense" in status["nonsense"]["error"]
    assert train.leaderboard_of(runs).count() == 1


def test_run_written_twice_counts_once(spark, tmp_path):
    root = str(tmp_path / "log")
    metrics = spark.createDataFrame([("val", "f1_score", 0.5), ("val", "recall", 0.25)], "split string, metric string, value double")
    for run, times in (("aa11", 2), ("1234567", 1)):
        for _ in range(times):
            io.log_run(spark, root, run, {"model_name": "x", "n": 3}, metrics)
    io.log_run(spark, root, "failed", {"error": "y"}, None)
    # a writer that stopped before the manifest
    metrics.selectExpr("'half' AS run_id", "*").write.parquet(io._run_folder(root, "run_metrics", "half"))
    params, got = io.read_runs(spark, root)
    assert params.columns == ["run_id", "key", "value"] and got.columns == ["run_id", "split", "metric", "value"]
    assert sorted((r["run_id"], r["key"]) for r in params.collect()) == [
        ("1234567", "model_name"), ("1234567", "n"), ("aa11", "model_name"), ("aa11", "n"), ("failed", "error")]
    assert sorted((r["run_id"], r["metric"]) for r in got.collect()) == [
        ("1234567", "f1_score"), ("1234567", "recall"), ("aa11", "f1_score"), ("aa11", "recall")]


def test_depth_has_no_limit(spark):
    df = spark.createDataFrame([(i, float(i), i % 2) for i in range(80)], "k bigint, x double, y int")
    m = train.fit_model("random_forest", df, ["x"], "y", {"n_estimators": 5, "max_depth": 79, "max_features": None}, key="k")
    assert train.score(m, df, "y").where("label = prediction").count() > 60


def test_production_comparison_outcomes(spark):
    from tabsieve.operators import gates

    scores = spark.createDataFrame([("a", 0.8), ("b", 0.5)], "run string, value double")
    stages = spark.createDataFrame([("gone", "Production")], "run string, stage string")
    reasons = lambda df: {(r["should_replace"], r["reason"]) for r in df.collect()}
    assert reasons(gates.compare_with_production(scores, stages, "run", enabled=False)) == {(True, "comparison_disabled")}
    assert reasons(gates.compare_with_production(scores, None, "run")) == {(False, "comparison_failed")}
    assert reasons(gates.compare_with_production(scores, stages, "run")) == {(False, "comparison_failed")}
    assert reasons(gates.compare_with_production(scores, stages.limit(0), "run")) == {(True, "no_production_model")}
