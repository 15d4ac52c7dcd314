"""Training plan: baselines -> leaderboard -> tune top N -> select best ->
gates -> save and register (L11-L13, G3, G8, G9, S8, S9)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import gates as gt
from ..operators import metrics as mt
from ..operators import train as tr
from ..sources import io


def validate_run(run: tr.RunResult, val: DataFrame, label: str, primary: str = "f1_score") -> DataFrame:
    """G4-G6, G8 for one run: ``(run_id, overall_passed, failed_checks)``."""
    spark = val.sparkSession
    long = run.metrics.withColumn("run_id", F.lit(run.run_id))
    val_m = long.where(F.col("split") == "val").select("run_id", "metric", "value")
    perf = gt.performance_gate(val_m, gt.thresholds_table(spark), ["run_id"])
    gaps = mt.compare_train_val(long, primary, ["run_id"], train="train", val="val")
    over = gt.overfitting_gate(gaps, ["run_id"])
    cc = mt.confusion_counts(tr.score(run.model, val, label)).withColumn("run_id", F.lit(run.run_id))
    rules = gt.business_rules_gate(cc, ["run_id"])
    return gt.overall_verdict(perf, over, rules, ["run_id"])


def run(train: DataFrame, val: DataFrame, features: Sequence[str], label: str, key: str, out_dir: str,
        models: Sequence[str] = tuple(tr.PRESETS), tune_top_n: int = 3, n_trials: int = 50,
        timeout_s: float = 3600.0, primary: str = "f1_score", cv_folds: int = 10) -> dict:
    """Whole plan; writes the run log, the best model and the stage row."""
    spark = train.sparkSession
    train, val = train.persist(), val.persist()
    baselines = tr.train_baselines(models, train, val, features, label, key, cv_folds=cv_folds)
    tuned = tr.tune_top(baselines, train, val, features, label, key, tune_top_n, n_trials, timeout_s,
                        metric=primary, cv_folds=cv_folds) if tune_top_n else []
    runs = baselines + tuned
    for r in runs:
        if r.error is not None:
            io.log_run(spark, out_dir, r.run_id, {"model_name": r.model_name, "status": "failed", "error": r.error}, None)
            continue
        io.log_run(spark, out_dir, r.run_id, {"model_name": r.model_name, "is_tuned": r.is_tuned, "status": "ok",
                                              **r.params}, tr.run_record(r))
    base_board = tr.leaderboard_of(baselines, primary).withColumn("is_tuned", F.lit(False))
    best_row = (gt.select_best(base_board.drop("is_tuned"), tr.leaderboard_of(tuned, primary).drop("is_tuned"),
                               primary, "seq") if tuned else base_board.limit(1)).first()
    best = next(r for r in runs if r.run_id == best_row["run_id"])
    verdict = validate_run(best, val, label, primary)
    io.save_model(best.model, f"{out_dir}/best_model", features, best.metrics)
    io.append_stage(gt.promote(verdict, "run_id"), out_dir)
    out = {"best_run": best.run_id, "model_name": best.model_name,
           "passed": bool(verdict.first()["overall_passed"])}
    train.unpersist()
    val.unpersist()
    return out
