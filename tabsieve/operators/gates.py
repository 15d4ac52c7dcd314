"""Ranking, selection and acceptance gates.

Inputs are the long metrics table ``(run keys..., split, metric, value)``
written by training runs (one row per run, split and metric: it grows with
the number of runs, not with the data) and small threshold tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Metric thresholds, gap limits, rule limits and the improvement
# needed to replace the production run.
THRESHOLDS = {"f1_score": (0.70, 0.75, 0.85), "roc_auc": (0.75, 0.80, 0.90)}
GAP_MAX, GAP_WARNING = 0.15, 0.10
MIN_RECALL, MAX_FPR = 0.80, 0.30
MIN_IMPROVEMENT = 0.01


def thresholds_table(spark: SparkSession, thresholds: dict = THRESHOLDS) -> DataFrame:
    rows = [(m, float(a), float(b), float(c)) for m, (a, b, c) in thresholds.items()]
    return spark.createDataFrame(rows, "metric string, min double, warning double, target double")


def leaderboard(results: DataFrame, metric: str, order_col: str = "seq") -> DataFrame:
    """G1: results sorted by ``metric`` descending; ties keep ``order_col``
    order (stable sort).  ``rank`` is 1-based.  A results table has one row
    per run."""
    return results.orderBy(F.col(metric).desc_nulls_last(), F.col(order_col).asc())


def top_k(results: DataFrame, metric: str, k: int, order_col: str = "seq") -> DataFrame:
    """The first ``k`` rows of :func:`leaderboard` (a top-k report)."""
    return leaderboard(results, metric, order_col).limit(k)


def select_best(baseline: DataFrame, tuned: DataFrame, metric: str, order_col: str = "seq") -> DataFrame:
    """Union of baseline and tuned results, best by ``metric``; on a tie
    the baseline row wins, then the earlier ``order_col``."""
    both = (baseline.withColumn("is_tuned", F.lit(False))
            .unionByName(tuned.withColumn("is_tuned", F.lit(True)), allowMissingColumns=True))
    return both.orderBy(F.col(metric).desc_nulls_last(), F.col("is_tuned").asc(), F.col(order_col).asc()).limit(1)


def performance_gate(metrics: DataFrame, thresholds: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``FAIL`` below min, ``WARNING`` below warning, ``EXCELLENT`` at or
    above target, else ``PASS``; metrics without a threshold are skipped.
    The threshold table has one row per metric (broadcast)."""
    j = metrics.join(F.broadcast(thresholds), "metric")
    v = F.col("value")
    status = (F.when(v < F.col("min"), "FAIL").when(v < F.col("warning"), "WARNING")
              .when(v >= F.col("target"), "EXCELLENT").otherwise("PASS"))
    return j.select(*by, "metric", "value", "min", "warning", "target", status.alias("status"),
                    (v >= F.col("min")).alias("passed"))


def overfitting_gate(gaps: DataFrame, by: Sequence[str] = (), max_gap: float = GAP_MAX,
                     warning_gap: float = GAP_WARNING) -> DataFrame:
    """From :func:`metrics.compare_train_val` rows: gap above ``max_gap``
    fails, above ``warning_gap`` warns."""
    g = F.col("gap")
    return gaps.select(*by, "metric", "gap", "gap_percentage", F.lit(max_gap).alias("max_allowed"),
                       (g <= max_gap).alias("passed"),
                       F.when(g > max_gap, "FAIL").when(g > warning_gap, "WARNING").otherwise("PASS").alias("status"))


def business_rules_gate(confusion: DataFrame, by: Sequence[str] = (), min_recall: float = MIN_RECALL,
                        max_fpr: float = MAX_FPR) -> DataFrame:
    """Positive-class recall at least ``min_recall`` and false-positive
    rate at most ``max_fpr``, from confusion counts ``(tn, fp, fn, tp)``;
    one row per rule."""
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    recall = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    fpr = F.when(fp + tn > 0, fp / (fp + tn)).otherwise(F.lit(0.0))
    rules = F.array(
        F.struct(F.lit("recall").alias("rule"), recall.alias("value"), F.lit(min_recall).alias("limit"),
                 (recall >= min_recall).alias("passed")),
        F.struct(F.lit("false_positive_rate").alias("rule"), fpr.alias("value"), F.lit(max_fpr).alias("limit"),
                 (fpr <= max_fpr).alias("passed")))
    out = confusion.select(*by, F.explode(rules).alias("_r")).select(*by, "_r.*")
    return out.withColumn("status", F.when(F.col("passed"), "PASS").otherwise("FAIL"))


def compare_with_production(scores: DataFrame, stages: DataFrame | None, run_col: str, metric_col: str = "value",
                            min_improvement: float = MIN_IMPROVEMENT, enabled: bool = True) -> DataFrame:
    """Every run against the run tagged ``Production`` in ``stages``
    ``(run, stage)``: improvement, percent, should_replace (improvement >=
    ``min_improvement``) and reason; no production run -> replace.  The
    production score is a scalar subquery (one row).  ``enabled=False``: replace,
    ``comparison_disabled``.  No stage table, or a production run without a
    score: keep, ``comparison_failed``."""
    none = F.lit(None).cast("double")

    def fixed(replace: bool, reason: str) -> DataFrame:
        return scores.select(run_col, F.col(metric_col).alias("new_model_score"), none.alias("production_score"),
                             none.alias("improvement"), none.alias("improvement_percentage"),
                             F.lit(replace).alias("should_replace"), F.lit(reason).alias("reason"))
    if not enabled:
        return fixed(True, "comparison_disabled")
    if stages is None:
        return fixed(False, "comparison_failed")
    production = stages.where(F.col("stage") == "Production").select(run_col)
    prod_score = production.join(scores, run_col).agg(F.max(metric_col)).scalar()
    tagged = production.agg(F.count(F.lit(1))).scalar()
    imp = F.col(metric_col) - prod_score
    lost = (tagged > 0) & prod_score.isNull()
    return scores.select(
        run_col, F.col(metric_col).alias("new_model_score"), prod_score.alias("production_score"),
        imp.alias("improvement"),
        F.when(prod_score > 0, imp / prod_score * 100).otherwise(F.lit(0.0)).alias("improvement_percentage"),
        F.when(lost, False).when(prod_score.isNull(), True).otherwise(imp >= min_improvement).alias("should_replace"),
        F.when(lost, "comparison_failed").when(prod_score.isNull(), "no_production_model")
        .when(imp >= min_improvement, "better_performance").otherwise("insufficient_improvement").alias("reason"))


def overall_verdict(perf: DataFrame, overfit: DataFrame, rules: DataFrame, by: Sequence[str]) -> DataFrame:
    """A run passes when every performance, overfitting and rule check
    passes (the production comparison is only reported)."""
    parts = [perf.select(*by, F.lit("performance").alias("check"), "passed"),
             overfit.select(*by, F.lit("overfitting").alias("check"), "passed"),
             rules.select(*by, F.lit("business_rules").alias("check"), "passed")]
    u = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return u.groupBy(*by).agg(F.bool_and("passed").alias("overall_passed"),
                              F.count_if(~F.col("passed")).alias("failed_checks"))


def promote(verdict: DataFrame, run_col: str, stage: str = "Staging") -> DataFrame:
    """Stage rows ``(run, stage, ts)`` for runs that passed, to append to
    the stage table."""
    return verdict.where(F.col("overall_passed")).select(run_col, F.lit(stage).alias("stage"),
                                                         F.current_timestamp().alias("ts"))
