"""Classification metrics as DataFrame aggregations.

Everything reads a scored table ``(label, prediction, probability)`` and
optional grouping columns (run, split, model), so metrics are computed for
many runs in one job and can be tested without training anything.  Ranking
metrics (ROC AUC, average precision, curves) use the distributed running
sums over distinct scores instead of a window over the whole table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ranks import running_sums, same_group
from ..session import ensure_checkpoint_dir

LABEL, PRED, PROB = "label", "prediction", "probability"
# Fixed value: probabilities are clipped to [EPS, 1 - EPS] for the log loss
# (double machine epsilon).
EPS = 2.220446049250313e-16
METRIC_NAMES = ("accuracy", "precision", "recall", "f1_score", "roc_auc", "average_precision",
                "brier_score", "log_loss")


def _div0(a: Column, b: Column) -> Column:
    """a / b with 0 when b is 0 (``zero_division=0``)."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def scored_from_model(model, df: DataFrame, label: str, keep: Sequence[str] = ()) -> DataFrame:
    """M1: run a fitted Spark ML model and keep ``(keep..., label,
    prediction, probability of class 1)``."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df)
    return out.select(*keep, F.col(label).cast("int").alias(LABEL), F.col("prediction").cast("int").alias(PRED),
                      vector_to_array("probability")[1].alias(PROB))


CNT = "_n"


def compact(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per (group, probability, label, prediction) with its row
    count: every metric below is a function of this table, which is at most
    4 x (distinct scores) rows per group, so the scored rows are read once
    (map-side combine) whatever the number of metrics."""
    return scored.groupBy(*by, PROB, LABEL, PRED).agg(F.count(F.lit(1)).alias(CNT))


def _is_compact(df: DataFrame) -> bool:
    return CNT in df.columns


def _c(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return df if _is_compact(df) else compact(df, by)


def confusion_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tn, fp, fn, tp, n, Brier score and log loss per group in one aggregate,
    straight from the scored rows (or from their compact table)."""
    c = scored
    y, p, n = F.col(LABEL), F.col(PRED), F.col(CNT) if _is_compact(scored) else F.lit(1)
    pc = F.least(F.greatest(F.col(PROB), F.lit(EPS)), F.lit(1 - EPS))
    return c.groupBy(*by).agg(
        F.sum(F.when((y == 0) & (p == 0), n).otherwise(0)).alias("tn"),
        F.sum(F.when((y == 0) & (p == 1), n).otherwise(0)).alias("fp"),
        F.sum(F.when((y == 1) & (p == 0), n).otherwise(0)).alias("fn"),
        F.sum(F.when((y == 1) & (p == 1), n).otherwise(0)).alias("tp"),
        F.sum(n).alias("n"),
        F.try_divide(F.sum(n * (F.col(PROB) - y) ** 2), F.sum(n)).alias("brier_score"),
        F.try_divide(F.sum(n * (-(y * F.log(pc)) - (1 - y) * F.log(1 - pc))), F.sum(n)).alias("log_loss"))


def threshold_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Accuracy, precision, recall, f1 (0 when undefined),
    Brier score and log loss per group."""
    c = confusion_counts(scored, by)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    return c.select(*by, F.try_divide(tp + tn, F.col("n")).alias("accuracy"), _div0(tp, tp + fp).alias("precision"),
                    _div0(tp, tp + fn).alias("recall"), _div0(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
                    "brier_score", "log_loss")


def _per_score(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """(group, probability, cnt, pos): rows and positives per distinct score."""
    c = _c(scored, by)
    return (c.where(F.col(PROB).isNotNull()).groupBy(*by, PROB)
            .agg(F.sum(CNT).alias("cnt"), F.sum(F.when(F.col(LABEL) == 1, F.col(CNT)).otherwise(0)).alias("pos")))


def _auc(c: DataFrame, by: Sequence[str]) -> DataFrame:
    """ROC AUC with ties from cumulative counts: each positive beats the
    negatives below its score and half of those at it."""
    npos, nneg = F.col("_P"), F.col("_N") - F.col("_P")
    at = F.col("cnt") - F.col("pos")
    below = nneg - (F.col("_k") - F.col("tp"))
    won = F.sum(F.col("pos") * (below + at / 2.0))
    return c.groupBy(*by).agg(F.try_divide(won, F.max(npos).cast("double") * F.max(nneg)).alias("roc_auc"))


def _ap(c: DataFrame, by: Sequence[str]) -> DataFrame:
    term = F.try_divide(F.col("pos"), F.col("_P")) * (F.col("tp") / F.col("_k"))
    return c.groupBy(*by).agg(F.when(F.max("_P") > 0, F.sum(term)).alias("average_precision"))


def roc_auc(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M7: exact ROC AUC with ties; NULL for a group of one class."""
    return _auc(_descending_counts(scored, by), by)


def _descending_counts(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    """One row per (group, distinct score) with counts of rows and positives
    at or above the score (cumulative from the top)."""
    g = list(by)
    per = _per_score(scored, by)
    cum = running_sums(per, g, [PROB], ["cnt", "pos"], descending=True)
    return cum.select(*g, PROB, "cnt", "pos",
                      (F.col("cnt_before") + F.col("cnt")).alias("_k"),
                      (F.col("pos_before") + F.col("pos")).alias("tp"),
                      F.col("pos_total").alias("_P"), F.col("cnt_total").alias("_N"))


def average_precision(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """M8: step-wise ``sum (R_n - R_{n-1}) P_n`` over distinct thresholds
    (not the trapezoid of ``areaUnderPR``); NULL for a group without
    positives."""
    return _ap(_descending_counts(scored, by), by)


def evaluate(scored: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """M2: the requested metrics per group, wide; unknown names are skipped.
    Without a ranking metric the scored rows are aggregated directly; with one
    they are compacted once and frozen, and every metric reads that table."""
    want = [m for m in metrics if m in METRIC_NAMES]
    ranked = [m for m in ("roc_auc", "average_precision") if m in want]
    if not ranked:
        return threshold_metrics(scored, by).select(*by, *want)
    c = scored
    if not _is_compact(scored):
        ensure_checkpoint_dir(scored.sparkSession)
        c = compact(scored, by).checkpoint(eager=True)
    out = threshold_metrics(c, by)
    # one ranking serves both metrics
    cumulative = _descending_counts(c, by)
    if len(ranked) == 2:
        cumulative = cumulative.checkpoint(eager=True)
    for name in ranked:
        part = {"roc_auc": _auc, "average_precision": _ap}[name](cumulative, by)
        if by:
            right, on = same_group(out, part, by, "_by_")
            out = out.join(right, on, "left").drop(*[f"_by_{b}" for b in by])
        else:
            out = _join1(out, part)
    return out.select(*by, *want)


def _join1(a: DataFrame, b: DataFrame) -> DataFrame:
    """Attach the single value of the one-row, one-column ``b`` to ``a``."""
    col = b.columns[0]
    return a.withColumn(col, b.scalar())


def metrics_long(scored: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """M2 long form ``(by..., metric, value)`` used by gates and run logs."""
    wide = evaluate(scored, by, metrics)
    names = [m for m in metrics if m in METRIC_NAMES]
    return wide.unpivot(list(by), names, "metric", "value")


def confusion_matrix(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """All four cells ``(label, prediction, count, share)``; share is the
    row-normalised value (count / label total)."""
    c = confusion_counts(scored, by)
    cells = F.array(*[F.struct(F.lit(lab).alias(LABEL), F.lit(pr).alias(PRED), F.col(nm).alias("count"),
                               F.col(tot).alias("_row"))
                      for lab, pr, nm, tot in ((0, 0, "tn", "_neg"), (0, 1, "fp", "_neg"),
                                               (1, 0, "fn", "_pos"), (1, 1, "tp", "_pos"))])
    c = c.withColumn("_neg", F.col("tn") + F.col("fp")).withColumn("_pos", F.col("fn") + F.col("tp"))
    out = c.select(*by, F.explode(cells).alias("_c")).select(*by, "_c.*")
    return out.select(*by, LABEL, PRED, "count", _div0(F.col("count"), F.col("_row")).alias("share"))


def classification_report(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Precision, recall, f1, support per class, accuracy, macro and
    weighted averages as rows ``(class_label, precision, recall, f1_score,
    support)``."""
    c = confusion_counts(scored, by)
    tp, fp, fn, tn, n = (F.col(x) for x in ("tp", "fp", "fn", "tn", "n"))
    p1, r1 = _div0(tp, tp + fp), _div0(tp, tp + fn)
    p0, r0 = _div0(tn, tn + fn), _div0(tn, tn + fp)
    f1 = _div0(2 * p1 * r1, p1 + r1)
    f0 = _div0(2 * p0 * r0, p0 + r0)
    s1, s0 = tp + fn, tn + fp

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class_label"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.cast("bigint").alias("support"))
    rows = F.array(
        row("0", p0, r0, f0, s0), row("1", p1, r1, f1, s1),
        row("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), F.try_divide(tp + tn, n), n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", F.try_divide(p0 * s0 + p1 * s1, n), F.try_divide(r0 * s0 + r1 * s1, n),
            F.try_divide(f0 * s0 + f1 * s1, n), n))
    return c.select(*by, F.explode(rows).alias("_r")).select(*by, "_r.*")


def roc_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(threshold, fpr, tpr)`` for every distinct score, from high to
    low (no intermediate point dropped)."""
    c = _descending_counts(scored, by)
    fp = F.col("_k") - F.col("tp")
    return c.select(*by, F.col(PROB).alias("threshold"),
                    _div0(fp, F.col("_N") - F.col("_P")).alias("fpr"), _div0(F.col("tp"), F.col("_P")).alias("tpr"))


def pr_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """``(threshold, precision, recall)`` for every distinct score."""
    c = _descending_counts(scored, by)
    return c.select(*by, F.col(PROB).alias("threshold"), (F.col("tp") / F.col("_k")).alias("precision"),
                    _div0(F.col("tp"), F.col("_P")).alias("recall"))


def compare_train_val(metrics: DataFrame, metric: str, by: Sequence[str] = (), split_col: str = "split",
                      train: str = "train", val: str = "val", good_gap: float = 0.10) -> DataFrame:
    """Train score, validation score, gap, gap percent of train and
    status (``good`` when |gap| <= 0.10, else ``poor``) and a note
    (overfitting above 0.10, unusual below -0.05)."""
    m = metrics.where(F.col("metric") == metric)
    piv = m.groupBy(*by).agg(F.max(F.when(F.col(split_col) == train, F.col("value"))).alias("train_score"),
                             F.max(F.when(F.col(split_col) == val, F.col("value"))).alias("val_score"))
    gap = F.coalesce(F.col("train_score"), F.lit(0.0)) - F.coalesce(F.col("val_score"), F.lit(0.0))
    return piv.select(*by, F.lit(metric).alias("metric"), "train_score", "val_score", gap.alias("gap"),
                      F.when(F.col("train_score") > 0, gap / F.col("train_score") * 100).otherwise(0.0)
                      .alias("gap_percentage"),
                      F.when(F.abs(gap) <= good_gap, "good").otherwise("poor").alias("generalization_status"),
                      F.when(gap > good_gap, "overfitting").when(gap < -0.05, "unusual")
                      .otherwise("acceptable").alias("note"))


def model_plot_data(scored: DataFrame, by: Sequence[str] = (), importance: DataFrame | None = None) -> DataFrame:
    """The data behind the confusion-matrix, ROC, precision-recall and
    importance charts as one long table ``(by..., chart, x, y, threshold,
    count, feature)``.  The scored rows are compacted once for all charts."""
    if not _is_compact(scored):
        ensure_checkpoint_dir(scored.sparkSession)
        scored = compact(scored, by).checkpoint(eager=True)
    cm = confusion_matrix(scored, by).select(
        *by, F.lit("confusion").alias("chart"), F.col(LABEL).cast("double").alias("x"),
        F.col(PRED).cast("double").alias("y"), F.lit(None).cast("double").alias("threshold"),
        F.col("count").cast("bigint").alias("count"), F.lit(None).cast("string").alias("feature"))
    roc = roc_curve(scored, by).select(
        *by, F.lit("roc").alias("chart"), F.col("fpr").alias("x"), F.col("tpr").alias("y"), "threshold",
        F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("string").alias("feature"))
    pr = pr_curve(scored, by).select(
        *by, F.lit("pr").alias("chart"), F.col("recall").alias("x"), F.col("precision").alias("y"), "threshold",
        F.lit(None).cast("bigint").alias("count"), F.lit(None).cast("string").alias("feature"))
    out = cm.unionByName(roc).unionByName(pr)
    if importance is not None:
        imp = importance.where(F.col("rank") <= 20).select(
            *[F.lit(None).cast("string").alias(b) for b in by], F.lit("importance").alias("chart"),
            F.col("rank").cast("double").alias("x"), F.col("importance").alias("y"),
            F.lit(None).cast("double").alias("threshold"), F.lit(None).cast("bigint").alias("count"), "feature")
        out = out.unionByName(imp)
    return out
