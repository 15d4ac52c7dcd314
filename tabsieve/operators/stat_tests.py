"""Statistical tests (T1-T11), for many columns at once.

The data-dependent part of every test is a grouped aggregate over the long
``(column_name, value, group)`` layout; only per-column scalars (counts,
moments, rank sums) reach the driver, where p-values are evaluated.
Mann-Whitney ranks come from the distributed rank helper, never from a
window over a whole group."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COLUMN, VALUE, categorical_columns, clean_double, to_long
from ..functions.ranks import BEFORE, checked_broadcast, same_group, value_ranks
from ..functions.stats import (EXACT_U, chi2_sf, inverse_normal_sql, mann_whitney_exact_p, norm_sf, shapiro_francia_p, t_ppf,
                               t_two_sided_p)
from ..session import ensure_checkpoint_dir

# Labels for Cohen's d and Cramer's V, by upper limit.
COHEN_LABELS = ((0.2, "negligible"), (0.5, "small"), (0.8, "medium"), (math.inf, "large"))
CRAMER_LABELS = ((0.1, "negligible"), (0.3, "small"), (0.5, "medium"), (math.inf, "high"))
ALPHA = 0.05
MIN_GROUP_ROWS = 3


def _label(x: Column, table) -> Column:
    expr = None
    for limit, name in table:
        cond = x < F.lit(limit) if math.isfinite(limit) else F.lit(True)
        expr = F.when(cond, name) if expr is None else expr.when(cond, name)
    return F.when(x.isNotNull(), expr)


# ----------------------------------------------------------------- T1 normality

def normality_jb(df: DataFrame, cols: Sequence[str], alpha: float = ALPHA) -> DataFrame:
    """T1 (re-aimed to the full data): Jarque-Bera ``JB = n/6 (S^2 + K^2/4)``
    from population skewness S and excess kurtosis K; ``p = exp(-JB/2)``
    (chi-square, 2 df).  One aggregate for all columns."""
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    agg = long.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("n"), F.skewness(VALUE).alias("skewness_pop"),
                                   F.kurtosis(VALUE).alias("kurtosis_pop"))
    jb = F.col("n") / 6.0 * (F.col("skewness_pop") ** 2 + F.col("kurtosis_pop") ** 2 / 4.0)
    return agg.select(COLUMN, F.lit("Jarque-Bera").alias("test"), "n", "skewness_pop", "kurtosis_pop",
                      jb.alias("statistic"), F.exp(-jb / 2.0).alias("p_value"),
                      (F.exp(-jb / 2.0) >= alpha).alias("normal"))


def normality_ks(df: DataFrame, col: str) -> dict:
    """T1 alternative: one-sample Kolmogorov-Smirnov against the normal with
    the sample's mean and std (``pyspark.ml.stat``)."""
    from pyspark.ml.stat import KolmogorovSmirnovTest
    x = df.select(clean_double(col).alias("x")).where(F.col("x").isNotNull())
    m = x.agg(F.avg("x").alias("m"), F.stddev_samp("x").alias("s")).first()
    r = KolmogorovSmirnovTest.test(x, "x", "norm", float(m["m"]), float(m["s"])).first()
    return {"test": "Kolmogorov-Smirnov", "statistic": float(r["statistic"]), "p_value": float(r["pValue"]),
            "normal": float(r["pValue"]) >= ALPHA}


# Normal scores summed in one expression; longer runs of equal values are cut.
SCORES_AT_ONCE = 4_096


def normality_order(df: DataFrame, cols: Sequence[str], alpha: float = ALPHA) -> DataFrame:
    """T1 from order statistics, on all rows: Shapiro-Francia W', the squared
    correlation of the ordered values with the normal scores of their places,
    ``quantile((i - 3/8) / (n + 1/4))``.

    Places come from the distributed ranks, one row for each distinct value; a
    run of equal values takes the sum of the scores of its places, in pieces
    of ``SCORES_AT_ONCE`` spread over tasks.  W' is NULL for constant columns,
    p (Royston's approximation) for under 5 values."""
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    runs = value_ranks(long, [COLUMN], VALUE).select(COLUMN, VALUE, "cnt", BEFORE, F.col("group_total").alias("n"))
    pieces = (runs.withColumn("from", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("cnt") - 1, F.lit(SCORES_AT_ONCE).cast("bigint"))))
              .withColumn("to", F.least(F.col("from") + SCORES_AT_ONCE, F.col("cnt"))))
    score = f"transform(sequence(from + 1, to), i -> ({BEFORE} + i - 0.375D) / (n + 0.25D))"
    scores = f"transform({score}, p -> {inverse_normal_sql('p')})"
    sums = pieces.selectExpr(COLUMN, VALUE, "to - from AS c", "n", f"{scores} AS m").selectExpr(
        COLUMN, VALUE, "c", "n", "aggregate(m, 0D, (s, x) -> s + x) AS m", "aggregate(m, 0D, (s, x) -> s + x * x) AS mm")
    # values are taken from the mean, which the scores (symmetric about 0) do not need
    means = long.groupBy(COLUMN).agg(F.avg(VALUE).alias("mean"))
    x = F.col(VALUE) - F.col("mean")
    w = (sums.join(checked_broadcast(means), COLUMN).groupBy(COLUMN)
         .agg(F.max("n").alias("n"), F.try_divide(F.sum(x * F.col("m")) ** 2, F.sum(F.col("c") * x * x) * F.sum("mm")).alias("statistic")))
    ps = {r[COLUMN]: shapiro_francia_p(r["statistic"], r["n"]) for r in w.collect()}
    p = F.lit(None).cast("double")
    for c, v in ps.items():
        p = F.when(F.col(COLUMN) == c, F.lit(None if math.isnan(v) else v).cast("double")).otherwise(p)
    return w.select(COLUMN, F.lit("Shapiro-Francia").alias("test"), "n", "statistic", p.alias("p_value"), (p >= alpha).alias("normal"))


# ----------------------------------------------------------------- T2 confidence interval

def mean_standard_error(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """T2 part 1: ``(column_name, n, mean, std_error)`` in one aggregate."""
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    return long.groupBy(COLUMN).agg(
        F.count(F.lit(1)).alias("n"), F.avg(VALUE).alias("mean"),
        F.try_divide(F.stddev_samp(VALUE), F.sqrt(F.count(F.lit(1)))).alias("std_error"))


def confidence_interval(df: DataFrame, cols: Sequence[str], confidence: float = 0.95) -> DataFrame:
    """Mean +- t(n-1) quantile x standard error.  The t quantile is a
    driver scalar per column (n-1 degrees of freedom, not n as in the
    reference)."""
    se = mean_standard_error(df, cols)
    ns = {r[COLUMN]: r["n"] for r in se.select(COLUMN, "n").collect()}
    tq = {c: (t_ppf((1 + confidence) / 2, n - 1) if n and n > 1 else None) for c, n in ns.items()}
    tmap = F.create_map(*[x for c, t in tq.items() for x in (F.lit(c), F.lit(t).cast("double"))])
    t = tmap[F.col(COLUMN)]
    return se.select(COLUMN, "n", "mean", "std_error", t.alias("t_critical"),
                     (F.col("mean") - t * F.col("std_error")).alias("lower_bound"),
                     (F.col("mean") + t * F.col("std_error")).alias("upper_bound"),
                     F.lit(confidence).alias("confidence"))


# ----------------------------------------------------------------- T3-T7 two groups

def _two_group_long(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    g = F.col(group_col)
    base = df.where(g.isin(v1, v2)).withColumn("_g1", (g == F.lit(v1)).cast("int"))
    return to_long(base, cols, keep=["_g1"]).where(F.col(VALUE).isNotNull())


def group_moments(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    """Per column: n, mean, std, population skewness / kurtosis of both
    groups, one grouped aggregate for all columns."""
    long = _two_group_long(df, cols, group_col, v1, v2)
    out = []
    for i, flag in ((1, 1), (2, 0)):
        x = F.when(F.col("_g1") == flag, F.col(VALUE))
        out += [F.count(x).alias(f"group{i}_n"), F.avg(x).alias(f"group{i}_mean"),
                F.stddev_samp(x).alias(f"group{i}_std"), F.skewness(x).alias(f"_g{i}_skew"),
                F.kurtosis(x).alias(f"_g{i}_kurt")]
    return long.groupBy(COLUMN).agg(*out)


def welch_t(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    """T4: Welch's t and its degrees of freedom per column; NULL where both
    groups are constant."""
    return _welch(group_moments(df, cols, group_col, v1, v2))


def _welch(m: DataFrame) -> DataFrame:
    a = F.try_divide(F.col("group1_std") ** 2, F.col("group1_n"))
    b = F.try_divide(F.col("group2_std") ** 2, F.col("group2_n"))
    t = F.try_divide(F.col("group1_mean") - F.col("group2_mean"), F.sqrt(a + b))
    dof = F.try_divide((a + b) ** 2, F.try_divide(a ** 2, F.col("group1_n") - 1)
                       + F.try_divide(b ** 2, F.col("group2_n") - 1))
    return m.select(COLUMN, "group1_n", "group2_n", "group1_mean", "group2_mean", "group1_std", "group2_std",
                    t.alias("t_statistic"), dof.alias("welch_df"))


def cohens_d(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    """``|m1 - m2| / sqrt((s1^2 + s2^2) / 2)`` and its label."""
    m = group_moments(df, cols, group_col, v1, v2)
    pooled = F.sqrt((F.col("group1_std") ** 2 + F.col("group2_std") ** 2) / 2.0)
    d = F.coalesce(F.try_divide(F.abs(F.col("group1_mean") - F.col("group2_mean")), pooled), F.lit(0.0))
    return m.select(COLUMN, d.alias("cohens_d"), _label(d, COHEN_LABELS).alias("effect"))


def _u_table(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    long = _two_group_long(df, cols, group_col, v1, v2)
    ranked = value_ranks(long, [COLUMN], VALUE, extra_sums=["_g1"])
    agg = ranked.groupBy(COLUMN).agg(
        F.sum(F.col("avg_rank") * F.col("_g1")).alias("_r1"),
        F.sum("_g1").cast("double").alias("_n1"),
        F.sum("cnt").cast("double").alias("_n"),
        F.sum(F.col("cnt").cast("double") ** 3 - F.col("cnt")).alias("_ties"))
    n1, n = F.col("_n1"), F.col("_n")
    n2 = n - n1
    u1 = F.col("_r1") - n1 * (n1 + 1) / 2.0
    mu = n1 * n2 / 2.0
    s = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1))))
    z = F.try_divide(F.greatest(u1, n1 * n2 - u1) - mu - 0.5, s)
    return agg.select(COLUMN, n1.cast("bigint").alias("group1_n"), n2.cast("bigint").alias("group2_n"),
                      u1.alias("u_statistic"), z.alias("z"), (F.col("_ties") > 0).alias("tied"))


def mann_whitney(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    """T5: Mann-Whitney U of group 1 with tie-averaged ranks, and the
    tie-corrected normal z of the two-sided test (continuity corrected, on
    ``max(U1, U2)``).  Ranks per column come from :func:`value_ranks`: one
    row per distinct value, ranges spread over tasks."""
    return _u_table(df, cols, group_col, v1, v2).drop("tied")


# Size of the smaller group up to which the p-value is exact, if no values tie.
EXACT_GROUP = 8


def _u_p(r) -> float | None:
    """Two-sided p-value: counted for a group of at most ``EXACT_GROUP`` values
    without ties, else from the normal approximation."""
    n1, n2 = r["group1_n"], r["group2_n"]
    if 0 < min(n1, n2) <= EXACT_GROUP and not r["tied"] and n1 * n2 <= EXACT_U:
        return mann_whitney_exact_p(r["u_statistic"], n1, n2)
    return min(1.0, 2.0 * norm_sf(r["z"])) if r["z"] is not None else None


def mann_whitney_test(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2) -> DataFrame:
    """T5 with its two-sided ``p_value``: :func:`mann_whitney`, whose few rows
    get their p on the driver."""
    rows = _u_table(df, cols, group_col, v1, v2).collect()
    return df.sparkSession.createDataFrame(
        [(r[COLUMN], r["group1_n"], r["group2_n"], r["u_statistic"], r["z"], _u_p(r)) for r in rows],
        f"{COLUMN} string, group1_n bigint, group2_n bigint, u_statistic double, z double, p_value double")


def compare_two_groups(df: DataFrame, cols: Sequence[str], group_col: str, v1, v2,
                       alpha: float = ALPHA) -> DataFrame:
    """Per column, Welch's t when both groups pass the normality
    test, else Mann-Whitney U; means, stds, sizes, statistic, p-value,
    significance, Cohen's d and its label.  Groups with fewer than 3 rows
    get test_type ``insufficient data``.  All columns share one moment
    aggregate and one rank job; the per-column choice is made on the
    driver from those few scalars."""
    # one moment aggregate: Welch's t is a projection of its few rows
    moments = df.sparkSession.createDataFrame(
        (got := group_moments(df, cols, group_col, v1, v2)).collect(), got.schema)
    m = {r[COLUMN]: r for r in moments.collect()}
    w = {r[COLUMN]: r for r in _welch(moments).collect()}
    u = {r[COLUMN]: r for r in _u_table(df, cols, group_col, v1, v2).collect()}
    rows = []
    for c in cols:
        r = m.get(c)
        if r is None:
            continue
        n1, n2 = r["group1_n"], r["group2_n"]
        rec = {COLUMN: c, "group1_n": n1, "group2_n": n2, "group1_mean": r["group1_mean"],
               "group2_mean": r["group2_mean"], "group1_std": r["group1_std"], "group2_std": r["group2_std"]}
        if n1 < MIN_GROUP_ROWS or n2 < MIN_GROUP_ROWS:
            rows.append({**rec, "test_type": "insufficient data", "statistic": None, "p_value": None,
                         "significant": None, "cohens_d": None, "effect": None})
            continue

        def jb_p(n, sk, ku):
            if sk is None or ku is None or math.isnan(sk) or math.isnan(ku):
                return 0.0  # a constant group is not normal
            return math.exp(-(n / 6.0 * (sk ** 2 + ku ** 2 / 4.0)) / 2.0)
        normal = jb_p(n1, r["_g1_skew"], r["_g1_kurt"]) >= alpha and jb_p(n2, r["_g2_skew"], r["_g2_kurt"]) >= alpha
        if normal:
            test, stat = "Welch's t-test", w[c]["t_statistic"]
            p = t_two_sided_p(stat, w[c]["welch_df"]) if stat is not None else None
        else:
            test, stat = "mannwhitneyu", u[c]["u_statistic"]
            p = _u_p(u[c])
        s1, s2 = r["group1_std"] or 0.0, r["group2_std"] or 0.0
        pooled = math.sqrt((s1 ** 2 + s2 ** 2) / 2.0)
        d = abs(r["group1_mean"] - r["group2_mean"]) / pooled if pooled else 0.0
        eff = next(name for lim, name in COHEN_LABELS if d < lim)
        rows.append({**rec, "test_type": test, "statistic": None if stat is None else float(stat),
                     "p_value": p,
                     "significant": p is not None and p < alpha, "cohens_d": d, "effect": eff})
    schema = T.StructType([
        T.StructField(COLUMN, T.StringType()), T.StructField("test_type", T.StringType()),
        T.StructField("group1_mean", T.DoubleType()), T.StructField("group2_mean", T.DoubleType()),
        T.StructField("group1_std", T.DoubleType()), T.StructField("group2_std", T.DoubleType()),
        T.StructField("group1_n", T.LongType()), T.StructField("group2_n", T.LongType()),
        T.StructField("statistic", T.DoubleType()), T.StructField("p_value", T.DoubleType()),
        T.StructField("significant", T.BooleanType()), T.StructField("cohens_d", T.DoubleType()),
        T.StructField("effect", T.StringType())])
    return df.sparkSession.createDataFrame([tuple(x.get(f.name) for f in schema.fields) for x in rows], schema)


# ----------------------------------------------------------------- T8-T11 categorical

def contingency(df: DataFrame, a: str, b: str) -> DataFrame:
    """Long crosstab ``(a, b, count)`` over non-null pairs."""
    return (df.where(F.col(a).isNotNull() & F.col(b).isNotNull())
            .groupBy(a, b).agg(F.count(F.lit(1)).alias("count")))


def contingency_wide(df: DataFrame, a: str, b: str, b_levels: Sequence) -> DataFrame:
    """T8 wide: one column per level of ``b`` (levels given, so the pivot
    needs no extra pass), zeros filled."""
    return (df.where(F.col(a).isNotNull()).groupBy(a).pivot(b, list(b_levels))
            .agg(F.count(F.lit(1))).fillna(0))


def chi_square(df: DataFrame, cols: Sequence[str] | None, target: str, correction: bool = True) -> DataFrame:
    """Chi-square test of independence of every categorical
    column against ``target``: chi2 (Yates-corrected when dof = 1), dof,
    n, smallest expected count, Cramer's V and its label.

    ``chi2 = sum(o^2 / e) - n`` over the observed cells only, so the level x
    class grid is never built; the Yates correction of a 2 x 2 table follows
    from its plain chi2 and totals."""
    cols = list(cols) if cols is not None else categorical_columns(df, [target])
    base = df.where(F.col(target).isNotNull())
    long = to_long(base, cols, as_type="string", keep=[target]).where(F.col(VALUE).isNotNull())
    ensure_checkpoint_dir(df.sparkSession)
    # the observed cells are read by every total below: one scan, frozen
    cells = (long.groupBy(COLUMN, VALUE, target).agg(F.count(F.lit(1)).alias("o"))
             .checkpoint(eager=True))
    classes = cells.groupBy(COLUMN, target).agg(F.sum("o").alias("col_total")).checkpoint(eager=True)
    right, on = same_group(cells, classes, [COLUMN, target], "_t_")
    levels = (cells.join(checked_broadcast(right), on).groupBy(COLUMN, VALUE)
              .agg(F.sum("o").alias("row_total"), F.sum(F.col("o") * F.col("o") / F.col("col_total")).alias("_s")))
    # sum(o^2 / e) = n * sum over levels of sum(o^2 / column total) / row total
    out = (levels.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("r"), F.min("row_total").alias("_rmin"),
                                      F.sum("row_total").alias("n"),
                                      F.sum(F.col("_s") / F.col("row_total")).alias("_q"))
           .join(classes.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("c"), F.min("col_total").alias("_cmin")), COLUMN)
           .withColumn("dof", ((F.col("r") - 1) * (F.col("c") - 1)).cast("bigint")))
    n = F.col("n").cast("double")
    chi = F.greatest(n * F.col("_q") - n, F.lit(0.0))
    if correction:
        # 2 x 2: |o - e| is the same d in all four cells, so chi2 = d^2 * sum(1 / e)
        inverse = (n ** 3) / (F.col("_rmin") * (n - F.col("_rmin")) * F.col("_cmin") * (n - F.col("_cmin")))
        d = F.sqrt(chi / inverse)
        chi = F.when(F.col("dof") == 1, F.greatest(d - 0.5, F.lit(0.0)) ** 2 * inverse).otherwise(chi)
    k = F.least(F.col("r"), F.col("c")) - 1
    v = F.when(k > 0, F.sqrt(chi / (F.col("n") * k))).otherwise(F.lit(0.0))
    return out.select(COLUMN, chi.alias("chi2"), "dof", F.col("n").cast("bigint").alias("n"),
                      (F.col("_rmin") * F.col("_cmin") / F.col("n")).alias("min_expected"),
                      v.alias("cramers_v"), _label(v, CRAMER_LABELS).alias("effect"))


def chi_square_with_p(df: DataFrame, cols: Sequence[str] | None, target: str, alpha: float = ALPHA,
                      correction: bool = True) -> DataFrame:
    """T9 record with the p-value (driver scalar per column) and the flags."""
    res = chi_square(df, cols, target, correction)
    pv = {r[COLUMN]: chi2_sf(r["chi2"], r["dof"]) for r in res.select(COLUMN, "chi2", "dof").collect()}
    pmap = F.create_map(*[x for c, p in pv.items() for x in (F.lit(c), F.lit(p).cast("double"))])
    p = pmap[F.col(COLUMN)]
    return res.select("*", p.alias("p_value"), (p < alpha).alias("significant"),
                      (F.col("min_expected") < 5).alias("low_expected"))
