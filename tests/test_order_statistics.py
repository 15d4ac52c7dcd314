"""Kendall's tau, exact Mann-Whitney p-values and Shapiro-Francia."""

import itertools
import math
from statistics import NormalDist

import duckdb
import numpy as np
import pytest

from tabsieve.functions import stats
from tabsieve.operators import distribution as dist
from tabsieve.operators import stat_tests as st


def plain_tau(x, y):
    s = n1 = n2 = 0
    pairs = list(itertools.combinations(range(len(x)), 2))
    for i, j in pairs:
        a, b = np.sign(x[i] - x[j]), np.sign(y[i] - y[j])
        s, n1, n2 = s + a * b, n1 + (a == 0), n2 + (b == 0)
    below = math.sqrt((len(pairs) - n1) * (len(pairs) - n2))
    return s / below if below else None


@pytest.mark.parametrize("ranges", [1, 3, 16])
def test_kendall_equals_all_pairs_of_rows(spark, ranges):
    rng = np.random.default_rng(ranges)
    n = 150
    rows = [(float(rng.integers(0, 9)), float(rng.normal()) if rng.random() > 0.1 else None,
             7.0 if rng.random() < 0.4 else float(rng.integers(0, 1000)), 1.0, None) for _ in range(n)]
    df = spark.createDataFrame(rows, "a double, b double, hot double, same double, none double")
    got = {(r[0], r[1]): r[2] for r in dist.kendall_matrix(df, df.columns, ranges).collect()}
    assert len(got) == 25
    for (i, a), (j, b) in itertools.product(enumerate(df.columns), repeat=2):
        whole = [(r[i], r[j]) for r in rows if r[i] is not None and r[j] is not None]
        want = plain_tau([w[0] for w in whole], [w[1] for w in whole])
        assert got[(a, b)] == (None if want is None else pytest.approx(want, abs=1e-12)), (a, b)


def test_kendall_makes_no_pairs_of_rows(spark):
    df = spark.range(200).selectExpr("id % 7 AS a", "id AS b")
    seen = []
    real = dist._discordant
    try:
        dist._discordant = lambda g, first: seen.append(1) or real(g, first)
        plan = dist.kendall_matrix(df, ["a", "b"])._jdf.queryExecution().toString()
    finally:
        dist._discordant = real
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert dist.kendall_matrix(df.limit(0), ["a", "b"]).where("correlation IS NOT NULL").count() == 0


def test_inversions():
    rng = np.random.default_rng(0)
    for n in (0, 1, 2, 7, 64, 200):
        order, w = rng.permutation(n), rng.integers(1, 5, n).astype(float)
        want = sum(w[i] * w[j] for i in range(n) for j in range(i + 1, n) if order[i] > order[j])
        assert dist._inversions(order, w) == want


def test_u_distribution_by_enumeration():
    for m, n in ((1, 1), (2, 3), (3, 4), (4, 4), (2, 7)):
        us = [sum(1 for i in g for j in range(m + n) if j not in g and i > j) for g in itertools.combinations(range(m + n), m)]
        for u in range(m * n + 1):
            low = min(u, m * n - u)
            want = min(1.0, 2 * sum(x <= low for x in us) / len(us))
            assert stats.mann_whitney_exact_p(u, m, n) == pytest.approx(want)
            assert stats.mann_whitney_exact_p(u, n, m) == pytest.approx(want)


def test_u_against_published_critical_values():
    """Two-sided critical values of U at 0.05 (Mann-Whitney tables): the largest U that is significant."""
    for (m, n), critical in {(4, 4): 0, (5, 5): 2, (6, 6): 5, (7, 7): 8, (8, 8): 13, (3, 5): 0, (5, 8): 6, (8, 20): 41, (6, 15): 19}.items():
        assert stats.mann_whitney_exact_p(critical, m, n) <= 0.05 < stats.mann_whitney_exact_p(critical + 1, m, n)


def test_group_comparison_uses_the_exact_p(spark):
    small = [(1, v) for v in (1.0, 2.0, 3.0)] + [(0, v) for v in (10.0, 20.0, 30.0, 4000.0)]
    df = spark.createDataFrame(small, "g int, x double")
    r = st.mann_whitney_test(df, ["x"], "g", 1, 0).first()
    assert (r["u_statistic"], r["p_value"]) == (0.0, pytest.approx(2 / 35))
    tied = spark.createDataFrame(small + [(1, 10.0)], "g int, x double")
    t = st.mann_whitney_test(tied, ["x"], "g", 1, 0).first()
    assert t["p_value"] == pytest.approx(min(1.0, 2 * stats.norm_sf(t["z"])))
    many = spark.createDataFrame([(i % 2, float(i * 37 % 101)) for i in range(40)], "g int, x double")
    m = st.mann_whitney_test(many, ["x"], "g", 1, 0).first()
    assert m["p_value"] == pytest.approx(min(1.0, 2 * stats.norm_sf(m["z"])))
    c = st.compare_two_groups(spark.createDataFrame([(g, x ** 3) for g, x in small + [(1, 2.5), (1, 5.5)]], "g int, x double"),
                              ["x"], "g", 1, 0).first()
    if c["test_type"] == "mannwhitneyu":
        assert c["p_value"] == pytest.approx(stats.mann_whitney_exact_p(c["statistic"], 5, 4))


def test_inverse_normal_in_both_engines(spark):
    ps = [1e-300, 1e-20, 1e-9, 0.001, 0.07, 0.0751, 0.3, 0.5, 0.6, 0.925, 0.93, 0.9999, 1 - 1e-12]
    sql = stats.inverse_normal_sql("p")
    got = [r[0] for r in spark.createDataFrame([(p,) for p in ps], "p double").selectExpr(sql).collect()]
    duck = [duckdb.sql(f"SELECT {sql} FROM (SELECT CAST({p!r} AS DOUBLE) AS p)").fetchall()[0][0] for p in ps]
    want = [NormalDist().inv_cdf(p) for p in ps]
    assert got == pytest.approx(want, rel=1e-12, abs=1e-12) and duck == pytest.approx(want, rel=1e-12, abs=1e-12)


def test_shapiro_francia(spark, monkeypatch):
    monkeypatch.setattr(st, "SCORES_AT_ONCE", 7)
    rng = np.random.default_rng(5)
    n = 400
    cols = {"gauss": rng.normal(10, 3, n), "skew": rng.exponential(size=n), "ties": rng.integers(0, 4, n).astype(float),
            "same": np.ones(n)}
    df = spark.createDataFrame([tuple(float(c[i]) for c in cols.values()) for i in range(n)], ", ".join(f"{c} double" for c in cols))
    got = {r["column_name"]: r for r in st.normality_order(df, list(cols)).collect()}
    m = np.array([NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)])
    for c in ("gauss", "skew", "ties"):
        assert got[c]["statistic"] == pytest.approx(np.corrcoef(np.sort(cols[c]), m)[0, 1] ** 2, abs=1e-10)
        assert got[c]["n"] == n
    assert got["gauss"]["normal"] and not got["skew"]["normal"] and not got["ties"]["normal"]
    assert got["same"]["statistic"] is None and got["same"]["p_value"] is None
    # Royston's approximation: about 5 % of normal samples fall under 0.05
    low = 0
    for _ in range(400):
        x = np.sort(rng.normal(size=50))
        s = np.array([NormalDist().inv_cdf((i - 0.375) / 50.25) for i in range(1, 51)])
        low += stats.shapiro_francia_p(np.corrcoef(x, s)[0, 1] ** 2, 50) < 0.05
    assert 6 <= low <= 36
