"""Attributions against their definition: the Shapley value by all subsets."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.operators import attribution as at
from tabsieve.operators import train

FEATS = [f"x{i}" for i in range(10)]


def frame(spark, n=240):
    rng = np.random.default_rng(3)
    x = rng.integers(0, 6, (n, 10)).astype(float)
    y = ((x[:, 0] * x[:, 1] + x[:, 2] - x[:, 3] * (x[:, 4] > 2) + rng.normal(0, 1, n)) > 8).astype(int)
    rows = [(i, int(y[i]), *[None if (i + f) % 17 == 0 else float(x[i, f]) for f in range(10)]) for i in range(n)]
    return spark.createDataFrame(rows, "k int, y int, " + ", ".join(f"{f} double" for f in FEATS)).repartition(3, "k").cache()


def expectation(tree, cover, cells, known, node=0):
    """The tree's value with only ``known`` features, by recursion."""
    f = tree.feature[node]
    if f < 0:
        return tree.value[node]
    kids = (tree.left[node], tree.right[node])
    if f in known:
        return expectation(tree, cover, cells, known, kids[0] if cells[f] <= tree.cell[node] else kids[1])
    return sum(cover[c] / cover[node] * expectation(tree, cover, cells, known, c) for c in kids)


@pytest.mark.parametrize("name", ["random_forest", "xgboost", "lightgbm"])
def test_equals_the_definition_by_subsets(spark, name):
    df = frame(spark)
    m = train.fit_model(name, df, FEATS, "y", {"n_estimators": 2, "max_depth": 4}, key="k")
    rows = df.orderBy("k").toPandas()
    cells = m.layout.cells(rows[FEATS].to_numpy(dtype=float))
    got = at.shap_values(m, df.where("k < 3"), FEATS, "k", background=df).toPandas()
    scale = 1 / len(m.trees) if name == "random_forest" else 1.0
    for k in range(3):
        want = np.zeros(10)
        for t in m.trees:
            cover = np.zeros(len(t.feature))
            np.add.at(cover, t.leaf_of(cells), 1)
            for i in range(len(cover) - 1, -1, -1):
                if t.feature[i] >= 0:
                    cover[i] = cover[t.left[i]] + cover[t.right[i]]
            value = {s: expectation(t, cover, cells[k], set(s)) for r in range(11) for s in itertools.combinations(range(10), r)}
            for i in range(10):
                for s in value:
                    if i not in s:
                        w = math.factorial(len(s)) * math.factorial(9 - len(s)) / math.factorial(10)
                        want[i] += scale * w * (value[tuple(sorted((*s, i)))] - value[s])
        mine = got[got["k"] == k].set_index("feature")["attribution"]
        assert [mine[f] for f in FEATS] == pytest.approx(want.tolist(), abs=1e-9)


@pytest.mark.parametrize("name", ["random_forest", "xgboost", "lightgbm", "logistic_regression"])
def test_adds_up_to_score_less_base(spark, name):
    df = frame(spark).fillna(0.0, FEATS) if name == "logistic_regression" else frame(spark)
    m = train.fit_model(name, df, FEATS, "y", {} if name == "logistic_regression" else {"n_estimators": 12}, key="k")
    sums = at.shap_values(m, df, FEATS, "k").groupBy("k").agg((F.sum("attribution") + F.first("base_value")).alias("total")).toPandas()
    score = train.score(m, df, "y", keep=["k"]).toPandas()
    both = sums.merge(score, on="k")
    assert len(both) == 240
    p = both["probability"].to_numpy()
    want = p if name == "random_forest" else np.log(p / (1 - p))
    assert both["total"].to_numpy() == pytest.approx(want, abs=1e-7)


def test_summary_ranks_and_odd_tables(spark):
    df = frame(spark)
    m = train.fit_model("xgboost", df, FEATS, "y", {"n_estimators": 5}, key="k")
    values = at.shap_values(m, df, FEATS, "k")
    s = at.shap_summary(values, top=3).orderBy("rank").toPandas()
    assert len(s) == 3 and s["mean_abs"].is_monotonic_decreasing and s["rank"].tolist() == [1, 2, 3]
    assert at.shap_values(m, df.limit(0), FEATS, "k", background=df).count() == 0
    # no background at all: every split is even, and the sums still hold
    even = at.shap_values(m, df, FEATS, "k", background=df.limit(0)).groupBy("k").agg(
        (F.sum("attribution") + F.first("base_value")).alias("total")).toPandas().sort_values("k")
    own = values.groupBy("k").agg((F.sum("attribution") + F.first("base_value")).alias("total")).toPandas().sort_values("k")
    assert even["total"].to_numpy() == pytest.approx(own["total"].to_numpy(), abs=1e-9)
    twice = df.where("k < 2").unionByName(df.where("k < 2"))
    assert at.shap_values(m, twice, FEATS, "k", background=df).count() == 40
    with pytest.raises(ValueError):
        at.shap_values(m, df, FEATS[:3], "k")
