"""Learning curve against fits on each part alone; neighbours and new rows
against plain numpy."""

import pickle

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.operators import learning_curve as lc
from tabsieve.operators import many_fits as mf
from tabsieve.operators import neighbours as nn
from tabsieve.operators.logistic_path import LogisticUnit, fit_path, matrix_table
from tabsieve.operators.tree_model import TreeModel

FEATS = ["a", "b", "c"]


def frame(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, 3)).round(1)
    y = (x[:, 0] + x[:, 1] * x[:, 2] + rng.normal(0, 0.5, n) > 0.6).astype(int)
    return spark.createDataFrame([(i, int(y[i]), *map(float, x[i])) for i in range(n)], "k int, y int, a double, b double, c double").repartition(3, "k")


def test_stages_nest_and_keep_class_shares(spark):
    df = frame(spark)
    stages = lc.nested_stages(df, "k", "y", (0.1, 0.5, 0.9)).toPandas()
    n = stages["y"].value_counts()
    for s, f in enumerate((0.1, 0.5, 0.9)):
        part = stages[stages["_stage"] <= s]
        for c in (0, 1):
            assert (part["y"] == c).sum() == max(1, int(np.floor(f * n[c] + 0.5)))
    assert len(stages) == 400 and (stages["_stage"] == 3).any()
    with pytest.raises(ValueError):
        lc.nested_stages(df, "k", "y", (0.5, 0.2))


@pytest.mark.parametrize("handover", [50_000, 60])
def test_points_equal_fits_on_the_part_alone(spark, handover):
    df = frame(spark)
    staged = lc.nested_stages(df, "k", "y", (0.3, 1.0)).checkpoint()
    layout = mf.layout_of(df, FEATS)
    table = mf.bin_table(staged, FEATS, "y", "k", layout, "_stage")
    part = mf.bin_table(staged.where("_stage = 0"), FEATS, "y", "k", layout, None)
    counts = mf.class_facts(part)[None]
    for name, p in (("random_forest", {"n_estimators": 4}), ("xgboost", {"n_estimators": 4}), ("lightgbm", {"n_estimators": 4})):
        grow = mf.make_grow(name, {**lc._settings(name, p)}, counts, 3, 42)
        within, _ = mf.fit_units(table, [mf.Unit(grow, None, 0)], layout, handover)
        alone, _ = mf.fit_units(part, [mf.Unit(grow)], layout)
        cells = layout.cells(df.select(*FEATS).toPandas().to_numpy())
        for a, b in zip(within[0], alone[0]):
            assert a.predict(cells) == pytest.approx(b.predict(cells), abs=1e-12)
        assert len(within[0]) == len(alone[0]) == 4
    units = [LogisticUnit(0.7, penalty, None, (1.0, 1.3), 1000, upto) for penalty in ("l1", "l2") for upto in (0, None)]
    within = fit_path(matrix_table(staged, FEATS, "y", "_stage"), units, 3)
    alone = fit_path(matrix_table(staged.where("_stage = 0"), FEATS, "y", None),
                     [LogisticUnit(0.7, penalty, None, (1.0, 1.3)) for penalty in ("l1", "l2")], 3)
    assert within[[0, 2]] == pytest.approx(alone, abs=1e-6)


def test_curve_has_every_point(spark):
    df = frame(spark)
    specs = [("logistic_regression", {}), ("random_forest", {"n_estimators": 5}), ("lightgbm", {"n_estimators": 5})]
    got = lc.learning_curve(specs, df.where("k >= 100"), df.where("k < 100"), FEATS, "y", "k", (0.2, 0.6, 1.0), ("f1_score", "accuracy")).toPandas()
    assert len(got) == 3 * 3 * 2 * 2
    assert sorted(got["n_rows"].unique().tolist())[-1] == 300
    assert got["value"].between(0, 1).all()
    full = got[(got["fraction"] == 1.0) & (got["split"] == "train") & (got["metric"] == "accuracy")]
    assert (full["value"] > 0.7).all()


@pytest.mark.parametrize("handover", [50_000, 60])
def test_trees_scored_in_rounds_equal_whole_models(spark, monkeypatch, handover):
    monkeypatch.setattr(mf, "ROUND_BYTES", 500)
    df = frame(spark)
    layout = mf.layout_of(df, FEATS)
    table = mf.bin_table(lc.nested_stages(df, "k", "y", (0.4, 1.0)), FEATS, "y", "k", layout, "_stage")
    counts = mf.class_facts(table)[None]
    units = [mf.Unit(mf.make_grow(name, lc._settings(name, {"n_estimators": 4}), counts, 3, 42), None, upto)
             for name in ("random_forest", "lightgbm") for upto in (0, 1)]
    grown, _ = mf.grow_units(table, units, layout, handover)
    got = {bytes(r["cells"]): r["probability"] for r in mf.score_units(table, grown, units, 3).collect()}
    trees, _ = mf.fit_units(table, units, layout, handover)
    x = df.select(*FEATS).toPandas().to_numpy()
    cells = [r.tobytes() for r in layout.cells(x)]
    assert set(got) == set(cells)
    for u, unit in enumerate(units):
        want = TreeModel("m", FEATS, layout, unit.grow, trees[u]).probability(x)
        assert [got[c][u] for c in cells] == want.tolist()


def test_curve_holds_few_trees_at_a_time(spark, monkeypatch):
    sizes, plain = [], type(spark.sparkContext).broadcast

    def sized(self, value):
        sizes.append(len(pickle.dumps(value)))
        return plain(self, value)

    monkeypatch.setattr(type(spark.sparkContext), "broadcast", sized)
    monkeypatch.setattr(mf, "ROUND_BYTES", 20_000, raising=False)
    df = frame(spark)
    lc.learning_curve([("random_forest", {"n_estimators": 40})], df, df, FEATS, "y", "k", (0.5, 1.0)).collect()
    assert len(sizes) > 8 and max(sizes) < 50_000  # the forests: 300,000


def brute(points, k):
    out = []
    for key, x in points:
        rest = sorted((sum((a - b) ** 2 for a, b in zip(x, z)), other) for other, z in points if other != key)
        out += [(key, other, d, i + 1) for i, (d, other) in enumerate(rest[:k])]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"cell_rows": 12, "block_rows": 7}, {"cell_rows": 5, "block_rows": 4, "max_pivots": 6}])
def test_neighbours_equal_brute_force(spark, options):
    rng = np.random.default_rng(8)
    x = np.concatenate([rng.normal(0, 1, (60, 3)).round(0), rng.normal(20, 3, (60, 3)), np.zeros((25, 3))])
    points = [(int(i), x[j].tolist()) for i, j in enumerate(rng.permutation(len(x)))]
    rows = [(i, *v) for i, v in points] + [(900, None, 1.0, 1.0), (901, float("nan"), 0.0, 0.0), (902, 0.0, float("inf"), 0.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double, c double").repartition(4)
    got = nn.nearest_neighbours(df, "k", FEATS, 4, **options).toPandas().sort_values(["k", "place"])
    want = brute(points, 4)
    want.sort(key=lambda r: (r[0], r[3]))
    assert list(zip(got["k"], got["neighbour"], got["place"])) == [(a, b, p) for a, b, _, p in want]
    assert got["distance"].to_numpy() == pytest.approx([d ** 0.5 for _, _, d, _ in want])


def test_neighbours_of_few_rows(spark):
    df = spark.createDataFrame([(1, 0.0), (2, 3.0)], "k int, a double")
    assert sorted(map(tuple, nn.nearest_neighbours(df, "k", ["a"], 5).collect())) == [(1, 2, 3.0, 1), (2, 1, 3.0, 1)]
    assert nn.nearest_neighbours(df.limit(0), "k", ["a"]).count() == 0
    assert nn.nearest_neighbours(df.limit(1), "k", ["a"]).count() == 0


def test_smote_balances_and_stays_on_the_lines(spark):
    rng = np.random.default_rng(2)
    rows = [(i, "big" if i < 90 else "mid" if i < 120 else "one" if i == 120 else None, *map(float, rng.normal(i >= 90, 1, 3))) for i in range(123)]
    rows += [(500, "mid", None, 0.0, 0.0)]
    df = spark.createDataFrame(rows, "k int, y string, a double, b double, c double").repartition(3)
    out = nn.smote(df, FEATS, "y", "k", k=3).toPandas()
    assert out["y"].value_counts().to_dict() == {"big": 90, "mid": 90, "one": 90}
    assert len(out[~out["synthetic"]]) == len(rows) and out[out["synthetic"]]["k"].isna().all()
    x = {r[0]: np.array(r[2:], dtype=float) for r in rows if None not in r}
    near = {a: [] for a in x}
    for a, b, _, _ in brute([(r[0], list(r[2:])) for r in rows if r[1] == "mid" and None not in r], 3):
        near[a].append(b)
    made = out[out["synthetic"] & (out["y"] == "mid")]
    uses = made["base"].value_counts()
    assert len(uses) == 30 and uses.max() - uses.min() <= 1 and 500 not in uses
    for _, r in made.iterrows():
        p, base = r[FEATS].to_numpy(dtype=float), x[int(r["base"])]
        on_line = []
        for b in near[int(r["base"])]:
            step = x[b] - base
            t = (p - base) @ step / (step @ step)
            on_line.append(-1e-9 <= t <= 1 and np.allclose(base + t * step, p))
        assert any(on_line)
    lone = out[out["synthetic"] & (out["y"] == "one")]
    assert np.allclose(lone[FEATS].to_numpy(dtype=float), x[120])
    again = nn.smote(df.repartition(5), FEATS, "y", "k", k=3).where(F.col("synthetic")).toPandas()
    cols = ["base", "copy", *FEATS]
    assert sorted(map(tuple, again[cols].to_numpy().tolist())) == sorted(map(tuple, out[out["synthetic"]][cols].to_numpy().tolist()))


def test_first_entries_go_by_distance_then_number():
    rng = np.random.default_rng(3)
    for rows, width, k in ((40, 60, 5), (7, 5, 5), (3, 30, 1)):
        sq = rng.integers(0, 6, (rows, width)).astype(float)
        sq[rng.random((rows, width)) < 0.3] = np.inf
        other = np.argsort(rng.random((rows, width)), axis=1)
        order = np.lexsort((other, sq), axis=-1)[:, :k]
        near, who = nn._first_of(sq, other, k)
        assert (near == np.take_along_axis(sq, order, axis=1)).all() and (who == np.take_along_axis(other, order, axis=1)).all()


def test_cells_of_a_million_vectors_keep_their_size():
    assert nn.MAX_PIVOTS * nn.CELL_ROWS >= 4_000_000
