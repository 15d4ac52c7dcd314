import numpy as np
import pytest

from tabsieve.llm import metric_join as M


def brute(rows):
    def sound(v):
        return v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v)
    low, links = list(range(len(rows))), [0] * len(rows)

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i, (_, a) in enumerate(rows):
        for j, (_, b) in enumerate(rows[:i]):
            if sound(a) and sound(b) and len(a) == len(b):
                a64, b64 = np.array(a, float), np.array(b, float)
                if a64 @ b64 / (np.linalg.norm(a64) * np.linalg.norm(b64)) >= 0.9:
                    links[i] += 1
                    links[j] += 1
                    x, y = find(i), find(j)
                    low[max(x, y)] = min(x, y)
    first = {}
    for i, (k, _) in enumerate(rows):
        first[find(i)] = min(first.get(find(i), k), k)
    return sorted((k, links[i], first[find(i)], k == first[find(i)]) for i, (k, _) in enumerate(rows))


def fixture():
    rng = np.random.default_rng(4)
    rows = []
    for c in range(25):
        centre = rng.standard_normal(8)
        for _ in range(int(rng.integers(1, 12))):
            rows.append((centre + rng.standard_normal(8) * 0.15).astype(np.float32).tolist())
    rows += [rows[0]] * 3 + [[2 * x for x in rows[5]], [-x for x in rows[5]]] + [list(map(float, rng.standard_normal(8)))
                                                                               for _ in range(40)]
    rows += [None, [], [0.0] * 8, [float("nan")] * 8, [None] + [1.0] * 7, [float("inf")] * 8, [1.0, 0.0], [1.0, 0.1],
             [-0.0, 1.0], [0.0, 1.0]]
    order = rng.permutation(len(rows))
    return [(int(order[i]), v) for i, v in enumerate(rows)]


@pytest.mark.parametrize("options", [{}, {"cell_rows": 20, "block_rows": 6}, {"cell_rows": 8, "block_rows": 6, "max_pivots": 4},
                                     {"cell_rows": 3, "block_rows": 4, "max_pivots": 6}])
def test_links_equal_brute_force(spark, options):
    rows = fixture()
    df = spark.createDataFrame([(k, v, 1, "x") for k, v in rows],
                               "vec_id bigint, embedding array<float>, class_id int, kept string").repartition(3)
    assert sorted(map(tuple, M.near_vectors(df, **options).collect())) == brute(rows)


def test_cells_are_cut_over_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(M, "CUT_ROWS", 10)
    rows = fixture()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    assert sorted(map(tuple, M.near_vectors(df, cell_rows=6, block_rows=5, max_pivots=3).collect())) == brute(rows)


def test_empty_table(spark):
    assert M.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>")).count() == 0


def test_vectors_are_written_once_however_many_cells_they_reach(spark, tmp_path):
    rng = np.random.default_rng(7)
    x = rng.standard_normal((600, 12)).astype(np.float32)  # spread evenly: most cells reach most others
    x[300:] = x[:300] + rng.standard_normal((300, 12)).astype(np.float32) * 0.02
    classes = spark.createDataFrame([(i, 1, v.tolist()) for i, v in enumerate(x)], "class_id bigint, copies bigint, vec array<float>").checkpoint()
    links = M._links(classes, str(tmp_path / "blocks"), 0.9, 20, 40, 8).groupBy("class_id").sum("links").collect()
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.9).sum(axis=1) - 1
    assert {r[0]: r[1] for r in links} == {i: n for i, n in enumerate(want.tolist()) if n}
    files = list((tmp_path / "blocks").iterdir())
    ids = np.concatenate([M.ipc.open_file(f).read_all()["class_id"].to_numpy() for f in files])
    assert len(files) > 10 and sorted(ids.tolist()) == list(range(600))


def test_links_near_the_bound_follow_double_precision(spark):
    rng = np.random.default_rng(8)
    base = np.zeros(16)
    base[0] = 1.0
    rows = [(0, base.tolist())]
    for i in range(1, 200):  # cosines with the first vector within 1e-9 of the bound
        away = rng.standard_normal(15)
        c = 0.9 + rng.uniform(-1e-9, 1e-9)
        rows.append((i, [c, *(away / np.linalg.norm(away) * np.sqrt(1 - c * c)).tolist()]))
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    assert sorted(map(tuple, M.near_vectors(df).collect())) == brute(rows)


def test_blocks_take_small_cells_together_and_cut_large_ones():
    assert M._plan_blocks([(0, 3), (1, 4), (2, 4), (5, 25), (6, 1), (7, 9)], 10) == [
        (0, 0, 1), (1, 0, 1), (2, 1, 1), (5, 2, 3), (6, 5, 1), (7, 5, 1)]
