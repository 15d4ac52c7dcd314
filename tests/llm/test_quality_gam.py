import zlib

import numpy as np

from tabsieve.llm import quality_gam as Q


def corpus(n=240):
    rng = np.random.default_rng(2)
    rows, labels = [], []
    for i in range(n):
        words = ["".join(rng.choice(list("abcdefgh"), int(rng.integers(2, 9)))) for _ in range(40)]
        good = i % 4 != 0
        text = ". ".join(words) + "." if good else " ".join(w.upper() + "$$$" for w in words)
        rows.append((i, text))
        labels.append((i, int(good), 0))
    return rows, labels


def test_tables_find_a_pure_interaction():
    rng = np.random.default_rng(0)
    x = rng.uniform(size=(4000, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = Q.fit(x[:3000], y[:3000], rounds=10)
    assert (0, 1) in model.pairs
    assert ((model.score(x[3000:]) >= 0.5) == y[3000:]).mean() > 0.9


def test_score_is_the_sum_of_table_entries():
    rng = np.random.default_rng(1)
    x, y = rng.uniform(size=(300, 2)), rng.integers(0, 2, 300).astype(float)
    m = Q.fit(x, y, rounds=5, pairs=1, pair_rounds=2)
    one = m.base + sum(t[np.searchsorted(e, x[7, j], side="right")] for j, (e, t) in enumerate(zip(m.edges, m.tables)))
    for (i, j), t in m.pairs.items():
        one += t[np.searchsorted(m.pair_edges[i], x[7, i], side="right"),
                 np.searchsorted(m.pair_edges[j], x[7, j], side="right")]
    assert abs(m.score(x)[7] - 1 / (1 + np.exp(-one))) < 1e-12


def test_no_rows_and_one_class():
    empty = np.zeros((0, len(Q.FEATURES)))
    assert Q.fit(empty, np.zeros(0)).score(np.zeros((2, len(Q.FEATURES)))).tolist() == [0.5, 0.5]
    assert Q.fit(np.ones((3, 2)), np.ones(3)).score(np.ones((1, 2))).tolist() == [1.0]


def test_held_out_accuracy_and_rows(spark):
    rows, labels = corpus()
    extra = [(None, None, 0), (900, "", 1), (901, " \n ", 2), (902, "word " * 50_000, 3), (5, rows[5][1], 4)]
    docs = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)] + extra,
                                 "doc_id bigint, text string, score int")
    lab = spark.createDataFrame(labels + [(None, 1, 0), (3, None, 0)], "doc_id bigint, quality int, toxic int")
    model = Q.train(docs, lab)
    got = Q.score(docs, model).select("doc_id", Q.held_out_column(), "score", "predicted").collect()
    assert len(got) == len(rows) + len(extra)
    truth = {i: q for i, q, _ in labels}
    held = [r for r in got if r.doc_id in truth and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert held and all(r.held_out for r in held) and all(r.predicted == truth[r.doc_id] for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    kept = Q.keep_good(docs, lab)
    assert kept.columns == docs.columns
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in kept.collect()) == sorted(
        -1 if r.doc_id is None else r.doc_id for r in got if r.predicted)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    lab = spark.createDataFrame([], "doc_id bigint, quality int")
    assert Q.score(docs, Q.train(docs, lab)).count() == 0 and Q.keep_good(docs, lab).count() == 0
