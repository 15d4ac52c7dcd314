import zlib

import numpy as np

from tabsieve.llm import toxicity as T


def corpus(n=400, slur_with_group=0.7):
    rng = np.random.default_rng(6)
    rows, labels = [], []
    plain = [f"word{i}" for i in range(60)]
    for i in range(n):
        words = list(rng.choice(plain, 25))
        toxic = i % 3 == 0
        if toxic:
            words[3] = str(rng.choice(["zorkface", "zorkhead", "blarg"]))
        if rng.random() < (slur_with_group if toxic else 0.1):
            words[7] = "muslim"
        rows.append((i, " ".join(words).capitalize() + "!"))
        labels.append((i, int(toxic)))
    return rows, labels


def fitted(counterfactual):
    rows, labels = corpus()
    sets = [T.words_of(t) for _, t in rows]
    x = [np.array(sorted(T.feature_set(s))) for s in sets]
    pairs = [(a, np.array(sorted(T.feature_set(T.swapped(s))))) for a, s in zip(x, sets) if T.swapped(s) != s]
    assert pairs
    return T.fit(x, np.array([y for _, y in labels], dtype=float), pairs, counterfactual)


def test_swap_stays_in_the_group():
    assert T.swapped({"muslim", "women", "stone"}) == {"jewish", "men", "stone"}


def test_penalty_takes_the_weight_off_identity_terms():
    def gap(model):
        score = model.scorer()
        return abs(score("a muslim walks word1 home") - score("a hindu walks word1 home"))
    loose, held = fitted(0.0), fitted(5.0)
    assert gap(held) < 0.3 * gap(loose)
    assert held.scorer()("you zorkface") > 0.5 > held.scorer()("a muslim walks home")


def test_held_out_accuracy_and_odd_rows(spark):
    rows, labels = corpus()
    extra = [(None, None), (900, ""), (901, "blarg " * 20_000), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows + extra], "doc_id bigint, text string, score string")
    lab = spark.createDataFrame([(i, y, 1) for i, y in labels] + [(None, 1, 1), (5, None, 1)],
                                "doc_id bigint, toxic int, text int")
    model = T.train(docs, lab)
    got = T.score(docs, model).select("doc_id", T.held_out_column(), "score", "predicted").collect()
    assert len(got) == len(rows) + len(extra)
    truth = dict(labels)
    held = [r for r in got if r.held_out and r.doc_id in truth]
    assert all((zlib.crc32(str(r.doc_id).encode()) % 5 == 0) == r.held_out for r in got if r.doc_id is not None)
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert {r.doc_id: r.predicted for r in got}[901] == 1 and {r.doc_id: r.predicted for r in got}[900] == 0


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([(1, "text")], "doc_id bigint, text string")
    lab = spark.createDataFrame([], "doc_id bigint, toxic int")
    assert [r.score for r in T.score(docs, T.train(docs, lab)).collect()] == [0.5]
    assert T.score(docs.limit(0), T.train(docs.limit(0), lab)).count() == 0
