import zlib

import numpy as np
import pytest

from tabsieve.llm import byte_convnet as B

WORDS = {"aa": ["kala", "moro", "tiika", "suova", "lumi"], "bb": ["schnitz", "grüß", "pflug", "zwang", "streit"],
         "cc": ["été", "château", "façon", "goût", "œuvre"]}


def corpus(n=180, seed=1):
    rng = np.random.default_rng(seed)
    langs = sorted(WORDS)
    return [(i, " ".join(rng.choice(WORDS[langs[i % 3]], int(rng.integers(5, 60)))), langs[i % 3]) for i in range(n)]


@pytest.fixture(scope="module")
def net(spark):
    return B.train(spark.createDataFrame(corpus() + [(500, None, "aa"), (501, "x", None)],
                                         "doc_id bigint, text string, lang string"))


def test_lookup_equals_convolution(net):
    x = np.random.default_rng(0).integers(0, 256, (5, B.WINDOW), dtype=np.uint8)
    assert np.allclose(net.pooled(x, net.pair_tables()), net._features(x, []), atol=1e-4)


def test_gradients_equal_finite_differences():
    net = B.ByteConvNet.start(["x", "y"])
    for name in ("embed", "out", "out_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    net.filters = {w: k.astype(np.float64) for w, k in net.filters.items()}
    x, y = np.random.default_rng(4).integers(97, 105, (4, 12), dtype=np.uint8), np.array([0, 1, 1, 0])

    def loss():
        return -np.mean(np.log(B._softmax(net._features(x, []) @ net.out + net.out_bias)[np.arange(4), y]))
    g = net._gradients(x, y)
    for array, grad, at in ((net.out, g[("out",)], (3, 1)), (net.filters[3], g[("filters", 3)], (5, 2)),
                            (net.embed, g[("embed",)], (99, 4))):
        old = array[at]
        array[at] = old + 1e-5
        up = loss()
        array[at] = old - 1e-5
        down = loss()
        array[at] = old
        assert abs((up - down) / 2e-5 - grad[at]) < 1e-5


def test_held_out_accuracy(spark, net):
    docs = spark.createDataFrame(corpus(), "doc_id bigint, text string, lang string")
    got = {r.doc_id: r for r in B.identify(docs, net).collect()}
    held = [(i, lang) for i, _, lang in corpus() if zlib.crc32(str(i).encode()) % 5 == 0]
    assert held and np.mean([got[i].lang_pred == lang for i, lang in held]) > 0.9


def test_whole_text_counts_and_odd_rows(spark, net):
    mostly = " ".join(WORDS["aa"][:2] * 40) + " " + " ".join(WORDS["bb"] * 400)
    rows = [(1, None), (2, ""), (3, "123 ... !"), (4, mostly), (None, "kala moro"), (5, "kala"), (5, "kala")]
    docs = spark.createDataFrame([(i, t, 0.5) for i, t in rows], "doc_id bigint, text string, score double")
    got = B.identify(docs, net).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == len(rows) and by[4].lang_pred == "bb"
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (1, 2, 3))
    assert all(0 <= r.score <= 1 for r in got)


def test_nothing_to_learn(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    net = B.train(docs)
    assert B.identify(docs, net).count() == 0 and net.predict(["text"]) == (["und"], [0.0])


def test_every_language_is_learned(spark):
    """300 languages, a few texts each: all are known, and the sample stays in bounds."""
    names = [f"l{i:03d}" for i in range(300)]
    rows = [(i * 300 + k, f"{name} " * 20 + "x" * (k % 7), name) for i in range(6) for k, name in enumerate(names)]
    docs = spark.createDataFrame(rows + [(9_000, "no language", None)], "doc_id bigint, text string, lang string")
    languages, x, y = B.training_windows(docs)
    assert languages == names and len(x) == len(y) <= B.TRAINING_WINDOWS
    assert set(y.tolist()) == set(range(300))
