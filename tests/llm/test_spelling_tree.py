"""Spelling variants against all pairs, and the trees against plain search."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabsieve.llm import spelling_tree as S


def near(x, y):
    if len(x) > len(y):
        x, y = y, x
    if len(x) == len(y):
        return sum(a != b for a, b in zip(x, y)) == 1
    return len(y) == len(x) + 1 and any(y[:i] + y[i + 1:] == x for i in range(len(y)))


def plain(count, ratio=10):
    out, form_of = [], {}
    for w, n in count.items():
        others = [o for o in count if near(w, o)]
        best = min(others, key=lambda o: (-count[o], o), default=None)
        form_of[w] = best if best is not None and count[best] >= ratio * n else None
        out.append((w, n, len(others)))
    rows = []
    for w, n, k in out:
        root = w
        while form_of[root] is not None:
            root = form_of[root]
        rows.append((w, form_of[w], root, n, k, count[form_of[w]] if form_of[w] else None))
    return sorted(rows)


def vocabulary(seed, size=400, letters="abcé"):
    rng = np.random.default_rng(seed)
    words = {}
    while len(words) < size:
        if words and rng.random() < 0.6:
            w = list(rng.choice(list(words)))
            at, c = int(rng.integers(len(w))), str(rng.choice(list(letters)))
            w[at:at + int(rng.integers(2))] = [c] * int(rng.integers(2))
            w = "".join(w)
        else:
            w = "".join(rng.choice(list(letters), int(rng.integers(7, 12))))
        if w:
            words[w] = int(rng.choice([2, 3, 25, 30, 300, 4000]))
    return words


@pytest.mark.parametrize("leaf, sample, letters", [(S.LEAF_WORDS, S.SAMPLE_WORDS, "abcé"), (16, 60, "abcdefghijklé"),
                                                   (8, 400, "ab"), (20, 400, "aÀÿőœb")])
def test_equals_all_pairs(spark, monkeypatch, leaf, sample, letters):
    monkeypatch.setattr(S, "LOCAL_WORDS", 6)
    count = vocabulary(leaf, letters=letters)
    rows = list(count.items()) + [(None, 3), ("nothing", None)]
    got = S.variants(spark.createDataFrame(rows, "word string, n long").repartition(3), leaf_words=leaf, sample_words=sample)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == plain(count)


def test_long_words_and_anagrams(spark):
    base = "abcdefghij" * 6
    count = {base: 500, base + "x": 40, base[:30] + "x" + base[31:]: 2, base[:40]: 300, base[:41]: 20, base[:39]: 2,
             "listens": 9, "silents": 9, "enlists": 9, "tinsels": 900, "tinselz": 9}
    got = S.variants(spark.createDataFrame(list(count.items()), "word string, n long"), leaf_words=2)
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == plain(count)


def test_words_given_twice_and_none(spark):
    rows = [("tinsels", 400), ("tinselz", 4), ("tinselz", 3), ("tinsels", 500)]
    got = {r.word: tuple(r) for r in S.variants(spark.createDataFrame(rows, "word string, n long")).collect()}
    assert got == {"tinsels": ("tinsels", None, "tinsels", 900, 1, None), "tinselz": ("tinselz", "tinsels", "tinsels", 7, 1, 900)}
    assert S.variants(spark.createDataFrame([], "word string, n long")).count() == 0


def test_words_of_texts(spark):
    rng = np.random.default_rng(3)
    words = ["Tinsels", "TINSELS", "É" + "tages" * 2, "étagère", "short", "ab×cdefg", "naïvetés"]
    rows = [(None if i == 5 else i, None if i == 7 else " ".join(rng.choice(words, 40)) + ("-" * (i % 3)), "clash") for i in range(200)]
    rows += [(300, "", "x"), rows[3], rows[3]]
    want = Counter()
    for doc_id, text, _ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{low}".encode())
            if h % 31 == 0:
                low = low[:h % len(low)] + low[h % len(low) + 1:]
            want[low] += 1
    want = {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string").repartition(4)
    assert dict(map(tuple, S.misspelt_words(docs).collect())) == want
    assert S.misspelt_words(docs.limit(0)).count() == 0


@pytest.mark.parametrize("up, down", [(1, 1), (1, 0)])
def test_search_reaches_every_box(up, down):
    rng = np.random.default_rng(4)
    points = rng.integers(0, 4, (300, 5)).astype(np.int32)
    tree, rows_of = S.Tree.grow(points, 7)
    assert sorted(np.concatenate(rows_of).tolist()) == list(range(300))
    assert all((tree.locate(points)[r] == i).all() for i, r in enumerate(rows_of))
    reached = {(int(q), leaf) for leaf, rows in tree.reach(points, up, down) for q in rows}
    for q in range(300):
        diff = points - points[q]
        for t in np.flatnonzero((np.maximum(diff, 0).sum(1) <= up) & (np.maximum(-diff, 0).sum(1) <= down)).tolist():
            assert (q, int(tree.locate(points[t:t + 1])[0])) in reached
    assert len(reached) < 300 * len(rows_of) / 2


def test_one_edit():
    pairs = [("abc", "abd"), ("abc", "abcd"), ("abc", "xabc"), ("abc", "abxc"), ("abc", "abc"), ("abc", "axbxc"), ("aab", "aaab"),
             ("abc", "bca"), ("abc", "bcde"), ("a", "b")]
    x, xl = S.code_matrix([p[0] for p in pairs])
    y, yl = S.code_matrix([p[1] for p in pairs])
    assert S.one_edit(x, xl, y, yl).tolist() == [near(*p) for p in pairs]
