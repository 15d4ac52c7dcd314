"""Collocations against a plain count in Python."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tabsieve.llm import collocations as C


def plain(rows, top, min_count=10, covered=50):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in (1, 2, 3):
                counts.setdefault(lang, Counter()).update(tuple(words[i:i + size]) for i in range(len(words) - size + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        dropped = set()
        for p, a in candidates.items():
            for q in (p[:2], p[1:]) if len(p) == 3 else ():
                if 100 * a >= covered * candidates[q]:
                    dropped.add(q)
        kept = []
        for p, a in candidates.items():
            cuts = [(C.SCALE * a * a // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            s, _, left, right = min(cuts)
            if p not in dropped:
                kept.append((-s, -a, " ".join(p).encode(), left, right))
        for rank, (s, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -s))
    return sorted(out)


def corpus(seed, n=60):
    rng = np.random.default_rng(seed)
    words = ["the", "The", "new", "york", "Ünder", "a b", "x1", "#", "of", "é", "\x00", "\x1c", "Straße"]
    rows = []
    for _ in range(n):
        text = "".join(str(rng.choice(words)) + str(rng.choice([" "] * 10 + ["\t", "  ", ". ", ",", "\n", "\x0b", "!"]))
                       for _ in range(int(rng.integers(0, 80))))
        rows.append((rng.choice(["en", "de", "und", None]), text))
    return [*rows, ("en", None), ("en", ""), (None, "New York. " * 30), ("en", " . "), *[("fr", "the new york times")] * 12]


@pytest.mark.parametrize("words, pairs", [(C.HEAD_WORDS, C.HEAD_PAIRS), (4, 3), (0, 0), (C.HEAD_WORDS, 5)])
def test_equals_plain_count(spark, words, pairs):
    rows = corpus(words % 7 + pairs % 11)
    docs = spark.createDataFrame([(i, t, g, 1, 2) for i, (g, t) in enumerate(rows)],
                                 "doc_id long, text string, lang string, n long, word string").repartition(5)
    got = C.collocations(docs, top=40, head_words=words, head_pairs=pairs).collect()
    assert sorted(map(tuple, got)) == plain(rows, 40)


def test_sliced_texts(spark, monkeypatch):
    text = "one two three four. five six " * 40 + "x" * 500 + " one two three"
    for overlap in (0, 1, 2):
        whole = next(C.token_slices(text.encode(), overlap))
        for size in (7, 64, 10 ** 6):
            grams, got = Counter(zip(*(whole[i:] for i in range(overlap + 1)))), Counter()
            for part in C.token_slices(text.encode(), overlap, size):
                got.update(zip(*(part[i:] for i in range(overlap + 1))))
            assert got == grams


@settings(max_examples=40, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3000), st.integers(0, 2100)), max_size=300), st.sampled_from([1, 3, 10 ** 6]))
def test_tiles_count_every_cell(cells, dense):
    rows, cols = (np.array([c[k] for c in cells], dtype=np.int64) for k in (0, 1))
    r, c, n = C.tile_cells(rows, cols, 2101, dense)
    assert dict(zip(zip(r.tolist(), c.tolist()), n.tolist())) == dict(Counter(cells))


@pytest.mark.parametrize("dense", [1, 10 ** 6])
def test_tiles_of_cells_beyond_32_bits(dense):
    rows, cols = np.array([39_202, 39_202, 7], dtype=np.int32), np.array([54_003, 54_003, 1], dtype=np.int32)
    r, c, n = C.tile_cells(rows, cols, 58_057, dense)
    assert sorted(zip(r.tolist(), c.tolist(), n.tolist())) == [(7, 1, 1), (39_202, 54_003, 2)]


def test_pair_ranks_have_64_bits():
    ids = C.Ids(pa.table({"lang": ["en"] * 2, "word": ["a", "b"]}), True)
    ids.set_pairs(pa.table({"id1": pa.array([0, 1], pa.int32()), "id2": pa.array([1, 1], pa.int32()), "n": [10, 20]}), True)
    ranks = ids.ranks(np.array([1, 3, 2]))
    assert ranks.tolist() == [1, 0, -1] and ranks.dtype == np.int64


def test_score_is_exact_beyond_64_bits(spark):
    cases = [(10 ** 14 - 1, 10 ** 14 + 7, 10 ** 14 - 1), (10 ** 14, 10 ** 14, 10 ** 14), (10, 10 ** 15 - 1, 10 ** 15 - 1),
             (3, 7, 9), (987654321987654, 999999999999999, 987654321987655)]
    got = spark.createDataFrame(cases, "a long, l long, r long").select("a", "l", "r", C.score_of(F.col("a"), F.col("l"), F.col("r")).alias("s"))
    for a, left, right, s in got.collect():
        assert s == C.SCALE * a * a // (left * right)


def test_empty_table(spark):
    assert C.collocations(spark.createDataFrame([], "doc_id long, text string, lang string")).count() == 0
    assert C.collocations(spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")).count() == 0
