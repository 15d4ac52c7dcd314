import re
from collections import Counter

import numpy as np
import pytest

from tabsieve.llm import divergence as D


def corpus(n=90):
    rng = np.random.default_rng(8)
    common = {"aa": ["the", "of", "and", "to", "in"], "bb": ["der", "und", "von", "ein", "zu"]}
    rows = []
    for i in range(n):
        lang = "aa" if i % 3 else "bb"
        words = [str(rng.choice(common[lang])) if rng.random() < 0.4 else
                 "".join(rng.choice(list("abcdeghilnorst"), int(rng.integers(3, 9)))) for _ in range(150)]
        rows.append((i, " ".join(words).capitalize() + ".", lang))
    return rows


def plain_base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    counts = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(8)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search(r"[^\x20\x09-\x0D]", x) and x in lines[:i])
    n = len(words)
    return (n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered),
            n < 20 or 100 * len(covered) > 30 * n)


TEXTS = [None, "", " \n\t", "one", "a b c d e f g h " * 3, "x " * 7, "x " * 8, "x " * 9, "l1 w\nl1 w\n\n\nl1 w \nother\x0bw",
         "#*$%&|<> é漢 😀", "A\x0cb\x0bc\x85d e", "q w e r t z u i o p " * 3 + "q w e r t z u", "line\r\nline\r\nline"]


@pytest.mark.parametrize("text", TEXTS)
def test_base_rules_equal_plain_count(text):
    assert D.judge(text or "", D.References())[:6] == plain_base(text)


def test_references_are_exact_whatever_the_segments(spark, monkeypatch):
    rows = corpus()
    docs = spark.createDataFrame(rows + [(500, None, "aa"), (501, "lost words", None)],
                                 "doc_id bigint, text string, lang string").repartition(5)
    ref = D.references(docs)
    for lang in ("aa", "bb"):
        words = Counter(w for _, t, k in rows if k == lang for w in D.bare_words(t.encode().split()))
        total = sum(words.values())
        want = {w: c for w, c in words.items() if c >= D.COMMON_SHARE * total}
        assert ref.words[lang] == want and ref.rest[lang] == total - sum(want.values())
        assert ref.chars[lang].tolist() == sum(D.char_classes(t.encode()) for _, t, k in rows if k == lang).tolist()


def test_distance_is_symmetric_and_bounded():
    a, b = np.array([3.0, 1, 0]), np.array([0.0, 0, 5])
    assert D.js_distance(a, a) == 0 and abs(D.js_distance(a, b) - 1) < 1e-12
    assert abs(D.js_distance(a, a + 1) - D.js_distance(a + 1, a)) < 1e-12


def test_verdicts(spark):
    rows = corpus()
    ref = D.references(spark.createDataFrame(rows, "doc_id bigint, text string, lang string"))
    junk = " ".join(f"{w.upper()}$$$" for w in rows[1][1].split())
    table = " | ".join("".join(np.random.default_rng(i).choice(list("abcde"), 6)) for i in range(400))
    odd = [(1000, junk), (1001, table), (1002, None), (1003, "short text"), (None, rows[3][1]), (7, rows[7][1])]
    docs = spark.createDataFrame([(i, t, True) for i, t, _ in rows] + [(i, t, False) for i, t in odd],
                                 "doc_id bigint, text string, kept boolean")
    got = D.apply_rules(docs, ref).collect()
    assert len(got) == len(rows) + len(odd)
    kept = {r.doc_id: r.kept for r in got}
    assert all(kept[i] for i, _, _ in rows) and kept[None]
    assert not any(kept[i] for i in (1000, 1001, 1002, 1003))
    assert not {r.doc_id: r for r in got}[1001].base_failed


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string, lang string")
    assert D.apply_rules(docs, D.references(docs)).count() == 0


def rare(n, lang, letters, seed):
    rng = np.random.default_rng(seed)
    common = ["".join(rng.choice(list(letters), 3)) for _ in range(6)]
    return [(f"{lang}{i}", " ".join(common[int(rng.integers(6))] if rng.random() < 0.4 else
                                   "".join(rng.choice(list(letters), int(rng.integers(4, 9)))) for _ in range(150)), lang)
            for i in range(n)]


def test_rare_languages_are_judged_by_their_own_words_or_not_at_all(spark):
    big = [(str(i), t + " the of and to in" * 3, k) for i, (_, t, k) in enumerate(corpus() * 70)]
    cc, dd = rare(20, "cc", "uvwxyzjkq", 1), rare(3, "dd", "mnpfgr", 2)  # 3,000 and 450 words, under 0.5 % of all
    rows = big + cc + dd
    ref = D.references(spark.createDataFrame(rows, "doc_id string, text string, lang string"))
    words = {k: sum(len(t.split()) for _, t, x in rows if x == k) for k in ("aa", "bb", "cc", "dd")}
    assert words["cc"] < 0.005 * sum(words.values()) and set(ref.words) == {"aa", "bb", "cc"}
    odd = [("table", " | ".join("1234567" for _ in range(300)), "cc"), ("null", dd[0][1], None)]
    docs = spark.createDataFrame(cc + dd + odd, "doc_id string, text string, lang string")
    got = {r.doc_id: r for r in D.apply_rules(docs, ref).collect()}
    assert all(got[i].kept and got[i].nearest_lang == "cc" for i, _, _ in cc)
    assert all(got[i].kept and (got[i].char_distance, got[i].word_distance, got[i].nearest_lang) == (None, None, None)
               for i, _, _ in dd)
    assert not got["table"].kept and got["null"].nearest_lang is not None and not got["null"].kept


def test_oracle_states_the_rule_of_the_code(spark, tmp_path):
    """A language under 0.5 % of all words with a reference, one without, and no language."""
    import duckdb

    from tabsieve.llm.queries import ORACLE, QUERIES
    rng = np.random.default_rng(3)

    def text(prefix, n):
        return " ".join(prefix + "aeiou"[k % 5] * (1 + k % 3) for k in rng.zipf(1.3, n) % 40) + "."
    rows = [(i, text("k", 900), "big") for i in range(500)] + [(600 + i, text("zu", 750), "rare") for i in range(3)]
    rows += [(700, text("wo", 300), "tiny"), (701, text("k", 300), None), (702, None, "big"), (703, "", "rare"), (704, text("zu", 200), "big")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op4_divergence_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    names = got.columns
    want = con.sql(f"SELECT {', '.join(names)} FROM ({ORACLE['op4_divergence_rules']})").fetchall()
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    by = {r.doc_id: r for r in got.collect()}
    assert by[700].nearest_lang is None and by[700].kept and by[600].nearest_lang == "rare" and by[600].kept
    assert by[701].nearest_lang == "big" and by[704].nearest_lang == "rare"
