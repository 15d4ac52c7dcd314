import re

import numpy as np
import xxhash

from tabsieve.llm import simhash_anchor as S


def plain_simhash(text, k=4):
    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    grams = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    counts = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for i in range(64):
            counts[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * counts[i] > len(grams))


def groups(rows):
    """Brute force over all pairs: component id of each row."""
    fp = [plain_simhash(t) for _, t in rows]
    low = list(range(len(rows)))

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i in range(len(rows)):
        for j in range(i):
            if bin(fp[i] ^ fp[j]).count("1") <= 4:
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    out = {}
    for i, (doc, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        out.setdefault((doc, f"{fp[i]:016x}"), set()).add(min(ids) if ids else None)
    return out


def fixture():
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(60):
        words = list(rng.choice(vocabulary, int(rng.integers(1, 200))))
        rows.append((10 + 3 * i, " ".join(words)))
        for c in range(int(rng.integers(0, 3))):  # near copies
            near = list(words)
            near[int(rng.integers(0, len(near)))] = "changed"
            rows.append((11 + 3 * i + c, "  ".join(near).upper()))
    rows += [(5, None), (4, ""), (900, " \n\t"), (None, "one two"), (None, "lonely text here"), (901, "one two"),
             (902, "é\x0bß \x85x"), (902, "é\x0bß \x85x"), (902, "quite another text with the same id"),
             (903, "long " * 5000)]
    return rows


def test_codes_are_perfect():
    for n, weight, cosets in ((23, 3, 2048), (15, 1, 16)):
        _, words, _, counts = S._cosets(n, weight)
        assert len(counts) == cosets and (counts == 1).all() and len(words) == cosets


def test_every_close_pair_meets_at_an_anchor():
    rng = np.random.default_rng(1)
    x = rng.integers(-2**63, 2**63 - 1, 200, dtype=np.int64)
    y = x.copy()
    for i in range(len(y)):
        for bit in rng.choice(64, int(rng.integers(0, 5)), replace=False):
            y[i] ^= np.int64(np.uint64(1 << int(bit)).view(np.int64))
    fx, kx, hx = S.replicate(x, 4)
    fy, ky, _ = S.replicate(y, 4)
    homes = {}
    for f, k in zip(fx[hx].tolist(), kx[hx].tolist()):
        homes.setdefault(f, set()).add(k)
    reach = {}
    for f, k in zip(fy.tolist(), ky.tolist()):
        reach.setdefault(f, set()).add(k)
    assert all(homes[a] & reach[b] for a, b in zip(x.tolist(), y.tolist()))


def test_groups_equal_brute_force(spark):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in rows],
                                 "doc_id bigint, text string, fp int, component_id string").repartition(3)
    got = {}
    found = S.near_duplicates(docs).collect()
    for r in found:
        got.setdefault((r.doc_id, r.fingerprint), set()).add(r.component_id)
    assert len(found) == len(rows) and got == groups(rows)


def test_small_blocks_give_the_same_links(spark):
    fps = np.random.default_rng(5).integers(0, 2**62, 40, dtype=np.int64)
    near = [int(f) ^ (1 << b) for f in fps.tolist()[:10] for b in range(12)]
    df = spark.createDataFrame([(int(f),) for f in {*fps.tolist(), *near}], "fp bigint")
    from tabsieve.llm.common import connected_components, prepare

    prepare(spark)
    both = [sorted(map(tuple, connected_components(S.fingerprint_links(df, 4, block_homes=n)).collect()))
            for n in (4096, 3)]
    assert both[0] == both[1] and len({c for _, c in both[0]}) == 10


def test_keep_one_keeps_one_row_of_each_group(spark):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, "k", "c") for i, t in rows],
                                 "doc_id bigint, text string, fp string, component string")
    kept = S.keep_one(docs).collect()
    comps = groups(rows)
    heads = sorted(doc for (doc, _), comp in comps.items() if doc is not None and doc in comp)  # 902 heads two groups
    assert kept[0].__fields__ == docs.columns
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == heads
    assert [r.text for r in kept if r.doc_id is None] == ["lonely text here"]
    plain = docs.filter("doc_id is not null and doc_id <> 902")
    kept2 = sorted(r.doc_id for r in S.keep_one(plain).collect())
    assert kept2 == sorted({min(c) for c in groups([(i, t) for i, t in rows if i not in (None, 902)]).values()})


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert S.near_duplicates(docs).count() == 0 and S.keep_one(docs).count() == 0
