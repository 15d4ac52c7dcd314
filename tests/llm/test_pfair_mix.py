import math
from collections import Counter

import pytest

from tabsieve.llm import pfair_mix as P


def key(s):
    return "-" if s is None else "=" + s


def plain_schedule(n, weights, block_rows, period):
    """Slot by slot: earliest deadline first, period after period; and the
    largest distance of a source from its share."""
    left = {s: math.ceil(c / block_rows) for s, c in n.items()}
    total = sum(weights.values())
    rate = {s: max(1, math.floor(weights[s] / total * period + 0.5)) for s in n}
    begun, order, worst = Counter(), [], 0.0
    while sum(left.values()):
        c = {s: min(rate[s], left[s]) for s in n}
        size, done = sum(c.values()), Counter()
        for t in range(size):
            _, _, s = min((-(-(done[s] + 1) * size // c[s]), key(s), s) for s in n
                          if done[s] < c[s] and done[s] * size // c[s] <= t)
            order.append((s, begun[s] + done[s]))
            done[s] += 1
            worst = max(worst, *(abs(done[x] - (t + 1) * c[x] / size) for x in n))
        for s in n:
            left[s] -= c[s]
            begun[s] += c[s]
    return order, worst


@pytest.mark.parametrize("block_rows,period,given", [(4, 20, None), (1, 7, None),
                                                     (3, 30, {"a": 5.0, "b": 1.0, None: 2.0, "gone": 9.0})])
def test_slots_equal_a_plain_scheduler(spark, block_rows, period, given):
    sizes = {"a": 230, "b": 61, "c": 60, "d": 7, None: 33}
    rows = [(100 * k + i if i % 5 else None, f"text {i % 40}", s, "p") for k, (s, n) in enumerate(sizes.items())
            for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, slot string").repartition(4)
    weights = None if given is None else spark.createDataFrame(list(given.items()), "source string, weight double")
    got = P.mix(docs, weights, block_rows=block_rows, period=period).collect()
    assert len(got) == len(rows) and len({r.position for r in got}) == len(rows)
    assert Counter(tuple(r.row) for r in got) == Counter(rows)
    slots = {r.slot: (r.row.source, r.block) for r in got}
    assert Counter(r.slot for r in got).most_common(1)[0][1] <= block_rows
    w = {s: n ** 0.5 for s, n in sizes.items()} if given is None else {s: given.get(s, 0.0) for s in sizes}
    if given is not None:
        w = {s: v for s, v in w.items()}
        total = {**w}
        order, worst = plain_schedule(sizes, total, block_rows, period)
    else:
        order, worst = plain_schedule(sizes, w, block_rows, period)
    assert [slots[i] for i in range(len(slots))] == order and worst < 1


def test_written_files_follow_the_order(spark, tmp_path):
    docs = spark.createDataFrame([(i, "t", f"s{i % 3}") for i in range(300)], "doc_id bigint, text string, source string")
    want = [r.row.doc_id for r in sorted(P.mix(docs, block_rows=5).collect(), key=lambda r: r.position)]
    P.mixed_documents(docs, block_rows=5).write.parquet(str(tmp_path / "out"))
    import pyarrow.parquet as pq

    files = sorted((tmp_path / "out").glob("part-*"))
    assert [x for f in files for x in pq.read_table(f).column("doc_id").to_pylist()] == want


def test_empty_table_and_one_row(spark):
    docs = spark.createDataFrame([(None, None, None)], "doc_id bigint, text string, source string")
    assert [tuple(r) for r in P.mixed_documents(docs).collect()] == [(None, None, None)]
    assert P.mix(docs.limit(0)).count() == 0 and P.mixed_documents(docs.limit(0)).count() == 0


def shares(nb, w, t):
    """Blocks due to each source by slot t: in proportion to w, at most nb."""
    out, live, left = dict.fromkeys(nb, 0.0), set(nb), t
    while live and left > 1e-9:
        v = min(left / sum(w[s] for s in live), min((nb[s] - out[s]) / w[s] for s in live))
        for s in live:
            out[s] += w[s] * v
        left -= v * sum(w[s] for s in live)
        live = {s for s in live if nb[s] - out[s] > 1e-9}
    return out


@pytest.mark.parametrize("sizes,given", [
    ({"hot": 200_000, **{f"s{i:02}": 400_000 // 19 for i in range(19)}}, None),         # 47 times 200 slots, some after all but one ran dry
    ({f"s{i:03}": 64 * (1 + i % 9) for i in range(230)}, {f"s{i:03}": 1.0 + 40 * (i < 3) for i in range(230)}),
    ({"a": 64_000, "b": 640, "c": 6_400}, {"a": 1000.0, "b": 1.0, "c": 90.0}),            # b: far under one block in 400
])
def test_share_holds_over_the_whole_run(spark, sizes, given):
    w = given or {s: n ** 0.5 for s, n in sizes.items()}
    targets = spark.createDataFrame([(s, n, float(w[s])) for s, n in sizes.items()], "src string, n bigint, weight double")
    rows = sorted((r.slot, r.src, r.b) for r in P.block_slots(targets, P.BLOCK_ROWS).collect())
    nb = {s: math.ceil(n / P.BLOCK_ROWS) for s, n in sizes.items()}
    assert [r[0] for r in rows] == list(range(sum(nb.values())))
    done, worst = Counter(), 0.0
    for t, s, b in rows:
        assert b == done[s]
        done[s] += 1
        if t % 7 == 0 or t < 500:
            due = shares(nb, w, t + 1)
            worst = max(worst, *(abs(done[x] - due[x]) for x in nb))
    assert done == nb and worst < 1


def test_default_run_returns_every_row_at_its_own_position(spark):
    rows = [(i, "t", None if i % 3 == 0 else f"s{i % 7}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights = spark.createDataFrame([("s1", 3.0), ("s2", float("nan")), ("s3", -1.0)], "source string, weight double")
    for given in (None, weights):
        got = P.mix(docs, given, block_rows=4).collect()
        assert Counter(tuple(r.row) for r in got) == Counter(rows) and len({r.position for r in got}) == len(rows)


def test_query_mixes_whole_rows(spark):
    from pyspark.sql import functions as F

    from tabsieve.llm.queries import op9_pfair_mix

    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = P.mix(docs).select("row.doc_id", F.xxhash64("row.text"), "position").collect()
    got = op9_pfair_mix(spark, small).select("doc_id", "text_hash", "position").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def plain_run(n, weights, block_rows):
    """The schedule with unrounded weights in fractions, slot by slot: shares grow
    as weight * v up to a source's blocks; of the sources whose share has passed
    their blocks, the one whose next block is due first."""
    from fractions import Fraction
    blocks = {s: math.ceil(c / block_rows) for s, c in n.items()}
    given = {s: Fraction(weights.get(s, 0)) for s in n if weights.get(s, 0) > 0}
    small = sum(given.values()) / P.PERIOD
    w = {s: given.get(s, small) for s in n}
    total, done, order, worst = sum(blocks.values()), Counter(), [], Fraction(0)

    def level(t):
        full, rest = Fraction(t), sorted(n, key=lambda s: blocks[s] / w[s])
        while rest:
            v = full / sum(w[s] for s in rest)
            if w[rest[0]] * v <= blocks[rest[0]]:
                return v
            full -= blocks[rest[0]]
            rest = rest[1:]
        return None
    for t in range(total):
        v = level(t + 1)
        share = {s: min(blocks[s], w[s] * v) if v is not None else blocks[s] for s in n}
        ready = [s for s in n if done[s] < blocks[s] and share[s] - done[s] > Fraction(1, 10 ** 6)]
        s = min(ready, key=lambda s: ((done[s] + 1) / w[s], key(s)))
        order.append((s, done[s]))
        done[s] += 1
        worst = max(worst, *(abs(done[x] - share[x]) for x in n))
    return order, worst


@pytest.mark.parametrize("block_rows, given", [(4, {"a": 5, "b": 1, None: 2, "d": 3}), (1, {"a": 7, "b": 7, "c": 1, None: 3}),
                                               (3, {"a": 1, "d": 16}), (2, {s: 1 for s in ("a", "b", "c", "d", None)})])
def test_unrounded_slots_equal_a_plain_scheduler(spark, monkeypatch, block_rows, given):
    """The path that the query takes (no period), over several stretches."""
    monkeypatch.setattr(P, "STRETCH", 7)
    sizes = {"a": 130, "b": 61, "c": 60, "d": 7, None: 33}
    rows = [(100 * k + i, f"text {i % 40}", s) for k, (s, n) in enumerate(sizes.items()) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    weights = spark.createDataFrame([(s, float(w)) for s, w in given.items()], "source string, weight double")
    got = P.mix(docs, weights, block_rows=block_rows, period=None).collect()
    slots = {r.slot: (r.row.source, r.block) for r in got}
    order, worst = plain_run(sizes, given, block_rows)
    assert worst < 1 and [slots[i] for i in range(len(slots))] == order
