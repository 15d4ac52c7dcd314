import numpy as np
import pyarrow as pa
import pytest

from tabsieve.llm import common


def brute(edges):
    low = {}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for a, b in edges:
        for x in (a, b):
            low.setdefault(x, x)
        a, b = find(a), find(b)
        low[max(a, b)] = min(a, b)
    return {x: find(x) for x in low}


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_union_find(spark, seed):
    rng = np.random.default_rng(seed)
    edges = [tuple(map(int, e)) for e in rng.integers(-60, 60, (70, 2))]
    edges += [(1000 + i, 1001 + i) for i in range(40)] + [(5000, i) for i in range(5001, 5080)]  # path and star
    df = spark.createDataFrame(edges + [(None, 3)], "a bigint, b bigint")
    got = dict(map(tuple, common.connected_components(df).collect()))
    assert got == brute([e for e in edges if e[0] != e[1]])


def test_components_of_nothing(spark):
    assert common.connected_components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_segments_cut_runs_across_batches():
    batches = [pa.RecordBatch.from_pydict({"k": [1, 1, 2], "v": [1, 2, 3]}),
               pa.RecordBatch.from_pydict({"k": pa.array([], pa.int64()), "v": pa.array([], pa.int64())}),
               pa.RecordBatch.from_pydict({"k": [2, 3], "v": [4, 5]})]
    got = [(int(k[0]), b.column("v").to_pylist()) for k, b in common.segments(iter(batches), ["k"])]
    assert got == [(1, [1, 2]), (2, [3]), (2, [4]), (3, [5])]


def test_labelled_sample_is_bounded_and_skips_held_out(spark):
    import zlib

    docs = spark.createDataFrame([(i, f"t{i}", "x") for i in range(200)], "doc_id bigint, text string, y string")
    labels = spark.createDataFrame([(i % 250, i % 2, 9) for i in range(300)] + [(None, 1, 1), (3, None, 1)],
                                   "doc_id bigint, quality int, text int")
    rows = common.labelled_sample(docs, labels, "quality", 3, 1, 20).collect()
    assert len(rows) == 40 and sum(r.y for r in rows) == 20
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 != 1 and r.text == f"t{r.doc_id}" for r in rows)
