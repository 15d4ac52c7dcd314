import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken

from tabsieve.llm import chunked_bpe as C

RANKS = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=C.load_ranks(RANKS), special_tokens={})


def fixture():
    rng = random.Random(5)
    alphabet = ["a", "b", " ", "\n", "  ", "1", "'s", "é", "!", "\t", " \n", "xyzzy", "漢字", "😀", "'ll"]
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 300)))) for i in range(120)]
    return rows + [(None, None), (None, "x " * 200), (3, ""), (7, "a" * 500), (8, " " * 500 + "b"),
                   (9, ("a" * 150 + " b ") * 6), (10, "q w e " * 90), (10, "q w e " * 90), (11, "<|endoftext|>")]


@pytest.mark.parametrize("chunk,overlap", [(50, 12), (37, 3), (32768, 1024)])
def test_ids_equal_the_library(spark, library, chunk, overlap):
    rows = fixture()
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id bigint, text string, ids string")
    coded = C.encode(docs, RANKS, P.PATTERN, chunk, overlap)
    got = sorted((-1 if r[0] is None else r[0], *r[1:]) for r in C.digest(coded, RANKS, P.PATTERN).collect())
    want = []
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want.append((-1 if i is None else i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want)


def test_decoding_gives_the_bytes_back(spark):
    docs = spark.createDataFrame([(1, "Ünïcode 漢 text\n"), (2, None)], "doc_id bigint, text string")
    back = {r[0]: bytes(r[1]) for r in C.decode(C.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).collect()}
    assert back == {1: "Ünïcode 漢 text\n".encode(), 2: b""}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert C.digest(C.encode(docs, RANKS, P.PATTERN), RANKS, P.PATTERN).count() == 0


@pytest.mark.parametrize("chunk,overlap", [(50, 12), (32768, 1024)])
def test_digests_made_with_the_ids_are_the_same(spark, chunk, overlap):
    docs = spark.createDataFrame(fixture(), "doc_id bigint, text string")
    want = C.digest(C.encode(docs, RANKS, P.PATTERN, chunk, overlap), RANKS, P.PATTERN)
    got = C.encode_digest(docs, RANKS, P.PATTERN, chunk, overlap)
    assert got.schema == want.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_task_of_the_last_stage_keeps_one_python_worker(spark):
    """A Python step that feeds another without a shuffle between them keeps
    two workers a task, each with a vocabulary."""
    import corpus_pipeline

    docs = spark.createDataFrame(fixture(), "doc_id bigint, text string")
    plan = corpus_pipeline.tokens(spark, docs, "")._jdf.queryExecution().executedPlan().toString().split("\n")
    steps = [i for i, line in enumerate(plan) if "MapInArrow" in line]
    assert len(steps) >= 4
    for i in steps:
        below = next((x for x in plan[i + 1:] if any(k in x for k in ("MapInArrow", "Exchange", "Scan"))), "")
        assert "MapInArrow" not in below or below.index("MapInArrow") <= plan[i].index("MapInArrow")


def test_remembered_pieces_are_packed(spark):
    enc = C.PieceEncoder(RANKS, P.PATTERN)
    pieces = ["tabsieve", " xyzzy", "漢字", " " * 70]
    coded = enc.coded(pieces + pieces)
    assert coded == np.array(2 * [i for p in pieces for i in enc.encoding.encode_ordinary(p)], dtype="<u4").tobytes()
    assert set(enc.cache) == set(pieces[:3]) and all(type(v) is bytes for v in enc.cache.values())
