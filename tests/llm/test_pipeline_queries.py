import hashlib
import os
import subprocess
import sys

import public_tokenizers as P
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from tabsieve.llm import chunked_bpe, quality_gam, secrets_forest, simhash_anchor

SMALL = "/root/testdata/sf0.001"


def test_stages_and_queries_are_registered():
    names = entry.queries()
    assert {f"op{n}_" for n in range(1, 14)} == {k.split("_")[0] + "_" for k in names if k.startswith("op")}
    assert "pipeline" in names and len(corpus_pipeline.STAGES) == 5


def test_pipeline_equals_its_stages_by_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    score = {r.doc_id: r.score for r in quality_gam.score(docs, quality_gam.train(docs, labels)).collect()}
    good = {r.doc_id: r.text for r in docs.collect() if score[r.doc_id] >= 0.5}
    ids = sorted(good)
    fp = {i: simhash_anchor.simhash(good[i]) for i in ids}
    low = {i: i for i in ids}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x
    for i in ids:
        for j in ids:
            if j < i and bin(fp[i] ^ fp[j]).count("1") <= 4:
                a, b = find(i), find(j)
                low[max(a, b)] = min(a, b)
    kept = [i for i in ids if find(i) == i]
    one = docs.filter(docs.doc_id.isin(kept))
    secrets = {}
    for r in secrets_forest.scan(one).filter("predicted = 1").collect():
        secrets.setdefault(r.doc_id, set()).add(r.candidate)
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                            mergeable_ranks=chunked_bpe.load_ranks(P.path("byte_bpe_50k.tiktoken")))
    want = []
    for i in kept:
        text = good[i]
        for s in sorted(secrets.get(i, ()), key=len, reverse=True):
            text = text.replace(s, "[SECRET]")
        got = enc.encode_ordinary(text)
        want.append((i, len(got), hashlib.sha256(" ".join(map(str, got)).encode()).hexdigest(),
                     hashlib.sha256(text.encode()).hexdigest()))
    assert sorted(map(tuple, corpus_pipeline.run(spark, SMALL).collect())) == want


def test_stages_keep_odd_rows_whole(spark):
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (2, "", "en", "s", 0), (None, "no id here", "en", None, 3),
            (4, "password=0123456789abcdef01 " + "w " * 30_000, "en", "s", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        if name in ("secret_scan", "source_mixing"):
            assert out.count() == len(rows)
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SMALL).count() == 0, name


def test_entry_works_without_the_subpackage(tmp_path):
    import shutil

    top = os.path.dirname(os.path.abspath(entry.__file__))
    shutil.copytree(os.path.join(top, "tabsieve"), tmp_path / "tabsieve",
                    ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(top, "__spark_entry__.py"), tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [k for k in q if k.startswith('op')], q"
    assert subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": str(tmp_path)},
                          timeout=120).returncode == 0
