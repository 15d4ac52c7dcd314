"""Shared pieces of the operators: table reading, label splits, bounded
samples, row streams for grouped Arrow batches and connected components."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabsieve.session import ensure_checkpoint_dir

#: Documents are turned into Python strings this many rows at a time.
SLICE_ROWS = 256


_shipped: set[str] = set()


def prepare(spark: SparkSession) -> str:
    """Set the checkpoint folder and give the Python workers this package (once
    per application), so a job needs no installation on the executors.
    Returns the checkpoint folder."""
    folder = ensure_checkpoint_dir(spark)
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        top = Path(__file__).resolve().parents[1]
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="tabsieve-ship-")), "tabsieve.zip")
        with zipfile.ZipFile(target, "w") as z:
            for p in sorted(top.rglob("*.py")):
                z.write(p, str(p.relative_to(top.parent)))
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
    return folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc_mod(doc_id: Column, mod: int) -> Column:
    """crc32(doc_id as text) mod ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % mod


def text_slices(batch: pa.RecordBatch, rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, rows):
        yield batch.slice(at, rows)


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """Python strings of a column, null as empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def bounded_sample(df: DataFrame, label: str, per_class: int, key: str = "doc_id") -> DataFrame:
    """At most ``per_class`` rows of label 0 and of label 1: those with the
    smallest hash of the key, so the choice does not depend on partitioning."""
    order = [F.xxhash64(F.col(key)), F.col(key)]
    parts = [df.filter(F.col(label) == v).orderBy(*order).limit(per_class) for v in (0, 1)]
    return parts[0].unionByName(parts[1])


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, mod: int, held_out: int,
                    per_class: int) -> DataFrame:
    """Rows (doc_id, text, y) to learn from: documents whose id falls outside
    the held-out remainder, at most ``per_class`` of each label value.

    ``labels`` may repeat an id (the smaller value counts) and hold nulls
    (left out).  The chosen ids are at most 2 * per_class and are broadcast."""
    y = (labels.select("doc_id", F.col(label).cast("int").alias("y"))
         .filter("doc_id is not null and y in (0, 1)")
         .filter(id_crc_mod(F.col("doc_id"), mod) != held_out)
         .groupBy("doc_id").agg(F.min("y").alias("y")))
    have = docs.select("doc_id").distinct()
    chosen = bounded_sample(y.join(have, "doc_id", "left_semi"), "y", per_class)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def segments(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
    """Cut a stream of batches sorted by ``keys`` into runs of equal keys, each
    within one batch; nothing is gathered beyond the batch at hand."""
    import numpy as np

    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(batch.schema.get_field_index(k)).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows - 1, dtype=bool)
        for c in cols:
            change |= c[1:] != c[:-1]
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), batch.num_rows]
        for lo, hi in zip(cuts[:-1], cuts[1:]):
            yield tuple(c[lo] for c in cols), batch.slice(lo, hi - lo)


#: A key with more than one in so many rows is joined by broadcast.
HOT_SHARE = 1_000


def join_facts(rows: DataFrame, facts: DataFrame, key: str) -> DataFrame:
    """``rows`` with the columns of ``facts`` (one row a key), joined so that no
    task gets all rows of a key that many rows share: such keys, at most
    ``HOT_SHARE`` of them, meet their facts by broadcast, others by shuffle.
    Both inputs are read more than once and should be written tables."""
    counts = rows.groupBy(key).agg(F.count("*").alias("_n")).checkpoint()
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = counts.filter(F.col("_n") > max(1, total // HOT_SHARE)).select(key)
    often = rows.join(F.broadcast(facts.join(F.broadcast(hot), key, "left_semi")), key)
    return often.unionByName(rows.join(F.broadcast(hot), key, "left_anti").join(facts, key))


class LocalForest:
    """Union-find over row numbers 0..n-1 of one task's bounded block."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge table, component = smallest
    node reachable.  Alternating large-star and small-star rounds: each round
    is two aggregations and joins over the edges, written to the checkpoint
    folder; neither edges nor components come to the driver.  Hub nodes are
    handled by partial aggregation and adaptive skew joins.  Rows with a null
    end or equal ends are no edges."""
    prepare(edges.sparkSession)
    pairs = (edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
             .filter(f"{a} is not null and {b} is not null and {a} <> {b}").distinct().checkpoint())

    def signature(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())

    before = signature(pairs)
    if before[0]:
        for _ in range(max_rounds):
            both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
            low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
            large = (both.filter("v > u").join(low, "u").filter("v <> m")
                     .select(F.col("v").alias("u"), F.col("m").alias("v")))
            large = large.distinct()
            small_low = large.groupBy("u").agg(F.min("v").alias("m"))
            small = (large.join(small_low, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                     .unionByName(small_low.select("u", F.col("m").alias("v"))).distinct())
            pairs = small.checkpoint()
            now = signature(pairs)
            if now == before:
                break
            before = now
        else:
            raise RuntimeError(f"connected components did not settle in {max_rounds} rounds")
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
