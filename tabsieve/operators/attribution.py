"""Additive attributions of a model's scores to its features (SHAP values).

For a tree the value of a set of known features is the path-dependent
expectation: where a known feature is split on, the row's own branch is taken;
where an unknown one is, both are, in proportion to the background rows that
pass through them.  A leaf's share of that is a product over the features on its
path, so its Shapley value has a closed form: with o (1 if the row's value stays
on the path, else 0) and z (share of the background that stays) of each feature,

    phi_i = value * (o_i - z_i) * integral over t in [0, 1] of
            product over j != i of (t * o_j + (1 - t) * z_j),

a polynomial in t that Gauss-Legendre nodes integrate exactly.  So a tree is a
table of root-to-leaf paths, and all rows of a batch pass each path at once.
The attributions of a row add up to its score less the base value: in a forest
of probabilities, in boosted trees and the logistic model of log-odds.

The trees go to every task, which makes the paths of one tree at a time, so
neither the driver nor a task holds those of the whole model.  Work is rows x
leaves x features on a path."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import tree_kernel as K
from ..functions.columns import clean_double
from ..session import ensure_checkpoint_dir, shuffle_partitions
from .tree_model import TreeModel

#: Rows that pass the paths at a time.
ROWS = 4096
#: Trees whose attributions one task adds up for its rows.
TREES = 2
#: Numbers (rows x paths x features of a path) held at a time.
PASSED = 1 << 20


@dataclass(frozen=True)
class Path:
    """One leaf: features on its path, the cells that stay on it (above ``low``,
    up to ``high``), the background's share that stays, and the leaf's value."""

    features: tuple[int, ...]
    low: np.ndarray
    high: np.ndarray
    share: np.ndarray
    value: float


def _float_columns(df: DataFrame, features: Sequence[str]) -> list[Column]:
    return [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]


def _values(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return np.stack([batch.column(f"_x{i}").to_numpy(zero_copy_only=False).astype(np.float64) for i in range(width)], axis=1)


def leaf_counts(model: TreeModel, background: DataFrame) -> list[np.ndarray]:
    """Background rows in each leaf, an array for each tree: summed in the tasks, then by Spark."""
    shared = background.sparkSession.sparkContext.broadcast(model)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        totals = [np.zeros(len(t.feature), dtype=np.int64) for t in m.trees]
        for b in batches:
            cells = m.layout.cells(_values(b, len(m.features)))
            for t, total in zip(m.trees, totals):
                total += np.bincount(t.leaf_of(cells), minlength=len(total))
        for i, total in enumerate(totals):
            node = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(node), i), pa.int32()), pa.array(node, pa.int32()),
                                              pa.array(total[node], pa.int64())], ["tree", "node", "n"])

    sums = (background.select(*_float_columns(background, model.features))
            .mapInArrow(count, "tree int, node int, n long").groupBy("tree", "node").agg(F.sum("n").alias("n")))
    out = [np.zeros(len(t.feature), dtype=np.int64) for t in model.trees]
    found = sums.toArrow()  # 16 bytes a leaf at most
    tree, node, n = (found.column(c).to_numpy() for c in ("tree", "node", "n"))
    for i in np.unique(tree):
        out[i][node[tree == i]] = n[tree == i]
    return out


def _covers(tree: K.Tree, counts: dict[int, int]) -> list[int]:
    """Background rows in each node, from those in its leaves."""
    cover = [counts.get(i, 0) if f < 0 else 0 for i, f in enumerate(tree.feature)]
    # children are numbered after their parents
    for i in range(len(cover) - 1, -1, -1):
        if tree.feature[i] >= 0:
            cover[i] = cover[tree.left[i]] + cover[tree.right[i]]
    return cover


def tree_paths(tree: K.Tree, counts: dict[int, int]) -> list[Path]:
    """All root-to-leaf paths of a tree.  A node that no background row reaches
    shares evenly between its children."""
    cover = _covers(tree, counts)
    out: list[Path] = []
    open_nodes: list[tuple[int, dict[int, tuple[float, float, float]]]] = [(0, {})]
    while open_nodes:
        node, met = open_nodes.pop()
        f = tree.feature[node]
        if f < 0:
            on = tuple(sorted(met))
            low, high, share = (np.array([met[j][k] for j in on]) for k in range(3))
            out.append(Path(on, low, high, share, tree.value[node]))
            continue
        low, high, share = met.get(f, (-np.inf, np.inf, 1.0))
        cut = tree.cell[node]
        for child, bounds in ((tree.left[node], (low, min(high, cut))), (tree.right[node], (max(low, cut), high))):
            part = cover[child] / cover[node] if cover[node] else 0.5
            open_nodes.append((child, met | {f: (*bounds, share * part)}))
    return out


def tree_base(tree: K.Tree, counts: dict[int, int]) -> float:
    """The tree's value over the background: that of each leaf by the share that reaches it."""
    cover = _covers(tree, counts)
    reach, total = np.zeros(len(cover)), 0.0
    reach[0] = 1.0
    for node, f in enumerate(tree.feature):
        if f < 0:
            total += tree.value[node] * reach[node]
            continue
        for child in (tree.left[node], tree.right[node]):
            reach[child] = reach[node] * (cover[child] / cover[node] if cover[node] else 0.5)
    return float(total)


def _nodes(n_features: int) -> tuple[np.ndarray, np.ndarray]:
    """Gauss-Legendre nodes on [0, 1], exact for the product over the other features."""
    x, w = np.polynomial.legendre.leggauss(max(1, (n_features + 1) // 2))
    return (x + 1) / 2, w / 2


def path_attributions(cells: np.ndarray, paths: Sequence[Path], n_features: int) -> np.ndarray:
    """(rows, features): what each feature adds to the sum of the paths' trees.
    Paths of as many features pass together, ``PASSED`` numbers at a time."""
    out = np.zeros((len(cells), n_features))
    by_length: dict[int, list[Path]] = {}
    for p in paths:
        if p.features and p.value != 0.0:
            by_length.setdefault(len(p.features), []).append(p)
    for m, alike in by_length.items():
        step = max(1, PASSED // (m * max(1, len(cells))))
        for lo in range(0, len(alike), step):
            some = alike[lo:lo + step]
            on = np.array([p.features for p in some])
            low, high, share = (np.array([getattr(p, c) for p in some]) for c in ("low", "high", "share"))
            c = cells[:, on]  # rows x paths x features of a path
            stays = ((c > low) & (c <= high)).astype(np.float64)
            total = np.zeros(stays.shape)
            for t, w in zip(*_nodes(m)):
                factor = t * stays + (1 - t) * share
                # product of the factors before and after each feature: no division, as a share may be 0
                before, after = np.ones_like(factor), np.ones_like(factor)
                np.cumprod(factor[:, :, :-1], axis=2, out=before[:, :, 1:])
                after[:, :, :-1] = np.cumprod(factor[:, :, :0:-1], axis=2)[:, :, ::-1]
                total += w * before * after
            adds = np.array([p.value for p in some])[:, None] * (stays - share) * total
            at = np.zeros((on.size, n_features))
            at[np.arange(on.size), on.ravel()] = 1.0
            out += adds.reshape(len(cells), -1) @ at
    return out


def _tree_attributions(model: TreeModel, df: DataFrame, background: DataFrame, key: str) -> DataFrame:
    """A task holds the paths of one tree at a time; the rows go to each of
    several chunks of trees, whose parts are added up."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    scale = 1.0 / max(1, len(model.trees)) if model.grow.kind == K.FOREST else 1.0
    start = 0.0 if model.grow.kind == K.FOREST else model.grow.base_margin
    per_tree = leaf_counts(model, background)
    shared = spark.sparkContext.broadcast((model.layout, model.trees, per_tree))
    width, n_trees = len(model.features), len(model.trees)
    key_type = df.schema[key].dataType.simpleString()
    chunks = [list(range(lo, min(lo + TREES, n_trees))) for lo in range(0, n_trees, TREES)] or [[]]

    def of_shared(make, i: int):
        _, trees, counts = shared.value
        return make(trees[i], dict(enumerate(counts[i].tolist())))

    def bases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([of_shared(tree_base, i) for i in ids], pa.float64())],
                ["id", "base"])

    of_tree = {r["id"]: r["base"] for r in spark.range(n_trees, numPartitions=max(1, len(chunks)))
               .mapInArrow(bases, "id long, base double").collect()}  # a number a tree
    base = start + scale * sum(of_tree[i] for i in range(n_trees))

    def attribute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        layout = shared.value[0]
        for b in batches:
            chunk = b.column("_chunk").to_numpy()
            for which in np.unique(chunk):
                mine = b.filter(pa.array(chunk == which))
                cells = layout.cells(_values(mine, width))
                phi = np.zeros((len(cells), width))
                for i in chunks[which]:
                    paths = of_shared(tree_paths, i)
                    for at in range(0, len(cells), ROWS):
                        phi[at:at + ROWS] += path_attributions(cells[at:at + ROWS], paths, width)
                yield pa.RecordBatch.from_arrays([mine.column("_row"), mine.column("_key"), *(pa.array(phi[:, f] * scale) for f in range(width))],
                                                 ["_row", "_key", *(f"_p{f}" for f in range(width))])

    # frozen: the rows' numbers join the parts
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.col(key).alias("_key"), *_float_columns(df, model.features)).checkpoint()
    groups = rows.count() // ROWS + 1  # the paths of a tree are made once for each group of rows
    sent = (rows.withColumns({"_chunk": F.explode(F.array(*[F.lit(i) for i in range(len(chunks))])),
                              "_group": F.pmod(F.xxhash64("_row"), F.lit(groups))})
            .repartition(min(len(chunks) * groups, 4 * max(spark.sparkContext.defaultParallelism, shuffle_partitions(spark))), "_chunk", "_group")
            .sortWithinPartitions("_chunk"))
    schema = f"_row long, _key {key_type}, " + ", ".join(f"_p{f} double" for f in range(width))
    added = (sent.mapInArrow(attribute, schema).groupBy("_row")
             .agg(F.first("_key").alias("_key"), *[F.sum(f"_p{f}").alias(f"_p{f}") for f in range(width)]))
    return added.select("_key", F.array(*[F.col(f"_p{f}") for f in range(width)]).alias("_phi"), F.lit(float(base)).alias("base_value"))


def _linear_attributions(model: PipelineModel, df: DataFrame, background: DataFrame, features: Sequence[str], key: str) -> DataFrame:
    """Coefficient times the distance from the background's mean; a missing value is 0, as in the fit."""
    learner = model.stages[-1]
    x = {f: F.coalesce(clean_double(f), F.lit(0.0)) for f in features}
    means = background.agg(*[F.avg(x[f]).alias(f"_m{i}") for i, f in enumerate(features)]).first()
    b = [float(v) for v in learner.coefficients.toArray()]
    mean = [float(v or 0.0) for v in means]
    base = float(learner.intercept) + sum(c * m for c, m in zip(b, mean))
    return df.select(F.col(key).alias("_key"), F.array(*[F.lit(c) * (x[f] - F.lit(m)) for f, c, m in zip(features, b, mean)]).alias("_phi"),
                     F.lit(base).alias("base_value"))


def shap_values(model: PipelineModel | TreeModel, df: DataFrame, features: Sequence[str], key: str,
                background: DataFrame | None = None) -> DataFrame:
    """``(key, feature, attribution, base_value)``, a row for each row of ``df``
    and feature.  ``background`` (``df`` if not given) sets the expectation.  A
    null or NaN feature is a missing value, as in scoring; rows that share a key
    each give their own rows; an empty table gives none."""
    back = df if background is None else background
    feats = list(features)
    if isinstance(model, TreeModel):
        if feats != list(model.features):
            raise ValueError("features differ from those of the model")
        found = _tree_attributions(model, df, back, key)
    elif hasattr(model.stages[-1], "coefficients"):
        found = _linear_attributions(model, df, back, feats, key)
    else:
        raise TypeError("attributions need a tree model or a logistic model")
    names = F.array(*[F.lit(f) for f in feats])
    return (found.select(F.col("_key").alias(key), F.explode(F.arrays_zip(names.alias("feature"), F.col("_phi").alias("attribution"))).alias("_a"),
                         "base_value")
            .select(key, F.col("_a.feature").alias("feature"), F.col("_a.attribution").alias("attribution"), "base_value"))


def shap_summary(values: DataFrame, top: int | None = None) -> DataFrame:
    """Features by mean absolute attribution: ``(feature, mean_abs, mean, rank)``."""
    agg = values.groupBy("feature").agg(F.avg(F.abs("attribution")).alias("mean_abs"), F.avg("attribution").alias("mean"))
    # one row a feature
    ranked = agg.withColumn("rank", F.row_number().over(Window.orderBy(F.col("mean_abs").desc(), "feature")))
    return ranked.where(F.col("rank") <= top) if top else ranked
