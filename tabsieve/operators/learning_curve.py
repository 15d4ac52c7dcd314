"""Learning curve: how the scores of learners change with the training rows.

The sizes are nested: a class's rows are ranked once by ``md5(key || seed)`` and
a size takes the first of them, so each subset holds the smaller ones and keeps
the class shares.  A row carries the first size that takes it, and a model of one
size gives weight zero to the rows of later ones.  So all sizes and learners are
fitted side by side over one binned table and scored together.  Tree models stay
in the checkpoint folder and pass the driver a few trees at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import tree_kernel as K
from ..functions.ranks import checked_broadcast
from ..session import ensure_checkpoint_dir
from . import many_fits as mf
from . import metrics as mt
from .logistic_path import LogisticUnit, fit_path, matrix_table
from .split import RANK, class_ranks
from .train import Spec, _settings

FRACTIONS = (0.1, 0.325, 0.55, 0.775, 1.0)
STAGE = "_stage"


def nested_stages(df: DataFrame, key: str, label: str, fractions: Sequence[float] = FRACTIONS, seed: int = 42) -> DataFrame:
    """``df`` (rows with a label) with ``_stage``: the place in ``fractions``
    (ascending) of the first that takes the row, or their number if none does.
    Each takes ``round(fraction * n)`` rows of a class of n, at least one."""
    if list(fractions) != sorted(set(fractions)) or not all(0 < f <= 1 for f in fractions):
        raise ValueError("fractions must rise within (0, 1]")
    rows = df.where(F.col(label).isNotNull())
    counts = rows.groupBy(F.col(label).alias("_label")).agg(F.count(F.lit(1)).alias("_n"))
    ranked = class_ranks(rows, key, label, seed)
    ranked = ranked.join(checked_broadcast(counts), F.col(label) == F.col("_label"))
    stage = F.lit(len(fractions))
    for s, f in reversed(list(enumerate(fractions))):
        stage = F.when(F.col(RANK) < F.greatest(F.lit(1), F.round(F.col("_n") * F.lit(float(f))).cast("bigint")), F.lit(s)).otherwise(stage)
    return ranked.withColumn(STAGE, stage.cast("int")).drop("_n", "_label", RANK)


_SCORED = "unit int, label int, prediction int, probability double"


def _line_scores(models: list[tuple[int, int, np.ndarray]], df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """(unit, label, prediction, probability) of the rows that each logistic
    model's size takes."""
    shared = df.sparkSession.sparkContext.broadcast(models)
    names = [f"_x{i}" for i in range(len(features))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names], axis=1)
            stage = b.column(STAGE).to_numpy()
            for unit, upto, beta in shared.value:
                at = np.flatnonzero(stage <= upto)
                p = K.sigmoid(np.clip(np.nan_to_num(x[at], nan=0.0) @ beta[1:] + beta[0], -500, 500))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), unit), pa.int32()), b.column("label").take(pa.array(at)),
                     pa.array((p > 0.5).astype(np.int32)), pa.array(p)], ["unit", "label", "prediction", "probability"])

    return (df.select(F.col(label).cast("int").alias("label"), STAGE, *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
            .mapInArrow(run, _SCORED))


def _cells_of(df: DataFrame, features: Sequence[str], label: str, layout: K.Layout) -> DataFrame:
    """(label, stage, split, cells) of every row."""
    names = [f"_x{i}" for i in range(len(features))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = np.stack([b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in names], axis=1)
            yield pa.RecordBatch.from_arrays(
                [*(b.column(c) for c in ("label", STAGE, "split")), pa.array([r.tobytes() for r in layout.cells(x)], pa.binary())],
                ["label", STAGE, "split", "cells"])

    return (df.select(F.col(label).cast("int").alias("label"), STAGE, "split", *[F.col(f).cast("double").alias(n) for f, n in zip(features, names)])
            .mapInArrow(run, f"label int, {STAGE} int, split string, cells binary"))


def _tree_scores(rows: DataFrame, grown: Sequence[mf.Grown], units: Sequence[mf.Unit], width: int) -> DataFrame:
    """(split, unit, label, prediction, probability) of the rows of
    :func:`_cells_of` that each tree model's size takes.  Rows of the same cells
    are predicted once."""
    rows = rows.checkpoint()
    known = mf.score_units(rows, grown, units, width)
    upto = F.array(*[F.lit(u.upto) for u in units])
    return (rows.join(known, "cells").select("split", "label", STAGE, F.posexplode("probability").alias("unit", "probability"))
            .where(F.col(STAGE) <= upto[F.col("unit")])
            .select("split", "unit", "label", (F.col("probability") > 0.5).cast("int").alias("prediction"), "probability"))


def learning_curve(specs: Sequence[Spec], train: DataFrame, val: DataFrame, features: Sequence[str], label: str, key: str,
                   fractions: Sequence[float] = FRACTIONS, metrics: Sequence[str] = ("f1_score",), seed: int = 42,
                   handover: int = mf.HANDOVER_ROWS) -> DataFrame:
    """``(spec, model_name, fraction, n_rows, split, metric, value)``: the
    learners of ``specs`` (name, parameters) fitted on each nested part of
    ``train``, scored on that part (split ``train``) and on ``val``.  ``key``
    must be unique; rows without a label are left out."""
    spark = train.sparkSession
    ensure_checkpoint_dir(spark)
    feats, sizes = list(features), range(len(fractions))
    settings = [_settings(n, p) for n, p in specs]
    staged = nested_stages(train, key, label, fractions, seed).select(key, label, STAGE, *feats).checkpoint()
    # sizes x classes rows
    per = {(r[STAGE], r["y"]): r["n"] for r in staged.groupBy(STAGE, F.col(label).cast("int").alias("y"))
           .agg(F.count(F.lit(1)).alias("n")).collect()}
    counts = {s: tuple(sum(n for (stage, y), n in per.items() if stage <= s and y == c) for c in (0, 1)) for s in sizes}
    number: list[tuple[int, str, float, int]] = []
    parts = {"train": staged, "val": val.where(F.col(label).isNotNull()).withColumn(STAGE, F.lit(0))}
    scored = None

    def facts(i: int, s: int) -> tuple[int, str, float, int]:
        return i, specs[i][0], float(fractions[s]), sum(counts[s])

    trees = [i for i, (n, _) in enumerate(specs) if n != "logistic_regression"]
    if trees:
        layout = mf.layout_of(staged, feats)
        table = mf.bin_table(staged, feats, label, key, layout, STAGE)
        of = [(i, s) for i in trees for s in sizes]
        units = [mf.Unit(mf.make_grow(specs[i][0], settings[i], counts[s], len(feats), seed), None, s) for i, s in of]
        grown, _ = mf.grow_units(table, units, layout, handover)
        rows = [_cells_of(df.withColumn("split", F.lit(part)), feats, label, layout) for part, df in parts.items()]
        scored = _tree_scores(rows[0].unionByName(rows[1]), grown, units, len(feats))
        number += [facts(i, s) for i, s in of]
    lines = [i for i, (n, _) in enumerate(specs) if n == "logistic_regression"]
    if lines:
        of = [(i, s) for i in lines for s in sizes]
        units = []
        for i, s in of:
            w = tuple(sum(counts[s]) / (2 * max(n, 1)) if settings[i]["class_weight"] == "balanced" else 1.0 for n in counts[s])
            units.append(LogisticUnit(float(settings[i]["C"]), settings[i]["penalty"], None, w, int(settings[i]["max_iter"]), s))
        betas = fit_path(matrix_table(staged, feats, label, STAGE), units, len(feats))
        models = [(len(number) + u, s, beta) for u, ((_, s), beta) in enumerate(zip(of, betas))]
        number += [facts(i, s) for i, s in of]
        for part, df in parts.items():
            found = _line_scores(models, df, feats, label).withColumn("split", F.lit(part))
            scored = found if scored is None else scored.unionByName(found)
    names = spark.createDataFrame([(u, *f) for u, f in enumerate(number)],
                                  "unit int, spec int, model_name string, fraction double, n_rows long")
    long = mt.metrics_long(scored, ["unit", "split"], list(metrics))
    return long.join(F.broadcast(names), "unit").select("spec", "model_name", "fraction", "n_rows", "split", "metric", "value")
