"""Exact k nearest neighbours of all rows, and oversampling along them (SMOTE).

Equal points are one vector before the join.  Pivots (vectors spread by hash)
cut the space into cells by the nearest pivot.  From each cell's radius and its
k + 1 members nearest to the pivot follows a bound on the distance from any
member of a cell to its k-th neighbour; a vector goes to a cell only if the
triangle inequality, or its distance to the bisector of the two pivots, leaves it
within that bound.  Each cell is then joined alone: blocks of its members, to
which the candidates stream, keep their k best, and the k-th best so far is the
radius that shrinks as the stream passes.  No pairs leave a task but the k best
of each member."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import BEFORE, GROUP_TOTAL, running_counts
from ..session import ensure_checkpoint_dir, shuffle_partitions
from .split import order_hash

CELL_ROWS = 2048
BLOCK_ROWS = 2048
#: Pivots at most: they go to every task.  Beyond, cells grow and have more blocks.
MAX_PIVOTS = 2048
#: Differences that a task holds at a time.
DIFFERENCES = 1 << 22
#: A vector with more than one in so many rows meets its copies by broadcast.
HOT_SHARE = 1_000


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x to all of y."""
    total = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        total += (x[:, i][:, None] - y[:, i][None, :]) ** 2
    return total


@dataclass(frozen=True)
class Cells:
    """Pivots with, for each cell, its radius, its members' bound on the k-th
    neighbour and its number of blocks (0: no members)."""

    pivots: np.ndarray
    radius: np.ndarray
    bound: np.ndarray
    blocks: np.ndarray


def _home(pivots: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                sq = _distances(_matrix(part.column("vec")), pivots)
                home = sq.argmin(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(home.astype(np.int32)), pa.array(np.sqrt(sq[np.arange(len(sq)), home])), part.column("vid"), part.column("vec")],
                    ["cell", "dist", "vid", "vec"])
    return run


def _cells(homes: DataFrame, pivots: np.ndarray, k: int, block_rows: int) -> Cells:
    """From at most k + 1 rows a cell."""
    near = Window.partitionBy("cell").orderBy("dist", "vid")
    low = homes.select("cell", "dist", "vid").withColumn("_r", F.row_number().over(near)).where(F.col("_r") <= k + 1).collect()
    facts = homes.groupBy("cell").agg(F.max("dist").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    m = len(pivots)
    radius, blocks, bound = np.zeros(m), np.zeros(m, dtype=np.int64), np.full(m, np.inf)
    for r in facts:
        radius[r["cell"]], blocks[r["cell"]] = r["radius"], math.ceil(r["n"] / block_rows)
    of, dist = np.array([r["cell"] for r in low], dtype=int), np.array([r["dist"] for r in low])
    gaps = np.sqrt(_distances(pivots, pivots))
    if len(of) > k:
        for i in np.flatnonzero(blocks):
            bound[i] = np.partition(radius[i] + gaps[i, of] + dist, k)[k]  # one of them is the member itself
    return Cells(pivots, radius, bound, blocks)


def _spread(cells: Cells):
    """Rows (cell, block, stream, vid, vec): each vector as a member, and as a
    candidate for the blocks of every cell that may need it."""
    gaps = np.sqrt(_distances(cells.pivots, cells.pivots))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 1024):
                part = b.slice(at, 1024)
                sq = _distances(_matrix(part.column("vec")), cells.pivots)
                d, home = np.sqrt(sq), part.column("cell").to_numpy()
                limit = cells.bound * (1 + 1e-9) + 1e-9
                slack = 1e-9 * (1 + cells.radius)
                own = sq[np.arange(len(sq)), home][:, None]
                near = (d - cells.radius - slack <= limit) & (cells.blocks > 0)
                near &= sq - own <= 2 * gaps[home] * limit + 1e-9 * (1 + sq)
                near[np.arange(len(sq)), home] = True
                row, cell = np.nonzero(near)
                many = cells.blocks[cell]
                row, cell = np.repeat(row, many), np.repeat(cell, many)
                block = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
                vid = part.column("vid").to_numpy()
                for stream, r, c, k in ((0, np.arange(len(sq)), home, vid % cells.blocks[home]), (1, row, cell, block)):
                    take = pa.array(r)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c.astype(np.int32)), pa.array(k.astype(np.int32)), pa.array(np.full(len(r), stream), pa.int32()),
                         part.column("vid").take(take), part.column("vec").take(take)], ["cell", "block", "stream", "vid", "vec"])
    return run


def _first_of(sq: np.ndarray, other: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k first entries of each row by (sq, other).  Only those up to the
    row's k-th smallest ``sq`` are put in order."""
    row, at = np.nonzero(sq <= np.partition(sq, k - 1, axis=1)[:, k - 1:k])
    near, who = sq[row, at], other[row, at]
    order = np.lexsort((who, near, row))
    size = np.bincount(row, minlength=len(sq))
    take = order[((np.cumsum(size) - size)[:, None] + np.arange(k)).ravel()]
    return near[take].reshape(-1, k), who[take].reshape(-1, k)


def _keep_best(k: int):
    """Streams rows sorted by (cell, block, stream); yields the k best (vid,
    other, sq) of each member."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.RecordBatch]]:
        for b in batches:
            if not b.num_rows:
                continue
            ids = np.stack([b.column(c).to_numpy() for c in ("cell", "block", "stream")], axis=1)
            cuts = [0, *(np.flatnonzero((ids[1:] != ids[:-1]).any(axis=1)) + 1).tolist(), b.num_rows]
            for lo, hi in zip(cuts, cuts[1:]):
                yield tuple(ids[lo]), b.slice(lo, hi - lo)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, held, state = None, [], None

        def start():
            vid = np.concatenate([p.column("vid").to_numpy() for p in held])
            return {"vid": vid, "x": np.concatenate([_matrix(p.column("vec")) for p in held]),
                    "sq": np.full((len(vid), k), np.inf), "other": np.full((len(vid), k), -1, dtype=np.int64)}

        def close():
            if state is None:
                return
            member, place = np.nonzero(np.isfinite(state["sq"]))
            yield pa.RecordBatch.from_arrays([pa.array(state["vid"][member]), pa.array(state["other"][member, place]),
                                              pa.array(state["sq"][member, place])], ["vid", "other", "sq"])

        for (cell, block, stream), part in runs(batches):
            if (cell, block) != unit:
                yield from close()
                unit, held, state = (cell, block), [], None
            if not stream:
                held.append(part)
                continue
            if not held:  # no member's number falls to this block
                continue
            if state is None:
                state = start()
            step = max(1, DIFFERENCES // max(1, state["x"].size))
            for at in range(0, part.num_rows, step):
                piece = part.slice(at, step)
                ids = piece.column("vid").to_numpy()
                sq = _distances(state["x"], _matrix(piece.column("vec")))
                sq[state["vid"][:, None] == ids[None, :]] = np.inf
                hit = np.flatnonzero((sq <= state["sq"][:, -1:]).any(axis=1))
                if len(hit):
                    state["sq"][hit], state["other"][hit] = _first_of(
                        np.concatenate([state["sq"][hit], sq[hit]], axis=1),
                        np.concatenate([state["other"][hit], np.broadcast_to(ids, (len(hit), len(ids)))], axis=1), k)
        yield from close()
    return run


def nearest_neighbours(df: DataFrame, key: str, features: Sequence[str], k: int = 5, cell_rows: int = CELL_ROWS,
                       block_rows: int = BLOCK_ROWS, max_pivots: int = MAX_PIVOTS) -> DataFrame:
    """``(key, neighbour, distance, place)``: the ``k`` nearest other rows of
    each row by Euclidean distance over ``features``, ties by the smaller key.
    ``key`` must be unique and not null.  Rows with a missing or infinite feature
    neither have neighbours nor are any; fewer than k others give fewer rows."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = df.select(F.col(key).alias("key"), F.array(*[F.col(f).cast("double") + F.lit(0.0) for f in features]).alias("vec")).where(~bad).checkpoint()
    total = rows.count()
    # the k + 1 first keys of each vector; Spark limits each group before the shuffle
    first = rows.withColumn("_r", F.row_number().over(Window.partitionBy("vec").orderBy("key"))).where(F.col("_r") <= k + 1)
    vectors = (first.groupBy("vec").agg(F.sort_array(F.collect_list("key")).alias("keys"))
               .withColumns({"low": F.col("keys")[0], "_one": F.lit(1)}))
    # numbered in the order of their first keys, so that ties go by the key
    vectors = (running_counts(vectors, [], ["low"], "_one").withColumnRenamed(BEFORE, "vid").drop("_one", "low", GROUP_TOTAL).checkpoint())
    n = vectors.count()
    chosen = vectors.orderBy(F.xxhash64("vec"), "vid").limit(min(max_pivots, max(1, math.ceil(n / cell_rows)))).select("vec").collect()
    if not chosen:
        return df.select(F.col(key), F.col(key).alias("neighbour"), F.lit(0.0).alias("distance"), F.lit(1).alias("place")).limit(0)
    pivots = np.array([r["vec"] for r in chosen], dtype=np.float64)
    homes = vectors.select("vid", "vec").mapInArrow(_home(pivots), "cell int, dist double, vid bigint, vec array<double>").checkpoint()
    cells = _cells(homes, pivots, k, block_rows)
    spread = homes.mapInArrow(_spread(cells), "cell int, block int, stream int, vid bigint, vec array<double>")
    parts = max(shuffle_partitions(spark), int(cells.blocks.sum()))
    best = (spread.repartition(parts, "cell", "block").sortWithinPartitions("cell", "block", "stream")
            .mapInArrow(_keep_best(k), "vid bigint, other bigint, sq double"))
    offers = (best.join(vectors.select(F.col("vid").alias("other"), "keys"), "other")
              .select("vid", "sq", F.explode(F.slice("keys", 1, k)).alias("key"))
              .unionByName(vectors.select("vid", F.lit(0.0).alias("sq"), F.explode("keys").alias("key"))))
    # at most k * k + k + 1 entries a vector, k + 1 of them kept
    lists = offers.groupBy("vid").agg(F.slice(F.sort_array(F.collect_list(F.struct("sq", "key"))), 1, k + 1).alias("near"))
    known = vectors.select("vid", "vec").join(lists, "vid").select("vec", "near").checkpoint()
    # a vector with very many copies meets them by broadcast
    hot = rows.groupBy("vec").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > max(1, total // HOT_SHARE)).select("vec").checkpoint()
    often = rows.join(F.broadcast(known.join(F.broadcast(hot), "vec", "left_semi")), "vec")
    found = often.unionByName(rows.join(F.broadcast(hot), "vec", "left_anti").join(known, "vec"))
    others = F.slice(F.filter("near", lambda x: x["key"] != F.col("key")), 1, k)
    return (found.select("key", F.posexplode(others).alias("_place", "_near"))
            .select(F.col("key").alias(key), F.col("_near.key").alias("neighbour"), F.sqrt("_near.sq").alias("distance"),
                    (F.col("_place") + 1).cast("int").alias("place")))


# ----------------------------------------------------------------- oversampling

def _draw(key: Column, copy: Column, tag: str, seed: int) -> Column:
    """32 bits from the hash of a row's key and the number of its copy."""
    text = F.concat_ws("/", key.cast("string"), copy.cast("string"), F.lit(tag), F.lit(str(seed)))
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def smote(df: DataFrame, features: Sequence[str], label: str, key: str, k: int = 5, seed: int = 42) -> DataFrame:
    """``df`` with new rows that bring every class to the size of the largest.

    A new row lies on the line from a row of its class to one of that row's k
    nearest of the class, at a place drawn by hash.  All rows of a class serve as
    base equally often, to within one; those of ``md5(key || seed)`` order first.
    Columns: key (null in new rows), label, the features as doubles,
    ``synthetic``, ``base`` (key of the base row) and ``copy`` (its number).
    Rows with a missing or infinite feature stay but are no base; a class of one
    row is copied; rows without a label stay and count for no class.  One
    neighbour join a class: meant for labels of few classes."""
    ensure_checkpoint_dir(df.sparkSession)
    feats = list(features)
    own = df.select(key, label, *[F.col(f).cast("double").alias(f) for f in feats])
    key_type = own.schema[key].dataType
    out = own.withColumns({"synthetic": F.lit(False), "base": F.lit(None).cast(key_type), "copy": F.lit(None).cast("int")})
    counts = {r[0]: r[1] for r in own.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1))).collect()}
    most = max(counts.values(), default=0)
    for c in sorted(counts):
        need = most - counts[c]
        if not need:
            continue
        bad = F.lit(False)
        for f in feats:
            bad = bad | F.col(f).isNull() | F.isnan(f) | (F.abs(F.col(f)) == float("inf"))
        points = own.where((F.col(label) == F.lit(c)) & ~bad).select(F.col(key).alias("base"), *feats)
        ranked = running_counts(points.withColumns({"_h": order_hash("base", seed), "_one": F.lit(1)}), [], ["_h", "base"], "_one").checkpoint()
        n = ranked.count()
        if not n:
            continue
        near = (nearest_neighbours(points, "base", feats, k).groupBy("base")
                .agg(F.transform(F.sort_array(F.collect_list(F.struct("place", "neighbour"))), lambda x: x["neighbour"]).alias("_near")))
        copies = F.lit(need // n) + (F.col(BEFORE) < F.lit(need % n)).cast("int")
        drawn = (ranked.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), copies.cast("int"))))
                 .join(near, "base", "left")
                 .withColumn("_n", F.when(F.size("_near") > 0, F.element_at("_near", (_draw(F.col("base"), F.col("copy"), "neighbour", seed)
                                                                                   % F.size("_near") + 1).cast("int")))))
        ends = points.select(F.col("base").alias("_n"), *[F.col(f).alias(f"_to_{f}") for f in feats])
        gap = _draw(F.col("base"), F.col("copy"), "gap", seed) / F.lit(float(2 ** 32))
        made = drawn.join(ends, "_n", "left").select(
            F.lit(None).cast(key_type).alias(key), F.lit(c).cast(own.schema[label].dataType).alias(label),
            *[(F.col(f) + gap * (F.coalesce(F.col(f"_to_{f}"), F.col(f)) - F.col(f))).alias(f) for f in feats],
            F.lit(True).alias("synthetic"), "base", F.col("copy").cast("int").alias("copy"))
        out = out.unionByName(made)
    return out
