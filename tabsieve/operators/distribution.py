"""The numbers behind the reference's plots (D1-D8): histograms, density
curves, category counts, box statistics, correlation matrices.  Drawing is
left to the caller; every function returns a DataFrame."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import COLUMN, VALUE, clean_double, numeric_columns, to_long
from ..functions.ranks import BYTES_PER_CELL, MAX_BROADCAST_BYTES, quantile_table, running_sums, value_ranks
from ..session import ensure_checkpoint_dir, shuffle_partitions
from .profile import target_distribution, value_counts_long

# Density grid size and how far the grid reaches past the data
# (in bandwidths).
KDE_GRID = 200
KDE_CUT = 3.0
BOX_WHIS = 1.5
# Bins a histogram may have unless the caller allows more.
MAX_BINS = 1_000_000
# Bandwidths beyond which the Gaussian kernel is 0 in double precision.
KERNEL_REACH = 39.0


def _integer_cols(df: DataFrame) -> set[str]:
    return {f.name for f in df.schema.fields
            if isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}


def histogram_params(df: DataFrame, cols: Sequence[str], max_bins: int = MAX_BINS) -> DataFrame:
    """Per column: n, min, max, quartiles and the automatic bin count
    (min of Freedman-Diaconis and Sturges widths; integer columns at least 1
    wide).  One small row per column.  More than ``max_bins`` bins (far
    outliers beside a narrow bulk) are an error that names the column."""
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    mm = long.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("n"), F.min(VALUE).alias("min"),
                                  F.max(VALUE).alias("max"))
    q = quantile_table(df, cols, [0.25, 0.75], ["q1", "q3"])
    p = mm.join(F.broadcast(q), COLUMN)
    rng = F.col("max") - F.col("min")
    fd = 2.0 * (F.col("q3") - F.col("q1")) * F.pow(F.col("n").cast("double"), F.lit(-1.0 / 3.0))
    sturges = rng / (F.log2(F.col("n").cast("double")) + 1.0)
    width = F.when(fd > 0, F.least(fd, sturges)).otherwise(sturges)
    ints = _integer_cols(df)
    is_int = F.col(COLUMN).isin(*ints) if ints else F.lit(False)
    width = F.when(is_int, F.greatest(width, F.lit(1.0))).otherwise(width)
    want = F.when(rng > 0, F.greatest(F.ceil(F.try_divide(rng, width)), F.lit(1))).otherwise(F.lit(1)).cast("bigint")
    bins = F.when(want <= max_bins, want).otherwise(F.raise_error(F.concat(
        F.lit("histogram of "), COLUMN, F.lit(" needs "), want.cast("string"),
        F.lit(f" bins, over max_bins = {max_bins}"))).cast("bigint"))
    return p.select(COLUMN, "n", "min", "max", "q1", "q3", bins.alias("n_bins"))


def histogram(df: DataFrame, cols: Sequence[str] | None = None, max_bins: int = MAX_BINS) -> DataFrame:
    """``(column_name, bin, lower, upper, count)`` with every bin present
    (empty bins have count 0); equal-width bins from min to max, the last
    one closed.  Parameters are a broadcast table of one row per column."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    ensure_checkpoint_dir(df.sparkSession)
    params = histogram_params(df, cols, max_bins).checkpoint(eager=True)
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    w = (F.col("max") - F.col("min")) / F.col("n_bins")
    idx = F.when(w > 0, F.least(F.floor((F.col(VALUE) - F.col("min")) / w), F.col("n_bins") - 1)).otherwise(0)
    counts = (long.join(F.broadcast(params.select(COLUMN, "min", "max", "n_bins")), COLUMN)
              .groupBy(COLUMN, idx.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count")))
    grid = params.select(COLUMN, "min", "max", "n_bins",
                         F.explode(F.sequence(F.lit(0), F.col("n_bins") - 1)).alias("bin"))
    return (grid.join(counts, [COLUMN, "bin"], "left")
            .select(COLUMN, "bin", (F.col("min") + F.col("bin") * w).alias("lower"),
                    (F.col("min") + (F.col("bin") + 1) * w).alias("upper"),
                    F.coalesce("count", F.lit(0)).cast("bigint").alias("count")))


def density_curve(df: DataFrame, cols: Sequence[str] | None = None, grid: int = KDE_GRID,
                  cut: float = KDE_CUT) -> DataFrame:
    """Gaussian density with Scott's bandwidth ``std * n^(-1/5)`` on a
    grid of ``grid`` points from ``min - cut*bw`` to ``max + cut*bw``,
    summed exactly over all values.

    Values are first reduced to ``(column, value, count)`` (map-side
    combine, so a value held by many rows is one row); each distinct value
    then adds its weighted kernel to the grid points within reach (at most
    ``grid``, aggregated per point before the shuffle).  The per-column
    parameters are one small row per column."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    st = long.groupBy(COLUMN).agg(F.count(F.lit(1)).alias("n"), F.stddev_samp(VALUE).alias("sd"),
                                  F.min(VALUE).alias("min"), F.max(VALUE).alias("max"))
    st = st.withColumn("bw", F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))).where(F.col("bw") > 0)
    lo = F.col("min") - cut * F.col("bw")
    step = ((F.col("max") + cut * F.col("bw")) - lo) / (grid - 1)
    params = st.select(COLUMN, "n", "bw", lo.alias("_lo"), step.alias("_step"))
    distinct = long.groupBy(COLUMN, VALUE).agg(F.count(F.lit(1)).alias("_c"))
    # only the grid points that the kernel reaches: beyond, it adds exactly 0
    reach = KERNEL_REACH * F.col("bw")
    first = F.greatest(F.ceil((F.col(VALUE) - reach - F.col("_lo")) / F.col("_step")), F.lit(0)).cast("int")
    last = F.least(F.floor((F.col(VALUE) + reach - F.col("_lo")) / F.col("_step")), F.lit(grid - 1)).cast("int")
    fan = (distinct.join(F.broadcast(params), COLUMN)
           .select(COLUMN, VALUE, "_c", "bw", "_lo", "_step",
                   F.explode(F.sequence(first, F.greatest(first, last))).alias("point")))
    points = params.select(COLUMN, F.explode(F.sequence(F.lit(0), F.lit(grid - 1))).alias("point"))
    x = F.col("_lo") + F.col("point") * F.col("_step")
    z = (x - F.col(VALUE)) / F.col("bw")
    sums = fan.groupBy(COLUMN, "point").agg(F.sum(F.col("_c") * F.exp(-0.5 * z * z)).alias("_s"))
    out = (points.join(sums, [COLUMN, "point"], "left").withColumn("_s", F.coalesce("_s", F.lit(0.0)))
           .join(F.broadcast(params), COLUMN))
    return out.select(COLUMN, "point", (F.col("_lo") + F.col("point") * F.col("_step")).alias("x"),
                      (F.col("_s") / (F.col("n") * F.col("bw") * math.sqrt(2 * math.pi))).alias("density"))


def category_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3: ``(column_name, value, count)`` for every categorical column."""
    return value_counts_long(df, cols).where(F.col(VALUE).isNotNull()).withColumnRenamed("cnt", "count")


def box_stats(df: DataFrame, cols: Sequence[str] | None = None, whis: float = BOX_WHIS) -> DataFrame:
    """q1, median, q3, whiskers (farthest values inside
    ``whis`` x IQR of the box), count of points outside and the mean."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    q = quantile_table(df, cols, [0.25, 0.5, 0.75], ["q1", "median", "q3"])
    iqr = F.col("q3") - F.col("q1")
    b = q.select(COLUMN, "q1", "median", "q3", (F.col("q1") - whis * iqr).alias("_lo"),
                 (F.col("q3") + whis * iqr).alias("_hi"))
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    x = F.col(VALUE)
    agg = (long.join(F.broadcast(b.select(COLUMN, "_lo", "_hi")), COLUMN).groupBy(COLUMN).agg(
        F.min(F.when(x >= F.col("_lo"), x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("_hi"), x)).alias("whisker_high"),
        F.count_if((x < F.col("_lo")) | (x > F.col("_hi"))).alias("n_fliers"),
        F.avg(x).alias("mean")))
    return b.join(agg, COLUMN).select(COLUMN, "q1", "median", "q3", "whisker_low", "whisker_high",
                                      "n_fliers", "mean")


# ----------------------------------------------------------------- D5 correlation

def _pair_structs(cols: Sequence[str], fn: Callable[[str, str], F.Column]) -> list:
    return [F.struct(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"), fn(a, b).alias("correlation"))
            for a in cols for b in cols]


PAIR_SCHEMA = "column_a string, column_b string, correlation double"


def _correlation(a: Column, b: Column) -> Column:
    """Pearson over rows that hold both values; NULL where one is constant."""
    spread = F.stddev_pop(F.when(b.isNotNull(), a)) * F.stddev_pop(F.when(a.isNotNull(), b))
    return F.try_divide(F.covar_pop(a, b), spread)


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson for all ordered pairs in one aggregate over the rows where
    neither value is NULL (pairwise complete)."""
    if not cols:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    d = df.select(*[clean_double(c).alias(c) for c in cols])
    return (d.agg(F.array(*_pair_structs(cols, lambda a, b: _correlation(F.col(a), F.col(b)))).alias("_m"))
            .select(F.explode("_m").alias("_p")).select("_p.*"))


def _ranked_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Replace every value by its tie-averaged rank within its column.  The
    ranks of all columns come from one rank job on the long layout (one row
    per distinct value); each column then looks its rank up by value: broadcast
    joins when the rank tables of all columns together are counted small, else
    shuffle joins whose hot values Spark splits as skewed."""
    d = df.select(*[clean_double(c).alias(c) for c in cols])
    long = to_long(d, cols).where(F.col(VALUE).isNotNull())
    ensure_checkpoint_dir(df.sparkSession)
    ranks = value_ranks(long, [COLUMN], VALUE).select(COLUMN, VALUE, "avg_rank").checkpoint(eager=True)
    # the tables of all columns together, counted, decide
    small = ranks.count() * 2 * BYTES_PER_CELL <= MAX_BROADCAST_BYTES
    out = d
    for c in cols:
        rc = ranks.where(F.col(COLUMN) == c).select(F.col(VALUE).alias(f"_v_{c}"), F.col("avg_rank").alias(f"_r_{c}"))
        out = out.join(F.broadcast(rc) if small else rc, out[c] == rc[f"_v_{c}"], "left")
    return out.select(*[F.col(f"_r_{c}").alias(c) for c in cols])


def _spearman_pairs(d: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Spearman of the given pairs, each ranked on its complete rows, in one
    rank job: a row becomes one entry for each pair it completes."""
    entries = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).alias("va"), F.col(b).alias("vb"))
                        for i, (a, b) in enumerate(pairs)])
    cells = (d.select(F.explode(entries).alias("e")).select("e.*").where("va is not null and vb is not null")
             .groupBy("pair", "va", "vb").agg(F.count(F.lit(1)).alias("c")))
    ensure_checkpoint_dir(d.sparkSession)
    cells = cells.checkpoint(eager=True)
    sides = cells.select("pair", "c", F.explode(F.array(
        F.struct(F.lit("a").alias("side"), F.col("va").alias(VALUE)),
        F.struct(F.lit("b").alias("side"), F.col("vb").alias(VALUE)))).alias("s")).select("pair", "c", "s.*")
    counted = sides.groupBy("pair", "side", VALUE).agg(F.sum("c").alias("cnt"))
    ranks = running_sums(counted, ["pair", "side"], [VALUE], ["cnt"]).select(
        "pair", "side", VALUE, (F.col("cnt_before") + (F.col("cnt") + 1) / 2.0).alias("r"))
    ra = ranks.where("side = 'a'").select("pair", F.col(VALUE).alias("va"), F.col("r").alias("ra"))
    rb = ranks.where("side = 'b'").select("pair", F.col(VALUE).alias("vb"), F.col("r").alias("rb"))
    # ranks are centred on their mean (n + 1) / 2, known from the counts
    totals = cells.groupBy("pair").agg(F.sum("c").alias("n"))
    w = (cells.join(ra, ["pair", "va"]).join(rb, ["pair", "vb"]).join(F.broadcast(totals), "pair")
         .withColumn("x", F.col("ra") - (F.col("n") + 1) / 2.0).withColumn("y", F.col("rb") - (F.col("n") + 1) / 2.0))
    got = w.groupBy("pair").agg(F.try_divide(
        F.sum(F.col("c") * F.col("x") * F.col("y")),
        F.sqrt(F.sum(F.col("c") * F.col("x") ** 2)) * F.sqrt(F.sum(F.col("c") * F.col("y") ** 2))).alias("correlation"))
    names = d.sparkSession.createDataFrame([(i, a, b) for i, (a, b) in enumerate(pairs)],
                                           "pair int, column_a string, column_b string")
    one = names.join(got, "pair", "left").select("column_a", "column_b", "correlation")
    return one.unionByName(one.where("column_a <> column_b").select(
        F.col("column_b").alias("column_a"), F.col("column_a").alias("column_b"), "correlation"))


def spearman_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Spearman = Pearson of tie-averaged ranks, pairwise complete as pandas.
    Columns without NULL are ranked once for all their pairs; only pairs with a
    NULL-bearing column get ranks of their own, all in one job."""
    if not cols:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    d = df.select(*[clean_double(c).alias(c) for c in cols])
    nulls = d.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols]).first()
    whole = [c for c in cols if nulls[c] == 0]
    own = [(a, b) for i, a in enumerate(cols) for b in cols[i:] if nulls[a] or nulls[b]]
    if not own:
        return pearson_matrix(_ranked_wide(d, cols), cols)
    out = _spearman_pairs(d, own)
    return out.unionByName(pearson_matrix(_ranked_wide(d, whole), whole)) if whole else out


def _inversions(order: np.ndarray, weight: np.ndarray) -> float:
    """Sum of w_i * w_j over i < j with order[i] > order[j] (distinct whole
    numbers from 0), bit by bit: rows that agree in the higher bits stay
    together in their first order, and a row with bit 0 meets those before it
    with bit 1."""
    total, n = 0.0, len(order)
    if not n:
        return total
    rows = np.arange(n)
    for bit in range(max(1, int(n).bit_length()) - 1, -1, -1):
        value = order[rows]
        group, ones = value >> (bit + 1), (value >> bit) & 1
        w = weight[rows]
        heavier = np.cumsum(w * ones)
        start = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        base = np.repeat((heavier - w * ones)[start], np.diff(np.r_[start, n]))
        total += float(((heavier - base) * w)[ones == 0].sum())
        rows = rows[np.argsort(value >> bit, kind="stable")]
    return total


def _discordant(group: pd.DataFrame, first: list[str]) -> pd.DataFrame:
    """Discordant weight inside one range of rows: ordered by ``first``, against
    the order by (b, a)."""
    g = group.sort_values(first).reset_index(drop=True)
    order = np.empty(len(g), dtype=np.int64)
    order[np.lexsort((g["va"].to_numpy(), g["vb"].to_numpy()))] = np.arange(len(g))
    return pd.DataFrame({"pair": [int(g["pair"].iloc[0])], "d": [_inversions(order, g["c"].to_numpy(dtype=np.float64))]})


def _between_ranges(grid: pd.DataFrame) -> float:
    """Discordant weight of rows in different ranges of both orders, from the
    counts of the grid of ranges."""
    xs, x = np.unique(grid["rx"], return_inverse=True)
    ys, y = np.unique(grid["ry"], return_inverse=True)
    counts = np.zeros((len(xs), len(ys)))
    np.add.at(counts, (x, y), grid["c"].to_numpy(dtype=np.float64))
    later = np.zeros_like(counts)  # weight in later x-ranges and earlier y-ranges
    later[:-1, 1:] = counts[::-1].cumsum(axis=0)[::-1][1:].cumsum(axis=1)[:, :-1]
    return float((counts * later).sum())


def kendall_matrix(df: DataFrame, cols: Sequence[str], ranges: int | None = None) -> DataFrame:
    """Kendall's tau-b for all ordered pairs, pairwise complete; NULL where a
    column is constant.

    Rows become one cell for each distinct pair of values, with its count.
    Discordant pairs are counted as inversions between the order by (a, b) and
    the order by (b, a), in which tied values never invert.  Both orders are cut
    into ranges: cells that differ in both ranges are counted from the grid of
    ranges (at most ``ranges`` squared numbers, on the driver), those that share
    a range within the group of that range.  Ties come from counts.  No pairs of
    rows are made."""
    if not cols:
        return df.sparkSession.createDataFrame([], PAIR_SCHEMA)
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    d = df.select(*[clean_double(c).alias(c) for c in cols])
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    entries = F.array(*[F.struct(F.lit(i).alias("pair"), F.col(a).alias("va"), F.col(b).alias("vb"))
                        for i, (a, b) in enumerate(pairs)])
    cells = (d.select(F.explode(entries).alias("e")).select("e.*").where("va is not null and vb is not null")
             .groupBy("pair", "va", "vb").agg(F.count(F.lit(1)).alias("c")))
    n_ranges = ranges or shuffle_partitions(spark)
    cells = cells.repartitionByRange(n_ranges, "pair", "va", "vb").withColumn("rx", F.spark_partition_id()).checkpoint(eager=True)
    cells = cells.repartitionByRange(n_ranges, "pair", "vb", "va").withColumn("ry", F.spark_partition_id()).checkpoint(eager=True)

    def ties(by: list[str]) -> dict[int, float]:
        t = cells.groupBy("pair", *by).agg(F.sum("c").cast("double").alias("t"))
        return {r["pair"]: r["s"] for r in t.groupBy("pair").agg(F.sum(F.col("t") * (F.col("t") - 1) / 2).alias("s")).collect()}
    same_x = cells.groupBy("pair", "rx").applyInPandas(lambda g: _discordant(g, ["va", "vb"]), "pair int, d double")
    same_y = cells.groupBy("pair", "ry").applyInPandas(lambda g: _across(g), "pair int, d double")
    inside = {r["pair"]: r["d"] for r in same_x.unionByName(same_y).groupBy("pair").agg(F.sum("d").alias("d")).collect()}
    grid = {k: g for k, g in cells.groupBy("pair", "rx", "ry").agg(F.sum("c").alias("c")).toPandas().groupby("pair")}
    all_, tx, ty, txy = ties([]), ties(["va"]), ties(["vb"]), ties(["va", "vb"])
    rows = []
    for i, (a, b) in enumerate(pairs):
        tau = None
        if i in all_:
            n0, n1, n2, n3 = all_[i], tx[i], ty[i], txy[i]
            below = math.sqrt(n0 - n1) * math.sqrt(n0 - n2)
            if below > 0:
                tau = (n0 - n1 - n2 + n3 - 2 * (inside.get(i, 0.0) + _between_ranges(grid[i]))) / below
        rows += [(a, b, tau)] + ([(b, a, tau)] if a != b else [])
    return spark.createDataFrame(rows, PAIR_SCHEMA)


def _across(group: pd.DataFrame) -> pd.DataFrame:
    """Discordant weight of cells that share a range of the order by (b, a) but
    lie in different ranges of the order by (a, b): within such a range cells
    are put in the order of (b, a), so they do not invert."""
    return _discordant(group, ["rx", "vb", "va"])


def correlation_matrix(df: DataFrame, cols: Sequence[str] | None = None, method: str = "spearman") -> DataFrame:
    """``(column_a, column_b, correlation)`` for all ordered pairs, by
    ``pearson``, ``spearman`` or ``kendall`` (tau-b)."""
    cols = list(cols) if cols is not None else numeric_columns(df)
    if method == "pearson":
        return pearson_matrix(df, cols)
    if method == "spearman":
        return spearman_matrix(df, cols)
    if method == "kendall":
        return kendall_matrix(df, cols)
    raise ValueError(f"unsupported method {method!r}")


def target_bars(df: DataFrame, target: str) -> DataFrame:
    """Counts and percent labels per class."""
    return target_distribution(df, target)


def run_all(df: DataFrame, target: str | None = None, numeric: Sequence[str] | None = None,
            categorical: Sequence[str] = ()) -> DataFrame:
    """Compute every distribution table, keep going on failure, and
    report ``(item, status, rows, error)``."""
    items: dict[str, Callable[[], DataFrame]] = {
        "histogram": lambda: histogram(df, numeric),
        "density": lambda: density_curve(df, numeric),
        "box": lambda: box_stats(df, numeric),
        "correlation": lambda: correlation_matrix(df, numeric),
    }
    if categorical:
        items["categories"] = lambda: category_counts(df, categorical)
    if target:
        items["target"] = lambda: target_bars(df, target)
    rows = []
    for name, fn in items.items():
        try:
            n = fn().count()
            rows.append((name, "ok", int(n), None))
        except Exception as e:  # noqa: BLE001 - reported, not raised
            rows.append((name, "failed", None, f"{type(e).__name__}: {e}"))
    return df.sparkSession.createDataFrame(rows, "item string, status string, rows bigint, error string")
