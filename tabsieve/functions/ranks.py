"""Distributed running counts, average ranks and exact quantiles.

A window without ``partitionBy`` puts every row in one task, and a window
partitioned by class puts a whole class in one task.  Here the ordering is
split into ranges instead:

1. the input is first reduced to one row per distinct (group, key) with a
   weight, so a value that holds a third of all rows becomes one row;
2. ``repartitionByRange`` cuts the ordered keys into contiguous ranges and the
   partition index is written down with the rows through a reliable
   ``checkpoint`` (the index must not change on recomputation);
3. per-range totals (at most ranges + groups rows) give each range its offset;
   the small offset table is broadcast after its size is checked;
4. a window partitioned by range adds the running sum inside each range.

Every step is a DataFrame operation; nothing but the offset table's row count
reaches the driver.  The same path runs at every table size, and a NULL group is
a group like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir, shuffle_partitions
from .columns import COLUMN, VALUE, to_long

PID = "_range_id"
BEFORE = "rows_before"
GROUP_TOTAL = "group_total"
# Largest table that is broadcast, by its counted rows and a width of
# BYTES_PER_CELL; beyond it a shuffle join is used.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024
BYTES_PER_CELL = 32


def checked_broadcast(df: DataFrame) -> DataFrame:
    """Mark ``df`` for broadcast only when its counted size is small."""
    small = df.count() * len(df.columns) * BYTES_PER_CELL <= MAX_BROADCAST_BYTES
    return F.broadcast(df) if small else df


def same_group(left: DataFrame, right: DataFrame, cols: Sequence[str], prefix: str) -> tuple[DataFrame, Column]:
    """``right`` with ``cols`` renamed by ``prefix`` and the NULL-safe condition
    that joins it to ``left``."""
    renamed = right.withColumnsRenamed({c: f"{prefix}{c}" for c in cols})
    on = F.lit(True)
    for c in cols:
        on = on & F.col(c).eqNullSafe(F.col(f"{prefix}{c}"))
    return renamed, on


def ranged_offsets(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   weight_cols: Sequence[str], num_ranges: int | None = None,
                   descending: bool = False) -> tuple[DataFrame, DataFrame]:
    """Steps 2-3 of the module docstring: the range-partitioned, checkpointed
    rows (with ``_range_id``) and the small offset table ``(_range_id,
    groups..., _t_<w>, _o_<w>, <w>_total)``, marked for broadcast when its
    counted size is small."""
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_ranges = num_ranges or max(shuffle_partitions(spark), 1)
    g = list(group_cols)
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    ws = list(weight_cols)

    ranged = (df.repartitionByRange(n_ranges, *[F.col(c) for c in g], *keys)
              .withColumn(PID, F.spark_partition_id())
              .checkpoint(eager=True))

    totals = ranged.groupBy(PID, *g).agg(*[F.sum(w).alias(f"_t_{w}") for w in ws])
    prior = Window.partitionBy(*g).orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*g)
    offsets = totals.select(
        PID, *g, *[f"_t_{w}" for w in ws],
        *[F.coalesce(F.sum(f"_t_{w}").over(prior), F.lit(0)).alias(f"_o_{w}") for w in ws],
        *[F.sum(f"_t_{w}").over(whole).alias(f"{w}_total") for w in ws])
    # frozen once: every later use reads this small table, not the ranges
    return ranged, checked_broadcast(offsets.checkpoint(eager=True))


def running_sums(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                 weight_cols: Sequence[str], num_ranges: int | None = None,
                 descending: bool = False) -> DataFrame:
    """For each weight ``w`` add ``<w>_before`` = sum of ``w`` over rows that
    sort strictly before this row inside its group, and ``<w>_total`` = the
    group's sum.  Rows must be unique per (group_cols, order_cols).
    ``descending`` orders the keys from large to small.

    The offset table has at most ``num_ranges + groups - 1`` rows; it is
    counted before it is broadcast."""
    g = list(group_cols)
    ws = list(weight_cols)
    keys = [F.col(c).desc() if descending else F.col(c).asc() for c in order_cols]
    ranged, offsets = ranged_offsets(df, g, order_cols, ws, num_ranges, descending)
    inside = (Window.partitionBy(PID, *g).orderBy(*keys)
              .rowsBetween(Window.unboundedPreceding, -1))
    right, on = same_group(ranged, offsets.drop(*[f"_t_{w}" for w in ws]), [PID, *g], "_off_")
    out = ranged.join(right, on, "inner").drop(*[f"_off_{c}" for c in [PID, *g]])
    out = out.withColumns({
        f"{w}_before": F.col(f"_o_{w}") + F.coalesce(F.sum(w).over(inside), F.lit(0)) for w in ws})
    return out.drop(PID, *[f"_o_{w}" for w in ws])


def running_counts(df: DataFrame, group_cols: Sequence[str], order_cols: Sequence[str],
                   weight_col: str, num_ranges: int | None = None) -> DataFrame:
    """:func:`running_sums` for one weight, named ``rows_before`` and
    ``group_total``."""
    out = running_sums(df, group_cols, order_cols, [weight_col], num_ranges)
    return (out.withColumn(BEFORE, F.col(f"{weight_col}_before").cast("bigint"))
            .withColumn(GROUP_TOTAL, F.col(f"{weight_col}_total").cast("bigint"))
            .drop(f"{weight_col}_before", f"{weight_col}_total"))


def value_ranks(df: DataFrame, group_cols: Sequence[str], value_col: str,
                extra_sums: Sequence[str] = ()) -> DataFrame:
    """One row per distinct (group, value): ``cnt``, ``rows_before`` and the
    average (tie-averaged, 1-based) rank ``avg_rank``.  NULL values are
    dropped.  ``extra_sums`` are summed per distinct value as well (for
    example a positive-label count for ROC / PR curves)."""
    g = list(group_cols)
    counted = (df.where(F.col(value_col).isNotNull())
               .groupBy(*g, value_col)
               .agg(F.count(F.lit(1)).alias("cnt"), *[F.sum(c).alias(c) for c in extra_sums]))
    ranked = running_counts(counted, g, [value_col], "cnt")
    return ranked.withColumn("avg_rank", F.col(BEFORE) + (F.col("cnt") + F.lit(1)) / F.lit(2.0))


def exact_quantiles(df: DataFrame, cols: Sequence[str], probs: Sequence[float]) -> DataFrame:
    """Exact quantiles with linear interpolation between order statistics
    (position ``(n-1)·p``), for several columns in one pass.

    Returns ``(column_name, prob, quantile, n)``; a column without values
    gives NULL.  No buffer holds all values of a column: the distinct values
    are ranked by :func:`running_counts` and the wanted order statistics are
    found with a range join against a broadcast table of
    ``len(cols)·len(probs)·2`` positions."""
    long = to_long(df, cols).where(F.col(VALUE).isNotNull())
    return exact_quantiles_long(long, probs)


def exact_quantiles_long(long: DataFrame, probs: Sequence[float],
                         group_cols: Sequence[str] = (COLUMN,)) -> DataFrame:
    """Quantiles of ``value`` per group of a long table.

    Only the ranges that hold a wanted order statistic are ranked: the
    offset table tells which range covers each position, a join with those
    few rows keeps the ranges, and the window runs over them alone.  The
    rest of the distinct values are written once (checkpoint) and never
    shuffled again."""
    g = list(group_cols)
    counted = long.groupBy(*g, VALUE).agg(F.count(F.lit(1)).alias("cnt"))
    ranged, offsets = ranged_offsets(counted, g, [VALUE], ["cnt"])

    n_tab = offsets.select(*g, F.col("cnt_total").cast("bigint").alias("n")).distinct()
    pos = (n_tab.select(*g, "n", F.explode(F.array(*[F.lit(float(p)) for p in probs])).alias("prob"))
           .withColumn("_h", (F.col("n") - 1) * F.col("prob"))
           .withColumn("_lo", F.floor("_h"))
           .withColumn("_frac", F.col("_h") - F.col("_lo"))
           .withColumn("_hi", F.least(F.col("_lo") + 1, F.col("n") - 1)))
    wanted = pos.select(*g, "prob", F.explode(F.array(
        F.struct(F.lit("lo").alias("side"), F.col("_lo").alias("pos")),
        F.struct(F.lit("hi").alias("side"), F.col("_hi").alias("pos")))).alias("w"))
    wanted = wanted.select(*g, "prob", "w.side", "w.pos")
    # which range holds each wanted position: small x small, groups x probs x 2 rows
    right, on = same_group(wanted, offsets, g, "_off_")
    hold = (wanted.join(right, on & (F.col("pos") >= F.col("_o_cnt"))
                        & (F.col("pos") < F.col("_o_cnt") + F.col("_t_cnt")))
            .select(*g, PID, F.col("_o_cnt").alias("_off"), "prob", "side", "pos").checkpoint(eager=True))
    need, on = same_group(ranged, hold.select(PID, *g, "_off").distinct(), [PID, *g], "_need_")
    inside = Window.partitionBy(PID, *g).orderBy(VALUE).rowsBetween(Window.unboundedPreceding, -1)
    sub = (ranged.join(checked_broadcast(need), on, "inner").drop(*[f"_need_{c}" for c in [PID, *g]])
           .withColumn(BEFORE, F.col("_off") + F.coalesce(F.sum("cnt").over(inside), F.lit(0))).drop("_off"))
    right, on = same_group(sub, hold.drop("_off"), [PID, *g], "_hold_")
    hits = sub.join(checked_broadcast(right), on & (F.col("pos") >= F.col(BEFORE))
                    & (F.col("pos") < F.col(BEFORE) + F.col("cnt")))
    picked = hits.groupBy(*g, "prob").agg(
        F.max(F.when(F.col("side") == "lo", F.col(VALUE))).alias("_vlo"),
        F.max(F.when(F.col("side") == "hi", F.col(VALUE))).alias("_vhi"))
    right, on = same_group(pos, picked, [*g, "prob"], "_got_")
    return (pos.join(right, on, "left")
            .select(*g, "prob",
                    (F.col("_vlo") + (F.col("_vhi") - F.col("_vlo")) * F.col("_frac")).alias("quantile"),
                    "n"))


def quantile_table(df: DataFrame, cols: Sequence[str], probs: Sequence[float],
                   names: Sequence[str], method: str = "exact",
                   rel_error: float = 1e-4) -> DataFrame:
    """Quantiles as one row per column: ``(column_name, <names>...)``.

    ``method='exact'`` uses :func:`exact_quantiles`; ``'approx'`` uses
    ``percentile_approx`` (one aggregate, relative rank error ``rel_error``)."""
    if method == "approx":
        acc = int(max(1, round(1.0 / rel_error)))
        long = to_long(df, cols)
        pa = F.percentile_approx(VALUE, [float(p) for p in probs], acc)
        agg = long.groupBy(COLUMN).agg(pa.alias("_q"))
        return agg.select(COLUMN, *[F.col("_q")[i].alias(nm) for i, nm in enumerate(names)])
    q = exact_quantiles(df, cols, probs)
    aggs = [F.max(F.when(F.col("prob") == float(p), F.col("quantile"))).alias(nm)
            for p, nm in zip(probs, names)]
    return q.groupBy(COLUMN).agg(*aggs)
