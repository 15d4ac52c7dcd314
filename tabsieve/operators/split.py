"""Exact, seeded, stratified splits and folds; class weights.

Row order inside a class is ``md5(key || seed)`` with the key as tie-break,
so the assignment depends on neither partitioning nor ``rand()``.  Ranks
inside a class come from the distributed running count, so a class that
holds most rows is still spread over many tasks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.ranks import checked_broadcast, running_counts, same_group
from ..session import ensure_checkpoint_dir

RANK = "class_rank"
HASH = "_order_hash"


def allocate(counts: dict, total: int) -> dict:
    """Largest-remainder quotas: ``total`` rows shared over classes in
    proportion to ``counts``; ties of remainder go to the smaller class value
    (the NULL class first).
    The quotas add up to ``total`` exactly (integer arithmetic)."""
    n = sum(counts.values())
    if total > n:
        raise ValueError(f"cannot take {total} rows out of {n}")
    if n == 0:
        return {k: 0 for k in counts}
    base = {k: (total * v) // n for k, v in counts.items()}
    rem = {k: (total * v) % n for k, v in counts.items()}
    left = total - sum(base.values())
    for k in sorted(counts, key=lambda k: (-rem[k], k is not None, k))[:left]:
        base[k] += 1
    return base


def order_hash(key: str, seed: str | int) -> F.Column:
    return F.md5(F.concat(F.col(key).cast("string"), F.lit(str(seed))))


def class_ranks(df: DataFrame, key: str, label: str, seed: str | int) -> DataFrame:
    """0-based rank of each row inside its class in ``md5(key||seed), key``
    order; all columns are carried along and a NULL class is a class."""
    w = df.withColumn(HASH, order_hash(key, seed)).withColumn("_one", F.lit(1))
    ranked = running_counts(w, [label], [HASH, key], "_one")
    return ranked.withColumnRenamed("rows_before", RANK).drop("_one", "group_total", HASH)


# Classes whose remainders are ordered in one window; more are ranked in ranges.
WINDOW_CLASSES = 10_000


def quota_column(counts: DataFrame, label: str, size: str, total: int, name: str,
                 facts: tuple[int, int] | None = None) -> DataFrame:
    """``counts`` (a row a class, ``size`` rows each) with the class's quota of
    ``total`` as ``name``: :func:`allocate` for any number of classes, none of
    which reach the driver.  ``facts``: rows and classes, if known."""
    n, classes = facts or counts.agg(F.coalesce(F.sum(size), F.lit(0)), F.count(F.lit(1))).first()
    if total > n:
        raise ValueError(f"cannot take {total} rows out of {n}")
    if not n:
        return counts.withColumn(name, F.lit(0).cast("bigint"))
    wide = F.lit(total).cast("decimal(19,0)") * F.col(size).cast("decimal(19,0)")
    based = counts.withColumns({"_base": F.call_function("div", wide, F.lit(n).cast("decimal(19,0)")),
                                "_rest": (-(wide % F.lit(n).cast("decimal(19,0)"))).cast("bigint"),
                                "_some": F.col(label).isNotNull(), "_one": F.lit(1)})
    order = ["_rest", "_some", label]
    if classes <= WINDOW_CLASSES:
        ranked = based.withColumns({"rows_before": F.row_number().over(Window.orderBy(*order)) - 1,
                                    "_left": F.lit(total) - F.sum("_base").over(Window.partitionBy())})
    else:
        based = based.checkpoint(eager=True)
        ranked = running_counts(based, [], order, "_one").withColumn("_left", F.lit(total - based.agg(F.sum("_base")).first()[0]))
    return (ranked.withColumn(name, (F.col("_base") + (F.col("rows_before") < F.col("_left")).cast("int")).cast("bigint"))
            .drop("_base", "_rest", "_some", "_one", "rows_before", "group_total", "_left"))


def stratified_split(df: DataFrame, key: str, label: str | None, test_size: int, dev_size: int,
                     seed: str | int = "-42", split_col: str = "split") -> DataFrame:
    """Exact three-way split with absolute sizes: test first out of all
    rows, then dev out of the rest, each class in proportion.  Without a
    label the whole table is one class (plain seeded random split)."""
    lab = label or "_all"
    base = df if label else df.withColumn(lab, F.lit(0))
    ensure_checkpoint_dir(df.sparkSession)
    counts = base.groupBy(lab).agg(F.count(F.lit(1)).alias("_n"))
    n, classes = counts.agg(F.coalesce(F.sum("_n"), F.lit(0)), F.count(F.lit(1))).first()
    counts = quota_column(counts, lab, "_n", test_size, "_tq", (n, classes)).withColumn("_rest_n", F.col("_n") - F.col("_tq"))
    quota = quota_column(counts, lab, "_rest_n", dev_size, "_dq", (n - test_size, classes)).drop("_n", "_rest_n").checkpoint(eager=True)
    ranked = class_ranks(base, key, lab, seed)
    right, on = same_group(ranked, quota, [lab], "_quota_")
    out = ranked.join(checked_broadcast(right), on).drop(f"_quota_{lab}")
    sp = (F.when(F.col(RANK) < F.col("_tq"), "test")
          .when(F.col(RANK) < F.col("_tq") + F.col("_dq"), "dev").otherwise("train"))
    out = out.withColumn(split_col, sp).drop("_tq", "_dq", RANK)
    return out if label else out.drop(lab)


def hash_split(df: DataFrame, key: str, fractions: dict[str, float], seed: str | int = "-42",
               split_col: str = "split") -> DataFrame:
    """Fraction split without any shuffle: a row's place in [0, 1) comes from
    its hash, so the split is stateless and repeatable."""
    u = F.conv(F.substring(order_hash(key, seed), 1, 8), 16, 10).cast("double") / float(2 ** 32)
    expr, acc = None, 0.0
    for name, frac in fractions.items():
        acc += frac
        expr = (F.when(u < acc, name) if expr is None else expr.when(u < acc, name))
    return df.withColumn(split_col, expr.otherwise(list(fractions)[-1]))


def split_report(df: DataFrame, label: str, split_col: str = "split") -> DataFrame:
    """Rows per (split, class) and the class share inside each split,
    with ``full`` for the whole table."""
    per = df.groupBy(split_col, label).agg(F.count(F.lit(1)).alias("count"))
    full = per.groupBy(label).agg(F.sum("count").alias("count")).withColumn(split_col, F.lit("full"))
    both = per.unionByName(full.select(split_col, label, "count"))
    tot = both.groupBy(split_col).agg(F.sum("count").alias("_n"))
    return (both.join(tot, split_col)
            .select(split_col, label, F.col("count").cast("bigint").alias("count"),
                    (F.col("count") / F.col("_n")).alias("share"),
                    F.col("_n").cast("bigint").alias("split_rows")))


def class_weights(df: DataFrame, label: str, weight_col: str = "weight") -> DataFrame:
    """Balanced weight ``n / (k * n_c)`` per row, from a per-class table
    (k rows, broadcast when counted small); NULL is a class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("_nc"))
    # one scan for the classes; n and k are sums over them
    total = counts.agg(F.sum("_nc").alias("n"), F.count(F.lit(1)).alias("k")).first()
    w = counts.select(label, (F.lit(float(total["n"] or 0)) / (total["k"] * F.col("_nc"))).alias(weight_col))
    right, on = same_group(df, w, [label], "_w_")
    return df.join(checked_broadcast(right), on).drop(f"_w_{label}")


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 10, seed: str | int = "-42",
                     fold_col: str = "fold") -> DataFrame:
    """fold = class rank modulo k; every fold gets each class's rows to
    within one."""
    ranked = class_ranks(df, key, label, seed)
    return ranked.withColumn(fold_col, (F.col(RANK) % k).cast("int")).drop(RANK)
