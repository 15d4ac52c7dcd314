import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabsieve.functions import ranks


def test_exact_quantiles_match_numpy_with_ties_and_nulls(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.exponential(3.0, 5000), 1)
    y = rng.integers(0, 20, 5000).astype(float)
    pdf = pd.DataFrame({"x": x, "y": y})
    pdf.loc[::17, "y"] = None
    df = spark.createDataFrame(pdf).repartition(7)
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["column_name"], r["prob"]): r["quantile"] for r in ranks.exact_quantiles(df, ["x", "y"], probs).collect()}
    for c in ("x", "y"):
        vals = pdf[c].dropna().to_numpy()
        for p in probs:
            assert got[(c, p)] == pytest.approx(np.quantile(vals, p), abs=1e-12)


def test_fixture_quartiles(spark):
    df = spark.createDataFrame([(float(v),) for v in (1, 2, 4, 9, 16)], "x double")
    q = ranks.quantile_table(df, ["x"], [0.25, 0.75], ["q25", "q75"]).first()
    assert (q["q25"], q["q75"]) == (2.0, 9.0)


def test_value_ranks_equal_pandas_average_ranks(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "v": rng.integers(0, 50, 3000).astype(float)})
    df = spark.createDataFrame(pdf)
    r = ranks.value_ranks(df, ["g"], "v").toPandas()
    for g, part in pdf.groupby("g"):
        expect = part["v"].rank(method="average")
        got = part["v"].map(dict(zip(r[r.g == g].v, r[r.g == g].avg_rank)))
        assert np.allclose(got.to_numpy(), expect.to_numpy())


def test_running_sums_independent_of_partitioning(spark):
    df = spark.range(0, 2000).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"),
                                     (F.col("id") % 5).alias("w"))
    a = ranks.running_sums(df, ["g"], ["k"], ["w"], num_ranges=3).orderBy("g", "k").collect()
    b = ranks.running_sums(df.repartition(11), ["g"], ["k"], ["w"], num_ranges=13).orderBy("g", "k").collect()
    assert [r["w_before"] for r in a] == [r["w_before"] for r in b]
    pdf = df.toPandas().sort_values(["g", "k"])
    expect = pdf.groupby("g")["w"].cumsum() - pdf["w"]
    assert [r["w_before"] for r in a] == expect.tolist()


def test_descending_running_sums(spark):
    df = spark.createDataFrame([(1.0, 1), (2.0, 1), (3.0, 1)], "p double, c long")
    r = {row["p"]: row["c_before"] for row in ranks.running_sums(df, [], ["p"], ["c"], descending=True).collect()}
    assert r == {3.0: 0, 2.0: 1, 1.0: 2}


def test_null_groups_keep_every_row(spark):
    rows = [(None if i % 3 == 0 else f"g{i % 2}", i, float(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k bigint, v double").repartition(5)
    out = ranks.running_counts(df.withColumn("one", F.lit(1)), ["g"], ["k"], "one").collect()
    assert len(out) == 300
    for g in (None, "g0", "g1"):
        assert sorted(r["rows_before"] for r in out if r["g"] == g) == list(range(100))
    q = {(r["g"], r["prob"]): r["quantile"] for r in
         ranks.exact_quantiles_long(df.withColumnRenamed("v", "value"), [0.25, 0.5], ["g"]).collect()}
    for g in (None, "g0", "g1"):
        vals = [v for x, _, v in rows if x == g]
        assert q[(g, 0.25)] == np.quantile(vals, 0.25) and q[(g, 0.5)] == np.quantile(vals, 0.5)
