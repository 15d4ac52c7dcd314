import __spark_entry__ as E
from tabsieve.operators import clean
from tabsieve.streaming import transforms


def test_fitted_transforms_on_a_stream(spark, sf001, tmp_path):
    src = spark.read.parquet(f"{sf001}/customer.parquet")
    params = {"impute_numeric": clean.fit_numeric_impute(src, ["c_acctbal"]),
              "one_hot": clean.fit_one_hot(src, ["c_mktsegment"]),
              "outlier_bounds": clean.fit_outlier_bounds(src, ["c_acctbal"]), "log1p": ["c_acctbal"]}
    src.write.parquet(str(tmp_path / "in"))
    stream = transforms.read_parquet_stream(spark, str(tmp_path / "in"), src.schema)
    out = transforms.apply_fitted(stream, params)
    q = transforms.write_stream(out, str(tmp_path / "out"), str(tmp_path / "ck"))
    q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    assert got.count() == src.count()
    assert "c_mktsegment_BUILDING" in got.columns and "is_outlier" in got.columns


def test_entry_and_registry(spark):
    df = E.entry(spark)
    assert df.count() >= 1 and "count" in df.columns
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 90
