"""Sources and sinks.

Scans are plain ``spark.read``; sinks write directories with Spark's
writers (overwrite semantics).  Fitted parameters and run records are small
tables written as Parquet, so they survive the driver and can be read by
any later job."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import NULL_TOKENS

# ----------------------------------------------------------------- S1, S2 scans


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             null_tokens: Sequence[str] = NULL_TOKENS, narrow: bool = False) -> DataFrame:
    """CSV with header.  Every column is read as text, the null tokens
    (``N/A``, ``NA``, ``NULL``, empty, ...) become NULL, and the text is cast
    with ``try_cast`` to ``schema`` (or to the type Spark infers from the
    cleaned text when no schema is given).  A missing path or an empty table
    is an error.  ``narrow=True`` narrows integer types (P5)."""
    raw = spark.read.option("header", True).option("inferSchema", False).csv(path)
    if raw.isEmpty():
        raise ValueError(f"empty table: {path}")
    toks = list(null_tokens)
    cleaned = raw.select(*[F.when(F.trim(F.col(c)).isin(toks), F.lit(None)).otherwise(F.col(c)).alias(c)
                           for c in raw.columns])
    if schema is None:
        schema = infer_types(cleaned)
    out = cleaned.select(*[F.expr(f"try_cast(`{f.name}` AS {f.dataType.simpleString()})").alias(f.name)
                           if f.name in cleaned.columns else F.lit(None).cast(f.dataType).alias(f.name)
                           for f in schema.fields])
    if narrow:
        from ..operators.schema import narrow_types
        out = narrow_types(out)
    return out


def infer_types(text: DataFrame) -> T.StructType:
    """Type of each text column from one aggregate: bigint if every value
    itself reads as a bigint (``67.0`` and numbers beyond 2^63 do not), double
    if every value reads as a number, else string."""
    aggs = []
    for i, c in enumerate(text.columns):
        v = F.col(f"`{c}`")
        aggs += [F.count_if(v.isNotNull() & v.try_cast("double").isNull()).alias(f"bad_{i}"),
                 F.count_if(v.isNotNull() & v.try_cast("bigint").isNull()).alias(f"whole_{i}")]
    r = text.agg(*aggs).first()
    return T.StructType([T.StructField(
        c, T.StringType() if r[f"bad_{i}"] else T.DoubleType() if r[f"whole_{i}"] else T.LongType())
        for i, c in enumerate(text.columns)])


def read_table(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A prepared table or split directory (parquet by default).  A CSV has
    a header and gets its types as in S1."""
    return read_csv(spark, path) if fmt == "csv" else spark.read.format(fmt).load(path)


def read_splits(spark: SparkSession, path: str, split_col: str = "split") -> dict[str, DataFrame]:
    """S2 / S4 counterpart: the three splits of a table written by
    :func:`write_splits`; partition pruning reads only the wanted split."""
    base = spark.read.parquet(path)
    return {s: base.where(F.col(split_col) == s).drop(split_col) for s in ("train", "dev", "test")}


# ----------------------------------------------------------------- S3, S4, S6 sinks

def write_csv(df: DataFrame, path: str, header: bool = True) -> None:
    """CSV directory, overwritten; no row index is written."""
    df.write.mode("overwrite").option("header", header).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def write_splits(splits: dict[str, DataFrame], path: str, split_col: str = "split") -> None:
    """One table partitioned by split (``train``, ``dev``, ``test``)."""
    out = None
    for name, d in splits.items():
        part = d.withColumn(split_col, F.lit(name))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    write_parquet(out, path, [split_col])


# ----------------------------------------------------------------- S5 fitted parameters

PARAM_SCHEMA = "step string, column_name string, param string, num_value double, str_value string"


def params_to_table(spark: SparkSession, params: dict) -> DataFrame:
    """Fitted state as rows ``(step, column_name, param, num_value,
    str_value)``; ``params`` maps step -> {column -> value | (lo, hi) |
    [levels]}."""
    rows = []
    for step, per_col in params.items():
        if isinstance(per_col, (list, tuple)):
            for i, c in enumerate(per_col):
                rows.append((step, c, f"item_{i:05d}", None, None))
            continue
        for col, v in per_col.items():
            if isinstance(v, tuple):
                rows.append((step, col, "lower", float(v[0]), None))
                rows.append((step, col, "upper", float(v[1]), None))
            elif isinstance(v, list):
                for i, lv in enumerate(v):
                    rows.append((step, col, f"level_{i:05d}", None, str(lv)))
            elif isinstance(v, str):
                rows.append((step, col, "value", None, v))
            elif v is None:
                rows.append((step, col, "value", None, None))
            else:
                rows.append((step, col, "value", float(v), None))
    return spark.createDataFrame(rows, PARAM_SCHEMA)


def table_to_params(df: DataFrame) -> dict:
    """Inverse of :func:`params_to_table` (the table is small: one row per
    fitted scalar)."""
    out: dict = {}
    rows = sorted(df.collect(), key=lambda r: (r["step"], r["column_name"] or "", r["param"]))
    for r in rows:
        step, col, p = r["step"], r["column_name"], r["param"]
        if p.startswith("item_"):
            out.setdefault(step, []).append(col)
            continue
        d = out.setdefault(step, {})
        if p == "value":
            d[col] = r["str_value"] if r["str_value"] is not None else r["num_value"]
        elif p in ("lower", "upper"):
            lo_hi = d.get(col, [None, None])
            lo_hi = list(lo_hi) if isinstance(lo_hi, (list, tuple)) else [None, None]
            lo_hi[0 if p == "lower" else 1] = r["num_value"]
            d[col] = tuple(lo_hi)
        elif p.startswith("level_"):
            d.setdefault(col, []).append(r["str_value"])
    return out


def save_params(spark: SparkSession, params: dict, path: str) -> None:
    """Fitted state as a Parquet table (one file: it is small)."""
    params_to_table(spark, params).coalesce(1).write.mode("overwrite").parquet(path)


def load_params(spark: SparkSession, path: str) -> dict:
    return table_to_params(spark.read.parquet(path))


# ----------------------------------------------------------------- S7 JSON report

def write_json_report(spark: SparkSession, record: dict, path: str) -> None:
    """A report (nested dict) as one JSON row."""
    spark.createDataFrame([(json.dumps(record, default=str, sort_keys=True),)], "report string") \
        .coalesce(1).write.mode("overwrite").text(path)


def read_json_report(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()[0])


# ----------------------------------------------------------------- S8 model and artifacts

def save_model(model, path: str, feature_names: Sequence[str], metrics: DataFrame | None = None) -> None:
    """The model (``write().overwrite()``), the feature-name list and the
    metrics summary next to it."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(i, n) for i, n in enumerate(feature_names)], "position int, feature string") \
        .coalesce(1).write.mode("overwrite").parquet(f"{path}/features")
    if metrics is not None:
        metrics.coalesce(1).write.mode("overwrite").parquet(f"{path}/metrics")


def load_model(spark: SparkSession, path: str):
    """The model that :func:`save_model` wrote, a tree model or a Spark ML
    pipeline."""
    from pyspark.ml import PipelineModel

    from ..operators.tree_model import TreeModel
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/model/nodes")
    is_tree = folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)
    return TreeModel.load(spark, f"{path}/model") if is_tree else PipelineModel.load(f"{path}/model")


# ----------------------------------------------------------------- S9 run log

RUN_PARAMS_SCHEMA = "run_id string, key string, value string"
RUN_METRICS_SCHEMA = "run_id string, split string, metric string, value double"


def log_run(spark: SparkSession, root: str, run_id: str, params: dict, metrics: DataFrame | None) -> None:
    """Record a run's parameters ``(run_id, key, value)`` and metrics
    ``(run_id, split, metric, value)`` in two Parquet tables under ``root``; a
    failed run has parameters (with its error) only.

    Each run has a folder of its own in both tables, so writing it again
    replaces it and writers of other runs do not meet.  The parameters, one
    file that appears by a rename, are written last: they are the run's
    manifest, and a run without them counts as unwritten in :func:`read_runs`."""
    if metrics is not None:
        (metrics.select(F.lit(run_id).alias("run_id"), F.col("split").cast("string"), F.col("metric").cast("string"),
                        F.col("value").cast("double"))
         .write.mode("overwrite").parquet(_run_folder(root, "run_metrics", run_id)))
    spark.createDataFrame([(run_id, str(k), json.dumps(v, default=str)) for k, v in params.items()],
                          RUN_PARAMS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(_run_folder(root, "run_params", run_id))


def _run_folder(root: str, table: str, run_id: str) -> str:
    # a partition of its own; the letter keeps the value a string
    return f"{root}/{table}/run=r-{run_id}"


def read_runs(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """(parameters, metrics) of the runs that are written completely."""
    params = spark.read.parquet(f"{root}/run_params").drop("run")
    metrics = spark.read.parquet(f"{root}/run_metrics").drop("run")
    return params, metrics.join(params.select("run_id").distinct(), "run_id", "left_semi")


def append_stage(stage_rows: DataFrame, root: str) -> None:
    """G9 sink: append ``(run_id, stage, ts)`` rows to the stage table."""
    stage_rows.write.mode("append").parquet(f"{root}/run_stages")
