"""Fitted row-wise steps on a streaming DataFrame.

Imputation, one-hot encoding, outlier flags, log1p, the coercing cast and
sanitising are projections with literal parameters, so the state fitted on
a batch table applies unchanged to a stream (no streaming state needed).
The reference has no streaming; this is the Structured Streaming form of
the same transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..plans.preprocess import transform


def read_parquet_stream(spark: SparkSession, path: str, schema: T.StructType,
                        max_files_per_trigger: int | None = None) -> DataFrame:
    """A file stream over a parquet folder (the schema is required)."""
    r = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def apply_fitted(stream: DataFrame, params: dict, drop_original: bool = False) -> DataFrame:
    """Apply fitted preprocessing state to every micro-batch."""
    if not stream.isStreaming:
        raise ValueError("expected a streaming DataFrame")
    return transform(stream, params, drop_original)


def write_stream(df: DataFrame, path: str, checkpoint: str, trigger_once: bool = True):
    """Append the transformed stream to parquet with its own checkpoint
    (exactly-once file sink)."""
    w = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    w = w.outputMode("append")
    if trigger_once:
        w = w.trigger(availableNow=True)
    return w.start()
