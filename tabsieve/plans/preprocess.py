"""Preprocessing plan (C11): deduplicate -> split -> fit on train -> apply
the same fitted state to train, dev and test.

The key column survives until after the split (it is the only stable row
identity) and is dropped last.  Fitting reads the training rows only by
default; ``fit_scope='all'`` fits imputation and encoding on all rows as
the reference does."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..functions.columns import categorical_columns, numeric_columns
from ..operators import clean as cln
from ..operators.split import stratified_split
from ..sources import io


@dataclass
class PreprocessConfig:
    key: str
    target: str
    test_size: int
    dev_size: int
    seed: str = "-42"
    deduplicate: bool = True
    # compare whole rows; True leaves the key out, so rows that differ only in
    # their key count as copies
    dedup_ignores_key: bool = False
    impute: bool = True
    numeric_strategy: str = "mean"
    encode: bool = True
    outlier_cols: Sequence[str] = ()
    outliers_enabled: bool = True
    log1p_cols: Sequence[str] = ()
    drop_original: bool = False
    fit_scope: str = "train"
    drop_cols: Sequence[str] = field(default_factory=tuple)


def fit(train: DataFrame, cfg: PreprocessConfig, all_rows: DataFrame | None = None) -> dict:
    """Fitted state of every step as a dict of small per-column values."""
    basis = all_rows if (cfg.fit_scope == "all" and all_rows is not None) else train
    skip = {cfg.key, cfg.target, *cfg.drop_cols}
    num = numeric_columns(basis, skip)
    cat = categorical_columns(basis, skip)
    params: dict = {}
    if cfg.impute:
        params["impute_numeric"] = cln.fit_numeric_impute(basis, num, cfg.numeric_strategy)
        params["impute_categorical"] = cln.fit_mode_impute(basis, cat)
    if cfg.encode:
        imputed = cln.apply_impute(basis, params.get("impute_numeric"), params.get("impute_categorical"))
        params["one_hot"] = cln.fit_one_hot(imputed, cat)
    if cfg.outliers_enabled and cfg.outlier_cols:
        tr = cln.apply_impute(train, params.get("impute_numeric"), params.get("impute_categorical"))
        params["outlier_bounds"] = cln.fit_outlier_bounds(tr, list(cfg.outlier_cols))
    params["log1p"] = list(cfg.log1p_cols)
    params["drop"] = [cfg.key, *cfg.drop_cols]
    return params


def transform(df: DataFrame, params: dict, drop_original: bool = False) -> DataFrame:
    """Apply fitted state; a pure projection (also valid on a stream)."""
    out = cln.apply_impute(df, params.get("impute_numeric"), params.get("impute_categorical"))
    if params.get("one_hot"):
        out = cln.apply_one_hot(out, params["one_hot"])
    if "outlier_bounds" in params:
        out = cln.flag_outliers(out, params["outlier_bounds"])
    if params.get("log1p"):
        out = cln.log1p_columns(out, params["log1p"], drop_original=drop_original)
    drop = [c for c in params.get("drop", []) if c in out.columns]
    return out.drop(*drop)


def fit_transform(df: DataFrame, cfg: PreprocessConfig, keep_key: bool = False) -> tuple[dict, dict]:
    """Whole plan; returns ``({'train','dev','test'} -> DataFrame, params)``."""
    base = cln.drop_duplicate_rows(df, cfg.deduplicate, ignore=[cfg.key] if cfg.dedup_ignores_key else [])
    split = stratified_split(base, cfg.key, cfg.target, cfg.test_size, cfg.dev_size, cfg.seed)
    parts = {s: split.where(split["split"] == s).drop("split") for s in ("train", "dev", "test")}
    params = fit(parts["train"], cfg, base)
    if keep_key:
        params = {**params, "drop": [c for c in params["drop"] if c != cfg.key]}
    return {s: transform(d, params, cfg.drop_original) for s, d in parts.items()}, params


def run(spark: SparkSession, df: DataFrame, cfg: PreprocessConfig, out_dir: str) -> dict:
    """Plan with its sinks: splits (S4) and fitted state (S5), written once."""
    splits, params = fit_transform(df, cfg)
    io.write_splits(splits, f"{out_dir}/splits")
    io.save_params(spark, params, f"{out_dir}/params")
    return params
