"""Corpus pipeline over ``documents``: quality classifier, SimHash
near-duplicates, secret scan, mixing, byte-level BPE.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; ``run`` writes each stage's rows as Parquet in the checkpoint folder and
reads them again for the next.  All stages but the last return the columns of
``documents``.  No stage has a SQL counterpart as a whole (trees, fingerprints
and merges are beyond SQL), so ``ORACLE_SQL`` is None and the tests hold the
stages against brute force."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tabsieve.llm import chunked_bpe, pfair_mix, quality_gam, secrets_forest, simhash_anchor
from tabsieve.llm.common import prepare, table
from tabsieve.llm.queries import vocabulary


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  A null text is judged as
    an empty one, a null id is an id like any other, and of rows that repeat
    each is judged for itself; other columns are not read.  No rows give none."""
    return quality_gam.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the smallest doc_id; a row
    without an id only where no other has one.  Null and empty texts have
    fingerprint zero and are one group with what lies near it; of rows that
    repeat an id the one with the smallest fingerprint and row hash stays."""
    return simhash_anchor.keep_one(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced.  Null and empty texts and
    texts without a secret come back as they are, repeated rows each."""
    return secrets_forest.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, sources interleaved to their target weights: the files of
    the result follow one another in that order.  A null source is a source;
    rows that tie or repeat all stay, as do null and empty texts."""
    return pfair_mix.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every document, a row
    for each that repeats; null and empty texts have no tokens."""
    import public_tokenizers

    ranks, pattern = vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return chunked_bpe.encode_digest(docs, ranks, pattern)


STAGES = [
    ("quality_classifier", quality),
    ("simhash_near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("source_mixing", mixing),
    ("byte_bpe", tokens),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = f"{prepare(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
