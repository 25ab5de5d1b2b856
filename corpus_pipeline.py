"""Corpus pipeline: quality, near copies, benchmark leaks, personal data, tokens.

Each stage works on all that the one before kept.  Results of a stage are
written as Parquet into the shared scratch folder and read again, so a stage
never recomputes the ones before it.  A null text counts as empty from the
personal-data stage on.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakestrata.llm.bpe import bpe_encode_decode
from lakestrata.llm.decontaminate import find_leaks
from lakestrata.llm.importance import importance_resample
from lakestrata.llm.ngram_jaccard import one_of_each
from lakestrata.llm.pii import find_pii, redacted
from lakestrata.session import scratch_dir, table_path


def _shielded(docs: DataFrame) -> DataFrame:
    """docs with its other columns under numbered names, which clash with no operator's own."""
    return docs.toDF(*(c if c in ("doc_id", "text") else f"column {i}" for i, c in enumerate(docs.columns)))


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling draws."""
    labels = spark.read.parquet(table_path(sf_dir, "labels"))
    plain = _shielded(docs)
    return importance_resample(plain, labels).select(*plain.columns).toDF(*docs.columns)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return one_of_each(docs)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages of the benchmark; a row is its id and text."""
    items = spark.read.parquet(table_path(sf_dir, "benchmark"))
    leaked = find_leaks(docs, items).select(F.col("doc_id").alias("leaked id"), "text_hash").distinct()
    same_text = F.xxhash64(docs["text"].cast("string")) == leaked["text_hash"]
    return docs.join(leaked, docs["doc_id"].eqNullSafe(leaked["leaked id"]) & same_text, "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by its kind; n_chars follows the text."""
    plain = _shielded(docs)
    others = tuple(c for c in plain.columns if c not in ("doc_id", "text"))
    clean = find_pii(plain, keep=others).withColumn("text", redacted("text", "spans")).select(*plain.columns).toDF(*docs.columns)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each text, and the hash of what they decode to."""
    encoded = bpe_encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", F.expr("cast(length(ids) / 4 as long)").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_copies),
    ("benchmark decontamination", benchmark_leaks),
    ("PII", personal_data),
    ("BPE encoding and decoding", tokens),
]

# classifier, components and tokenizer have no SQL form; tests/llm/test_pipeline.py holds stages and run() against plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of sf_dir."""
    docs = spark.read.parquet(table_path(sf_dir, "documents"))
    for name, stage in STAGES:
        path = scratch_dir(spark, "stage-" + name.replace(" ", "-"))
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
