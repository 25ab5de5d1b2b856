"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir, table_path
from .bpe import bpe_encode_decode
from .cross_align import CrossAlignment
from .decontaminate import find_leaks
from .hard_negatives import hard_negatives
from .importance import importance_resample
from .line_dedup import line_dedup
from .ngram_jaccard import ngram_jaccard_join
from .pii import digest_spans, find_pii
from .queries_sql import SQL
from .run_length_index import drop_repeats
from .token_counts import token_counts
from .token_files import read_token_files, write_token_files
from .topk_search import topk_search
from .warc import derivatives

__all__ = ["QUERIES", "SQL"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op2_bpe_encode_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_encode_decode(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id",
        F.expr("cast(length(ids) / 4 as long)").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "op3-shards")
    manifest = write_token_files(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op5_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk_search(_table(spark, sf_dir, "embeddings"), "id % 50 = 0", k=5, scale=256)


def op6_importance_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = importance_resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return kept.select("doc_id", "log_weight")


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")).drop("text_hash")


def op9_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(_table(spark, sf_dir, "pages"), types=("response", "metadata", "conversion"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_pii(_table(spark, sf_dir, "documents"))
    base = "filter(spans, y -> y.rank < 4)"
    return found.select(
        "doc_id",
        *(F.expr(f"cast(size(filter(spans, y -> y.kind = '{k}')) as long)").alias(f"n_{k}") for k in ("email", "ip", "card", "phone")),
        F.sha2(F.expr(digest_spans(base)), 256).alias("base_sha256"),
        F.expr(digest_spans("spans")).alias("spans"),
    )


def op10_run_length_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(_table(spark, sf_dir, "documents")).select(
        "doc_id",
        "n_bytes",
        F.expr("aggregate(spans, 0L, (s, x) -> s + x.end - x.start)").alias("n_removed"),
        F.expr("cast(size(spans) as long)").alias("n_spans"),
        "kept_sha256",
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").withColumn("label", F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)"))
    return hard_negatives(vectors, "id % 100 = 0", positives=5, negatives=5, low=(80, 100), scale=256)


def op12_cross_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    aligned = CrossAlignment(_table(spark, sf_dir, "documents"), *paths)
    docs = aligned.documents().withColumn("groups_sha256", F.expr("if(n_a = 0, '', sha2(groups, 256))")).drop("groups")
    both = docs.join(aligned.link_sums(), "key")
    return both.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def op13_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = line_dedup(_table(spark, sf_dir, "documents"))
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_bpe_encode_decode": op2_bpe_encode_decode,
    "op3_token_files": op3_token_files,
    "op4_token_counts": op4_token_counts,
    "op5_topk_search": op5_topk_search,
    "op6_importance_resample": op6_importance_resample,
    "op7_pii": op7_pii,
    "op8_decontaminate": op8_decontaminate,
    "op9_warc_derivatives": op9_warc_derivatives,
    "op10_run_length_dedup": op10_run_length_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_cross_align": op12_cross_align,
    "op13_line_dedup": op13_line_dedup,
}
