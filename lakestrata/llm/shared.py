"""Spark helpers of the operators: scratch tables, bounded filters, components."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir

FILTER_BITS = 1 << 24
TASK_ROWS = 50_000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package (once per application), as ``--py-files`` would.

    Arrow batches of whole texts are kept small: Spark's default of 10,000
    rows is lowered, a value of the user's own is left alone."""
    sc = spark.sparkContext
    if spark.conf.get(ARROW_ROWS, "10000") == "10000":
        spark.conf.set(ARROW_ROWS, "2000")
    if sc.applicationId not in _shipped:
        package = Path(__file__).resolve().parents[1]
        archive = Path(tempfile.mkdtemp(prefix="package-")) / "lakestrata_package.zip"
        with zipfile.ZipFile(archive, "w") as z:
            for f in sorted(package.rglob("*.py")):
                z.write(f, f.relative_to(package.parent))
        sc.addPyFile(str(archive))
        _shipped.add(sc.applicationId)
    return spark


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage: write to the shared scratch folder and read back."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"  # shuffle files go when the write has ended
    before = spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(clean, before)
    return spark.read.schema(df.schema).parquet(path)


def few_tasks(df: DataFrame, rows: int) -> DataFrame:
    """df in no more tasks than about ``rows`` rows need, two for each core at least.

    For what follows a shuffle: its partitions are set for the whole input,
    and each task has a cost of its own, also on disk (files, event log)."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, -(-rows // TASK_ROWS)))


def columns(df: DataFrame, **wanted: str) -> DataFrame:
    """Only the wanted columns, by role; other columns cannot clash."""
    return df.select(*(df[c].alias(role) for role, c in wanted.items()))


def bit_filter(df: DataFrame, key: str, bits: int = FILTER_BITS) -> np.ndarray:
    """One-hash Bloom filter of a long column as uint64 words.

    Built by one aggregation.  The driver receives at most ``bits / 64`` rows
    and the filter has ``bits / 8`` bytes whatever the input's size.  It only
    saves work: every caller decides exactly afterwards, so a full filter
    costs time, never a result."""
    slot = F.col(key).bitwiseAND(F.lit(bits - 1))
    words = (
        df.where(F.col(key).isNotNull())
        .groupBy(F.shiftright(slot, 6).cast("int").alias("w"))
        .agg(F.expr(f"bit_or(shiftleft(1L, cast({key} & 63 as int)))").alias("b"))
    )
    words = few_tasks(words, bits // 64).toPandas()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[words["w"].to_numpy(dtype=np.int64)] = words["b"].to_numpy(dtype=np.int64).view(np.uint64)
    return out


def in_filter(filt: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which keys may be members (no false negatives)."""
    slot = keys & np.uint64(len(filt) * 64 - 1)
    return (filt[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1) == 1


def components(links: DataFrame, name: str = "cc", max_rounds: int = 60) -> DataFrame:
    """Connected components of links (a, b): rows (node, comp), comp the least node.

    Alternates large-star and small-star steps, each one a shuffle with
    map-side minimum, so no node's neighbours meet in memory; lineage is cut
    by a written table in each round.  Nodes without links are not returned."""
    few = few_tasks(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), links.count())
    edges = stored(few, name)
    state = None
    for _ in range(max_rounds):
        now = edges.agg(F.count("*").alias("n"), F.expr("bit_xor(xxhash64(u, v))").alias("x")).first()
        if now == state or now["n"] == 0:
            break
        state, rows = now, 2 * now["n"]
        both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = few_tasks(both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")), rows)
        large = few_tasks(large.distinct(), rows)
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        pair = F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))
        small = few_tasks(large.join(small_low, "u"), rows).select(F.explode(pair).alias("e")).select("e.u", "e.v").where("u <> v")
        edges = stored(few_tasks(small.distinct(), rows), name)
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp")).unionAll(
        few_tasks(edges.select(F.col("v").alias("node"), F.col("v").alias("comp")).distinct(), now["n"])
    )


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def hashed(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)
