"""Landed source pages: JSON-lines text files, one directory per page.

Layout: ``<landing>/source_page=<p>/*.txt``; each line is one source record.
Batch reads get ``source_page`` from partition discovery, so a filter on
pages prunes whole directories; the streaming reader takes it from the file
path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_pages(spark: SparkSession, landing: str) -> DataFrame:
    """(value, source_page) over every landed page."""
    return spark.read.text(landing).select("value", F.col("source_page").cast("int").alias("source_page"))


def read_page_dirs(spark: SparkSession, landing: str, pages: list[int]) -> DataFrame:
    """(value, source_page) of the given page directories only (no listing of the rest)."""
    if not pages:
        return spark.createDataFrame([], "value string, source_page int")
    paths = [f"{landing}/source_page={p}" for p in pages]
    df = spark.read.option("basePath", landing).text(paths)
    return df.select("value", F.col("source_page").cast("int").alias("source_page"))


def write_pages(records: DataFrame, landing: str, mode: str = "append") -> None:
    """Land (source_page, value) rows as one directory per page."""
    records.select("source_page", "value").write.mode(mode).partitionBy("source_page").text(landing)
