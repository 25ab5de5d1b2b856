"""Commit history, replay detection and run summaries over Bronze rows.

The commit identity (version, run, page) is stored in the rows, so all of
these are aggregations: partial aggregation runs map-side and only one row
per group crosses the network.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def commit_history(bronze: DataFrame) -> DataFrame:
    """One row per commit with its metadata and row count."""
    return bronze.groupBy("commit_version", "ingestion_run_id", "source_page").agg(
        F.count(F.lit(1)).alias("rows"),
        F.min("ingested_at").alias("ingested_at"),
    )


def replayed_events(bronze: DataFrame) -> DataFrame:
    """Q7: events delivered more than once, and the commits that carried them.

    Fixed-size per event (counts and first/last commit and page), so an
    event replayed millions of times still yields one small row; the full
    list stays queryable as ``bronze.where(source_event_id = ...)``."""
    return (
        bronze.groupBy("source_event_id")
        .agg(
            F.count(F.lit(1)).alias("deliveries"),
            F.countDistinct("commit_version").alias("commits"),
            F.min("commit_version").alias("first_commit"),
            F.max("commit_version").alias("last_commit"),
            F.countDistinct("source_page").alias("pages"),
            F.min("source_page").alias("first_page"),
            F.max("source_page").alias("last_page"),
        )
        .where(F.col("deliveries") > 1)
    )


def replay_report(bronze: DataFrame) -> DataFrame:
    """Per page, rows, distinct events, excess duplicates and commits.

    COUNT(DISTINCT) is planned as a two-level aggregate, so a hot page is
    spread over the (page, event) shuffle first."""
    return (
        bronze.groupBy("source_page")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("source_event_id").alias("distinct_events"),
            F.countDistinct("commit_version").alias("commits"),
        )
        .withColumn("duplicate_rows", F.col("rows") - F.col("distinct_events"))
    )


def page_ranges(pages: DataFrame, group_cols: list[str], page_col: str = "source_page") -> DataFrame:
    """Sorted page list per group as compact ranges text, e.g. ``1-4,7,9-12``.

    Gaps-and-islands: ``page - row_number()`` is constant within a run of
    consecutive pages.  The text grows with the number of gaps, not pages."""
    distinct = pages.select(*group_cols, page_col).distinct()
    w = Window.partitionBy(*group_cols).orderBy(page_col)
    islands = (
        distinct.withColumn("_island", F.col(page_col) - F.row_number().over(w))
        .groupBy(*group_cols, "_island")
        .agg(F.min(page_col).alias("_lo"), F.max(page_col).alias("_hi"), F.count(F.lit(1)).alias("_n"))
        .withColumn(
            "_text",
            F.when(F.col("_lo") == F.col("_hi"), F.col("_lo").cast("string")).otherwise(
                F.concat_ws("-", F.col("_lo").cast("string"), F.col("_hi").cast("string"))
            ),
        )
    )
    return islands.groupBy(*group_cols).agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_lo", "_text"))), lambda x: x["_text"]), ",")
        .alias("pages"),
        F.sum("_n").alias("page_count"),
    )


def ingest_summary(bronze: DataFrame) -> DataFrame:
    """Per run, the pages appended (as ranges), versions and rows."""
    per_run = bronze.groupBy("ingestion_run_id").agg(
        F.min("commit_version").alias("first_version"),
        F.max("commit_version").alias("last_version"),
        F.countDistinct("commit_version").alias("commits"),
        F.count(F.lit(1)).alias("rows_appended"),
    )
    ranges = page_ranges(bronze, ["ingestion_run_id"]).withColumnRenamed("pages", "pages_appended")
    return per_run.join(ranges, "ingestion_run_id")
