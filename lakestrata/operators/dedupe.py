"""Keep the newest delivery of each source event.

Order: newest ``source_updated_at``, then newest ``ingested_at`` (NULLs last
for both, as a stable descending sort would leave them), then a total
tie-break (run id, page, payload) so full ties no longer depend on the
physical row order of a distributed read.

``row_number() ... = 1`` is planned by Catalyst with a partial
``WindowGroupLimit`` *before* the shuffle, so a key replayed a million
times sends one row per input partition across the network, not a million.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def envelope_order() -> tuple[Column, ...]:
    return (
        F.col("source_updated_at").desc_nulls_last(),
        F.col("ingested_at").desc_nulls_last(),
        F.col("ingestion_run_id").desc_nulls_last(),
        F.col("source_page").desc_nulls_last(),
        F.col("payload").asc_nulls_last(),
    )


def keep_latest(df: DataFrame, keys: list[str] | tuple[str, ...], order: tuple[Column, ...]) -> DataFrame:
    """Top-1 row per key under ``order`` (generic form of W1)."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") == 1).drop("_rn")


def dedupe_by_source_event(bronze: DataFrame) -> DataFrame:
    return keep_latest(bronze, ["source_event_id"], envelope_order())
