"""Deterministic source pages for tests and the bench, generated with spark.range."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the synthetic paginated source (record formula of the
# reference's test source; see FIXTURES.md section 1).
SOURCE_WINDOW_START = "2026-09-01 08:00:00"
SOURCE_SEED = 187
SLOT_STRIDE = 10007
MINUTES_PER_DAY = 1440
CUSTOMER_MODULUS = 200
STATUS_CYCLE = ["completed", "completed", "cancelled", "Completed", "COMPLETED"]
MARKET_CYCLE = ["DK", "DE", "SE"]


def _pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def _pick(options: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(x) for x in options]), (index + 1).cast("int"))


def source_records(
    spark: SparkSession,
    pages: int,
    page_size: int = 100,
    start_page: int = 1,
    seed: int = SOURCE_SEED,
    dataset: str = "orders",
) -> DataFrame:
    """S2 + F11: the deterministic source as (source_page, value) JSON lines.

    The same (seed, page) always yields the same records, so a retry
    re-delivers byte-identical pages."""
    n = pages * page_size
    r = spark.range(0, n, numPartitions=max(1, min(pages, spark.sparkContext.defaultParallelism)))
    page = (F.lit(start_page) + F.floor(F.col("id") / page_size)).cast("long")
    idx = (F.col("id") % page_size).cast("long")
    r = r.select(page.alias("p"), idx.alias("i")).withColumn("slot", F.col("p") * SLOT_STRIDE + F.col("i"))
    updated = F.timestamp_add("MINUTE", F.col("slot") % MINUTES_PER_DAY, F.lit(SOURCE_WINDOW_START).cast("timestamp"))
    fields = [
        F.concat(F.lit("evt-"), _pad(F.col("p"), 6), F.lit("-"), _pad(F.col("i"), 4)).alias("event_id"),
        F.date_format(updated, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("updated_at"),
    ]
    customer = F.concat(F.lit("CUST-"), _pad((F.lit(seed) + F.col("p") * 7 + F.col("i")) % CUSTOMER_MODULUS, 4))
    if dataset == "customers":
        fields += [customer.alias("customer_id"), _pick(MARKET_CYCLE, F.col("slot") % 3).alias("market")]
    elif dataset == "orders":
        fields += [
            F.concat(F.lit("ORD-"), _pad(F.col("p"), 6), F.lit("-"), _pad(F.col("i"), 4)).alias("order_id"),
            customer.alias("customer_id"),
            F.date_add(F.lit(SOURCE_WINDOW_START).cast("date"), (F.col("p") % 3).cast("int"))
            .cast("string")
            .alias("order_date"),
            _pick(STATUS_CYCLE, F.col("slot") % 5).alias("status"),
            (F.lit(10) + ((F.col("slot") * 37) % 50000) / 100).cast("decimal(12,2)").cast("string").alias("net_amount"),
        ]
    else:
        raise ValueError(f"unknown dataset {dataset!r}")
    return r.select(F.col("p").cast("int").alias("source_page"), F.to_json(F.struct(*fields)).alias("value"))
