"""Adapters: the driver's TPC-H-like tables re-shaped into the pipeline's domain.

* ``orders``   -> silver.orders shape    (order id, customer, date, status, amount)
* ``customer`` -> silver.customers shape (customer id, market)
* ``events``   -> source records / Bronze rows, ``event_id // 250 + 1`` as the page

All are plain projections, so Catalyst prunes the scan to the columns used
and pushes any later filter into the Parquet reader.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table_path

# Fixed values of the adapter fixtures.
PAGE_SIZE = 250
RUN_ID = "RUN-0187"
REPLAYED_PAGES = (3, 7)
FIRST_INGEST = "2024-02-01 00:00:00"
STATUS_BY_CODE = {"F": "completed", "O": "open"}  # anything else: cancelled


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def orders_as_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    status = (
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when(F.col("o_orderstatus") == "O", F.lit("open"))
        .otherwise(F.lit("cancelled"))
    )
    return o.select(
        F.col("o_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("o_orderdate").cast("date").alias("order_date"),
        status.alias("order_status"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("net_amount"),
    )


def customers_as_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("customer_id"),
        F.col("c_mktsegment").alias("market"),
    )


def event_page(event_id: str = "event_id"):
    return (F.floor(F.col(event_id) / PAGE_SIZE).cast("int") + 1).alias("source_page")


def events_as_bronze(
    spark: SparkSession,
    sf_dir: str,
    replayed_pages: tuple[int, ...] = REPLAYED_PAGES,
    run_id: str = RUN_ID,
) -> DataFrame:
    """Bronze rows for ``events``: one delivery of every page, plus a second
    delivery (attempt 1, one hour later, same run id) of ``replayed_pages``,
    the replay-visible ghost retry.

    ``commit_version``: first deliveries take ``page - 1``; replays follow the
    last page in the order listed (the max page is an uncorrelated scalar
    subquery, not a window over all rows)."""
    ev = read(spark, sf_dir, "events")
    base = ev.select(
        F.col("event_id").cast("string").alias("source_event_id"),
        F.col("ts").cast("timestamp").alias("source_updated_at"),
        F.lit(run_id).alias("ingestion_run_id"),
        event_page(),
        F.col("props").alias("payload"),
    )
    first = base.select(
        "*",
        F.lit(FIRST_INGEST).cast("timestamp").alias("ingested_at"),
        (F.col("source_page") - 1).cast("long").alias("commit_version"),
    )
    if not replayed_pages:
        return first
    max_page = base.agg(F.max("source_page")).scalar()
    position = F.lit(None).cast("int")
    for i, p in enumerate(replayed_pages):
        position = F.when(F.col("source_page") == p, F.lit(i)).otherwise(position)
    replay = base.where(F.col("source_page").isin(list(replayed_pages))).select(
        "*",
        (F.lit(FIRST_INGEST).cast("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("ingested_at"),
        (max_page + position).cast("long").alias("commit_version"),
    )
    return first.unionByName(replay)


def iso_utc(ts_col) -> "F.Column":
    """ISO-8601 text with a ``Z`` suffix, as the source API emits timestamps."""
    return F.date_format(ts_col, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def events_as_landing(spark: SparkSession, sf_dir: str, defects: bool = True) -> DataFrame:
    """Landed JSON-lines records for ``events``: (source_page, value).

    With ``defects`` a record loses its ``event_id`` (empty string) when it is
    an ``error`` event worth less than 1.0: the malformed-source case for
    page validation."""
    ev = read(spark, sf_dir, "events")
    blank = (F.col("event_type") == "error") & (F.col("value") < 1.0) & F.lit(defects)
    record = F.struct(
        F.when(blank, F.lit("")).otherwise(F.col("event_id").cast("string")).alias("event_id"),
        iso_utc(F.col("ts")).alias("updated_at"),
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_type").alias("event_type"),
        F.col("value").cast("string").alias("value"),
    )
    return ev.select(event_page(), F.to_json(record).alias("value"))


def _status_text() -> "F.Column":
    """Order status as the source spells it: mixed case by priority class."""
    base = (
        F.when(F.col("o_orderstatus") == "F", F.lit("completed"))
        .when(F.col("o_orderstatus") == "O", F.lit("open"))
        .otherwise(F.lit("cancelled"))
    )
    return (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.upper(base))
        .when(F.col("o_orderpriority") == "2-HIGH", F.initcap(base))
        .otherwise(base)
    )


def orders_as_bronze(spark: SparkSession, sf_dir: str, defects: bool = False, run_id: str = RUN_ID) -> DataFrame:
    """Bronze deliveries of ``orders`` as JSON payloads (all fields text).

    Every order is delivered once, stamped 12 hours after its order date.
    Open orders are delivered again a day later as ``completed`` (a genuine
    update that Silver must keep because it is newer).  With ``defects``,
    ``5-LOW`` orders carry an unpadded date and ``4-NOT SPECIFIED`` pending
    orders an amount with three decimals: both must be rejected."""
    o = read(spark, sf_dir, "orders")
    date_text = F.date_format("o_orderdate", "yyyy-MM-dd")
    amount_text = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    if defects:
        date_text = F.when(
            F.col("o_orderpriority") == "5-LOW", F.date_format("o_orderdate", "yyyy-M-d")
        ).otherwise(date_text)
        amount_text = F.when(
            (F.col("o_orderpriority") == "4-NOT SPECIFIED") & (F.col("o_orderstatus") == "P"),
            F.concat(amount_text, F.lit("5")),
        ).otherwise(amount_text)
    first = o.select(
        F.concat(F.lit("ord-"), F.col("o_orderkey").cast("string")).alias("source_event_id"),
        (F.col("o_orderdate").cast("timestamp") + F.expr("INTERVAL 12 HOURS")).alias("source_updated_at"),
        F.lit(FIRST_INGEST).cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("ingestion_run_id"),
        (F.floor(F.col("o_orderkey") / 1000).cast("int") + 1).alias("source_page"),
        F.col("o_orderkey").cast("string").alias("_order_id"),
        F.col("o_custkey").cast("string").alias("_customer_id"),
        date_text.alias("_date"),
        _status_text().alias("_status"),
        amount_text.alias("_amount"),
        F.col("o_orderstatus"),
    )
    update = first.where(F.col("o_orderstatus") == "O").select(
        "source_event_id",
        (F.col("source_updated_at") + F.expr("INTERVAL 1 DAY")).alias("source_updated_at"),
        (F.col("ingested_at") + F.expr("INTERVAL 1 DAY")).alias("ingested_at"),
        "ingestion_run_id",
        "source_page",
        "_order_id",
        "_customer_id",
        "_date",
        F.lit("completed").alias("_status"),
        "_amount",
        "o_orderstatus",
    )
    payload = F.to_json(
        F.struct(
            F.col("_order_id").alias("order_id"),
            F.col("_customer_id").alias("customer_id"),
            F.col("_date").alias("order_date"),
            F.col("_status").alias("status"),
            F.col("_amount").alias("net_amount"),
        )
    )
    return first.unionByName(update).select(
        "source_event_id",
        "source_updated_at",
        "ingested_at",
        "ingestion_run_id",
        "source_page",
        payload.alias("payload"),
    )


def customers_as_bronze(spark: SparkSession, sf_dir: str, run_id: str = RUN_ID) -> DataFrame:
    """Bronze deliveries of ``customer``: one event per customer, payload JSON text."""
    c = read(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("cust-"), F.col("c_custkey").cast("string")).alias("source_event_id"),
        F.lit("2024-01-15 00:00:00").cast("timestamp").alias("source_updated_at"),
        F.lit(FIRST_INGEST).cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("ingestion_run_id"),
        (F.floor(F.col("c_custkey") / 100).cast("int") + 1).alias("source_page"),
        F.to_json(
            F.struct(
                F.col("c_custkey").cast("string").alias("customer_id"),
                F.col("c_mktsegment").alias("market"),
            )
        ).alias("payload"),
    )


def events_as_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with an unenforced grain: one row per event, user as the
    customer and event type as the market (150 users, 5 markets)."""
    ev = read(spark, sf_dir, "events")
    return ev.select(
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("event_type").alias("market"),
        F.col("ts").cast("timestamp").alias("source_updated_at"),
        F.col("event_id").cast("string").alias("source_event_id"),
    )
