"""Bronze -> Silver: dedupe by source event, parse the payload, type the fields.

Rows whose payload cannot be typed are not silently NULLed: each gets a
``reject_reason``.  ``silver_orders`` keeps the good rows, ``silver_rejects``
the bad ones; the publishing job (``plans.silver``) fails when any exist.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..contracts import SILVER_CUSTOMERS, SILVER_ORDERS
from ..functions.parsing import (
    CUSTOMER_FIELDS,
    ORDER_FIELDS,
    json_struct,
    strict_date,
    strict_decimal,
    well_formed,
)
from .dedupe import dedupe_by_source_event, keep_latest

REJECT = "reject_reason"


def _first_failure(checks: list[tuple[object, str]]):
    reason = F.lit(None).cast("string")
    for ok, label in reversed(checks):
        reason = F.when(~F.coalesce(ok, F.lit(False)), F.lit(label)).otherwise(reason)
    return reason


def parse_orders(bronze: DataFrame) -> DataFrame:
    """Typed order columns + ``reject_reason`` (NULL when the row is good)."""
    p = json_struct("payload", ORDER_FIELDS)
    parsed = bronze.select(
        "source_event_id",
        "source_page",
        "payload",
        p.alias("_p"),
        "source_updated_at",
        "ingested_at",
        "ingestion_run_id",
    ).select(
        "*",
        strict_date("_p.order_date").alias("_date"),
        strict_decimal("_p.net_amount").alias("_amount"),
    )
    reason = _first_failure(
        [
            (well_formed("_p"), "malformed_json"),
            (F.col("_p.order_id").isNotNull(), "missing_order_id"),
            (F.col("_p.customer_id").isNotNull(), "missing_customer_id"),
            (F.col("_date").isNotNull(), "bad_order_date"),
            (F.col("_p.status").isNotNull(), "missing_status"),
            (F.col("_amount").isNotNull(), "bad_net_amount"),
        ]
    )
    return parsed.select(
        F.col("_p.order_id").alias("order_id"),
        F.col("_p.customer_id").alias("customer_id"),
        F.col("_date").alias("order_date"),
        F.lower("_p.status").alias("order_status"),
        F.col("_amount").alias("net_amount"),
        "source_updated_at",
        "ingestion_run_id",
        "ingested_at",
        "source_event_id",
        "source_page",
        "payload",
        reason.alias(REJECT),
    )


def parse_customers(bronze: DataFrame) -> DataFrame:
    """P5: typed customer columns + ``reject_reason``."""
    p = json_struct("payload", CUSTOMER_FIELDS)
    parsed = bronze.select(
        "source_event_id", "source_page", "payload", p.alias("_p"), "source_updated_at", "ingested_at", "ingestion_run_id"
    )
    reason = _first_failure(
        [
            (well_formed("_p"), "malformed_json"),
            (F.col("_p.customer_id").isNotNull(), "missing_customer_id"),
            (F.col("_p.market").isNotNull(), "missing_market"),
        ]
    )
    return parsed.select(
        F.col("_p.customer_id").alias("customer_id"),
        F.col("_p.market").alias("market"),
        "source_updated_at",
        "ingestion_run_id",
        "ingested_at",
        "source_event_id",
        "source_page",
        "payload",
        reason.alias(REJECT),
    )


def _good(parsed: DataFrame, names: list[str]) -> DataFrame:
    return parsed.where(F.col(REJECT).isNull()).select(*names)


def _bad(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(REJECT).isNotNull()).select("source_event_id", "source_page", "payload", REJECT)


def silver_orders(bronze: DataFrame) -> DataFrame:
    return _good(parse_orders(dedupe_by_source_event(bronze)), SILVER_ORDERS.names)


def silver_order_rejects(bronze: DataFrame) -> DataFrame:
    return _bad(parse_orders(dedupe_by_source_event(bronze)))


def silver_customers(bronze: DataFrame, enforce_grain: bool = False) -> DataFrame:
    """Faithful by default: dedupe by source event only, so a customer seen in
    several events keeps several rows (the declared grain is then violated and
    ``operators.quality.grain_violations`` reports it).  ``enforce_grain``
    keeps the newest row per customer_id instead."""
    good = _good(parse_customers(dedupe_by_source_event(bronze)), SILVER_CUSTOMERS.names + ["source_event_id"])
    if enforce_grain:
        good = keep_latest(
            good,
            ["customer_id"],
            (F.col("source_updated_at").desc_nulls_last(), F.col("source_event_id").desc_nulls_last()),
        )
    return good.select(*SILVER_CUSTOMERS.names)


def silver_customer_rejects(bronze: DataFrame) -> DataFrame:
    return _bad(parse_customers(dedupe_by_source_event(bronze)))
