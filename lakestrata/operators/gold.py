"""Gold views: customer value, daily revenue, commercial summary.

Each view has the semantics of a LEFT JOIN followed by GROUP BY, but is
planned so that no hot key can pile into one task:

* the fact side (orders) is aggregated *before* the join; its partial
  aggregation runs map-side, and COUNT(DISTINCT order_id) is planned by
  Catalyst as a two-level aggregate whose first shuffle is on
  (key, order_id), so a key holding a third of all orders is still spread;
* the dimension side is reduced to one row per output group with a
  multiplicity ``n_rows`` before the join, so duplicated dimension rows
  (an unenforced grain) still fan the SUM out exactly as the plain join
  would: SUM over the joined rows = n_rows * SUM over the group's orders.
  MIN, MAX and COUNT(DISTINCT) are unaffected by that fan-out.

After pre-aggregation the join is one-to-at-most-one on the key, and the
orders side is already hash-partitioned on it, so only the reduced
dimension side moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

COMPLETED = "completed"
REVENUE_TYPE = T.DecimalType(28, 2)
SUMMARY_REVENUE_TYPE = T.DecimalType(38, 2)


def completed_orders(orders: DataFrame) -> DataFrame:
    """The right side of both gold joins: the status predicate of the ON clause.

    Filtering the right side before a LEFT JOIN is equivalent to keeping the
    predicate in ON; it must never become a WHERE on the joined result."""
    return orders.where(F.col("order_status") == F.lit(COMPLETED))


def _fan_out(total: Column, n_rows: Column) -> Column:
    return (total * n_rows).cast(REVENUE_TYPE)


def customer_value(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """gold.customer_value: customers LEFT JOIN completed orders, per (customer_id, market)."""
    per_customer = (
        completed_orders(orders)
        .groupBy("customer_id")
        .agg(
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("latest_order_date"),
            F.sum("net_amount").alias("_order_sum"),
            F.countDistinct("order_id").alias("_order_count"),
        )
    )
    groups = customers.groupBy("customer_id", "market").agg(F.count(F.lit(1)).alias("_n_rows"))
    return groups.join(per_customer, "customer_id", "left").select(
        "customer_id",
        "market",
        "first_order_date",
        "latest_order_date",
        _fan_out(F.col("_order_sum"), F.col("_n_rows")).alias("lifetime_net_revenue"),
        F.coalesce(F.col("_order_count"), F.lit(0).cast("long")).alias("completed_orders"),
    )


def daily_revenue(calendar: DataFrame, orders: DataFrame) -> DataFrame:
    """gold.daily_revenue: every calendar day, zero-revenue days included."""
    per_day = (
        completed_orders(orders)
        .groupBy(F.col("order_date").alias("calendar_date"))
        .agg(
            F.countDistinct("order_id").alias("_order_count"),
            F.sum("net_amount").alias("_order_sum"),
        )
    )
    days = calendar.groupBy("calendar_date").agg(F.count(F.lit(1)).alias("_n_rows"))
    return days.join(per_day, "calendar_date", "left").select(
        "calendar_date",
        F.coalesce(F.col("_order_count"), F.lit(0).cast("long")).alias("order_count"),
        F.coalesce(_fan_out(F.col("_order_sum"), F.col("_n_rows")), F.lit(0).cast(REVENUE_TYPE)).alias(
            "gross_revenue"
        ),
    )


def last_30_days_revenue(daily: DataFrame, as_of: Column | str | None = None) -> DataFrame:
    """One-row global aggregate: revenue of calendar dates >= as_of - 30 days.

    Inclusive lower bound, no upper bound (future dates count), NULL when no
    date qualifies."""
    as_of_col = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    return daily.where(F.col("calendar_date") >= F.date_sub(as_of_col, 30)).agg(
        F.sum("gross_revenue").cast(SUMMARY_REVENUE_TYPE).alias("revenue_last_30_days")
    )


def commercial_summary(
    customer_value_df: DataFrame, daily: DataFrame, as_of: Column | str | None = None
) -> DataFrame:
    """gold.commercial_summary: per market, plus the last-30-days scalar.

    The scalar is attached as an uncorrelated scalar subquery (evaluated once,
    then inlined as a literal) instead of a cross join."""
    last_30 = last_30_days_revenue(daily, as_of)
    return (
        customer_value_df.groupBy("market")
        .agg(
            F.countDistinct("customer_id").alias("customers"),
            F.sum("lifetime_net_revenue").cast(SUMMARY_REVENUE_TYPE).alias("lifetime_net_revenue"),
        )
        .withColumn("revenue_last_30_days", last_30.scalar())
    )


def calendar_spine(start: Column | str, end: Column | str) -> Column:
    """A date spine expression, one row per day from start to end inclusive."""
    s = F.lit(start).cast("date") if isinstance(start, str) else start
    e = F.lit(end).cast("date") if isinstance(end, str) else end
    return F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("calendar_date")


def calendar_from(df: DataFrame, date_col: str) -> DataFrame:
    """Date spine covering the range of ``date_col`` in ``df``.

    The bounds come from a one-row global aggregate; the spine itself is
    bounded by the number of days in that range."""
    bounds = df.agg(F.min(date_col).alias("_lo"), F.max(date_col).alias("_hi"))
    return bounds.where(F.col("_lo").isNotNull()).select(calendar_spine(F.col("_lo"), F.col("_hi")))
