"""V6 by counting: the Gold views kept up to date from change feeds alone.

Beside the views stands a state of multiset counts, in tables bucketed by
their key:

=================  ===========================  =================================
table              key                          values
=================  ===========================  =================================
order pairs        (customer_id, order_id)      completed rows
order dates        (customer_id, order_date)    completed rows
customer totals    customer_id                  rows, amounts, sum, distinct
                                                orders, first and latest date
customer markets   (customer_id, market)        customer rows
day pairs          (order_date, order_id)       completed rows
days               order_date                   as customer totals, without dates
markets            market                       customers, amounts, sum
=================  ===========================  =================================

A signed change (:mod:`..sources.tables`) moves the counts:

* SUM and COUNT by adding;
* COUNT(DISTINCT) of a group by the pairs whose count leaves or reaches zero;
* MIN / MAX by the dates that arrive; only where the extreme itself leaves
  are the customer's dates read again (never its orders).

Only buckets of touched keys are read and written, so the work follows the
delta.  A customer or day with a third of all orders has one row of totals, at
most one date row per day, and pairs that are spread over all buckets.

All state tables record the Silver versions they stand for.  Where they
disagree, after a run that broke off between two of them, or where a feed is
missing, the state is rebuilt from the snapshots.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold
from ..session import scratch_dir
from ..sources.buckets import DEFAULT_BUCKETS, BucketedTable
from ..sources.tables import WEIGHT, NoChangeFeed, VersionedTable, net_changes

ORDER_COLUMNS = ("customer_id", "order_id", "order_date", "net_amount")
INPUTS = ("silver.orders", "silver.customers")
SUM_TYPE = "decimal(28,2)"


def _kept(df: DataFrame, name: str) -> DataFrame:
    """A delta-sized table written once, for the several readers it has."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def weighted(rows: DataFrame) -> DataFrame:
    return rows.withColumn(WEIGHT, F.lit(1).cast("long"))


def counted(signed: DataFrame, *keys: str) -> DataFrame:
    """Summed weights ``n`` by key; null keys stay out, as they join and count nowhere."""
    return signed.dropna(subset=list(keys)).groupBy(*keys).agg(F.sum(WEIGHT).alias("n"))


def totals(signed: DataFrame, key: str) -> DataFrame:
    """Rows, non-null amounts and their sum by key."""
    w = F.col(WEIGHT)
    return signed.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.sum(w).alias("n"),
        F.sum(F.when(F.col("net_amount").isNotNull(), w).otherwise(F.lit(0))).alias("amounts"),
        F.coalesce(F.sum(F.col("net_amount") * w), F.lit(0)).cast(SUM_TYPE).alias("paid"),
    )


def with_before(delta: DataFrame, state: DataFrame, keys: list[str]) -> DataFrame:
    """Delta counts with the counts before (``was``) and after (``now``)."""
    was = state.select(*keys, F.col("n").alias("was"))
    joined = delta.join(was, keys, "left").withColumn("was", F.coalesce("was", F.lit(0).cast("long")))
    return joined.withColumn("now", F.col("was") + F.col("n"))


def merged(state: DataFrame, delta: DataFrame, keys: list[str]) -> DataFrame:
    """Counts of the state after the delta; what fell to zero is gone."""
    return state.select(*keys, "n").unionByName(delta.select(*keys, "n")).groupBy(*keys).agg(F.sum("n").alias("n")).where("n <> 0")


def distinct_moves(moved: DataFrame, group: str) -> DataFrame:
    """Change of COUNT(DISTINCT) by group, from the pairs' counts before and after."""
    step = (F.col("now") > 0).cast("long") - (F.col("was") > 0).cast("long")
    return moved.groupBy(group).agg(F.sum(step).alias("orders"))


def _sum_or_null() -> Column:
    return F.when(F.col("amounts") > 0, F.col("paid"))


@dataclass
class Advance:
    """What one step did: from which Silver versions, and whose rows it touched (None: rebuilt)."""

    before: dict | None
    affected: DataFrame | None


class CountedGold:
    """State of the incremental views in tables below ``root``."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = DEFAULT_BUCKETS):
        def table(name, *keys):
            return BucketedTable(spark, f"{root}/{name}", keys, buckets)

        self.spark, self.buckets = spark, buckets
        self.order_pairs = table("order_pairs", "customer_id", "order_id")
        self.order_dates = table("order_dates", "customer_id")
        self.customer_totals = table("customer_totals", "customer_id")
        self.customer_markets = table("customer_markets", "customer_id")
        self.day_pairs = table("day_pairs", "order_date", "order_id")
        self.days = VersionedTable(spark, f"{root}/days")
        self.markets = VersionedTable(spark, f"{root}/markets")

    @property
    def _silver_state(self) -> list[VersionedTable]:
        return [self.order_pairs, self.order_dates, self.customer_totals, self.customer_markets, self.day_pairs, self.days]

    def inputs(self) -> dict | None:
        """Silver versions that the whole state stands for; None if it doesn't stand for one pair of them."""
        found = [t.current() for t in self._silver_state]
        if any(f is None for f in found) or any(f[1] != found[0][1] for f in found):
            return None
        return found[0][1]

    # ------------------------------------------------------------ state
    def advance(self, orders: VersionedTable, customers: VersionedTable) -> Advance:
        """Bring the state to the current Silver versions, by their feeds if they have them."""
        target = dict(zip(INPUTS, (orders.version(), customers.version()), strict=True))
        before = self.inputs()
        if before == target:
            return Advance(before, self.spark.createDataFrame([], "customer_id string"))
        if before is not None:
            try:
                feeds = [t.changes(before[n], target[n]) for t, n in ((orders, INPUTS[0]), (customers, INPUTS[1]))]
            except NoChangeFeed:
                before = None
        if before is None:
            self.rebuild(orders.read(), customers.read(), target)
            return Advance(None, None)
        return Advance(before, self.apply(*feeds, target))

    def rebuild(self, orders: DataFrame, customers: DataFrame, inputs: dict) -> None:
        """The state of whole snapshots."""
        done = weighted(gold.completed_orders(orders).select(*ORDER_COLUMNS))
        pairs, dates = counted(done, "customer_id", "order_id"), counted(done, "customer_id", "order_date")
        self.order_pairs.publish(pairs, inputs=inputs)
        self.order_dates.publish(dates, inputs=inputs)
        distinct = self.order_pairs.read().groupBy("customer_id").agg(F.count("*").alias("orders"))
        extremes = self.order_dates.read().groupBy("customer_id").agg(
            F.min("order_date").alias("first_order_date"), F.max("order_date").alias("latest_order_date")
        )
        by_customer = totals(done, "customer_id").join(distinct, "customer_id", "left").join(extremes, "customer_id", "left")
        self.customer_totals.publish(by_customer.fillna(0, ["orders"]), inputs=inputs)
        self.customer_markets.publish(self._market_counts(weighted(customers.select("customer_id", "market"))), inputs=inputs)
        self.day_pairs.publish(counted(done, "order_date", "order_id"), inputs=inputs)
        by_day = self.day_pairs.read().groupBy("order_date").agg(F.count("*").alias("orders"))
        self.days.publish(totals(done, "order_date").join(by_day, "order_date", "left").fillna(0, ["orders"]), inputs=inputs)

    @staticmethod
    def _market_counts(signed: DataFrame) -> DataFrame:
        """Customer rows by (customer_id, market); nulls are groups of their own, as in the view."""
        return signed.groupBy("customer_id", "market").agg(F.sum(WEIGHT).alias("n")).where("n <> 0")

    def order_delta(self, order_changes: DataFrame) -> DataFrame:
        """Net change of completed order rows."""
        return net_changes(gold.completed_orders(order_changes).select(*ORDER_COLUMNS, WEIGHT))

    def apply(self, order_changes: DataFrame, customer_changes: DataFrame, inputs: dict) -> DataFrame:
        """Move the state by two feeds; the customers whose view rows may have changed."""
        delta = _kept(self.order_delta(order_changes), "gold-order-delta")
        moves = _kept(self._market_counts(customer_changes.select("customer_id", "market", WEIGHT)), "gold-customer-delta")

        pairs = counted(delta, "customer_id", "order_id")
        in_pairs = self.order_pairs.touched(pairs)
        old_pairs = self.order_pairs.read(only=in_pairs)
        distinct = distinct_moves(with_before(pairs, old_pairs, ["customer_id", "order_id"]), "customer_id")

        dates = counted(delta, "customer_id", "order_date")
        by_customer = totals(delta, "customer_id")
        in_customers = self.customer_totals.touched(by_customer)
        old_dates = self.order_dates.read(only=in_customers)
        new_dates = merged(old_dates, dates, ["customer_id", "order_date"])
        rows = self._moved_totals(self.customer_totals.read(only=in_customers), by_customer, distinct, with_before(dates, old_dates, ["customer_id", "order_date"]), new_dates)
        new_totals = _kept(rows, "gold-customer-totals")

        day_pairs = counted(delta, "order_date", "order_id")
        in_days = self.day_pairs.touched(day_pairs)
        old_days = self.day_pairs.read(only=in_days)
        day_distinct = distinct_moves(with_before(day_pairs, old_days, ["order_date", "order_id"]), "order_date")
        day_rows = self.days.read().unionByName(totals(delta, "order_date").join(day_distinct, "order_date", "left").fillna(0, ["orders"]))
        day_rows = day_rows.groupBy("order_date").agg(*(F.sum(c).cast(t).alias(c) for c, t in (("n", "long"), ("amounts", "long"), ("paid", SUM_TYPE), ("orders", "long"))))

        in_markets = self.customer_markets.touched(moves)
        self.order_pairs.replace(merged(old_pairs, pairs, ["customer_id", "order_id"]), in_pairs, inputs)
        self.order_dates.replace(new_dates, in_customers, inputs)
        self.customer_totals.replace(new_totals, in_customers, inputs)
        self.customer_markets.replace(merged(self.customer_markets.read(only=in_markets), moves, ["customer_id", "market"]), in_markets, inputs)
        self.day_pairs.replace(merged(old_days, day_pairs, ["order_date", "order_id"]), in_days, inputs)
        self.days.publish(day_rows.where("n <> 0"), inputs=inputs)
        return by_customer.select("customer_id").unionByName(moves.select("customer_id")).distinct()

    def _moved_totals(self, old: DataFrame, delta: DataFrame, distinct: DataFrame, dates: DataFrame, new_dates: DataFrame) -> DataFrame:
        """Customer totals of the touched buckets after the delta."""
        arrived = dates.where("now > 0").groupBy("customer_id").agg(F.min("order_date").alias("lo"), F.max("order_date").alias("hi"))
        # dates that end lie inside the old range, so the outermost of them show whether an extreme left
        ended = dates.where("now <= 0").groupBy("customer_id").agg(F.min("order_date").alias("end_lo"), F.max("order_date").alias("end_hi"))
        joined = (
            delta.select("customer_id", F.col("n").alias("d_n"), F.col("amounts").alias("d_amounts"), F.col("paid").alias("d_paid"))
            .join(distinct.withColumnRenamed("orders", "d_orders"), "customer_id", "left")
            .join(arrived, "customer_id", "left").join(ended, "customer_id", "left").join(old, "customer_id", "left")
            .withColumn("redo", F.expr("coalesce(end_lo = first_order_date, false) or coalesce(end_hi = latest_order_date, false)"))
        )
        redo = new_dates.join(joined.where("redo").select("customer_id"), "customer_id", "left_semi").groupBy("customer_id").agg(
            F.min("order_date").alias("again_lo"), F.max("order_date").alias("again_hi")
        )
        now = joined.join(redo, "customer_id", "left").select(
            "customer_id",
            *(
                (F.coalesce(c, F.lit(0)) + F.coalesce(f"d_{c}", F.lit(0))).cast(t).alias(c)
                for c, t in (("n", "long"), ("amounts", "long"), ("paid", SUM_TYPE), ("orders", "long"))
            ),
            F.expr("if(redo, again_lo, least(first_order_date, lo))").alias("first_order_date"),
            F.expr("if(redo, again_hi, greatest(latest_order_date, hi))").alias("latest_order_date"),
        )
        untouched = old.join(delta.select("customer_id"), "customer_id", "left_anti")
        return untouched.select(*now.columns).unionByName(now.where("n <> 0"))

    # ------------------------------------------------------------ views
    def customer_value(self, affected: DataFrame | None = None) -> DataFrame:
        """V1 from the state, for the affected customers or for all."""
        only = None
        if affected is not None:
            only = self.customer_markets.touched(affected)
        groups, per_customer = self.customer_markets.read(only=only), self.customer_totals.read(only=only)
        if affected is not None:
            groups = groups.join(affected.withColumnRenamed("customer_id", "_id"), F.col("customer_id").eqNullSafe(F.col("_id")), "left_semi")
        paid = per_customer.select("customer_id", "first_order_date", "latest_order_date", "orders", _sum_or_null().alias("_sum"))
        return groups.join(paid, "customer_id", "left").select(
            "customer_id",
            "market",
            "first_order_date",
            "latest_order_date",
            (F.col("_sum") * F.col("n")).cast(gold.REVENUE_TYPE).alias("lifetime_net_revenue"),
            F.coalesce("orders", F.lit(0).cast("long")).alias("completed_orders"),
        )

    def refresh_customer_value(self, view: VersionedTable, step: Advance, inputs: dict) -> str:
        """Publish V1 with its change feed; only the affected rows are computed, if the view stood where the state did."""
        current = view.current()
        if step.affected is None or current is None or current[1] != step.before:
            view.publish(self.customer_value(), inputs=inputs, changes=True if current is not None else None)
            return "refresh"
        new = _kept(self.customer_value(step.affected), "gold-customer-value")
        by_bucket = isinstance(view, BucketedTable)
        touched = view.touched(step.affected) if by_bucket else None
        old = view.read(current[0], only=touched) if by_bucket else view.read(current[0])
        names = new.columns
        ids = step.affected.withColumnRenamed("customer_id", "_id")
        same = F.col("customer_id").eqNullSafe(F.col("_id"))
        signed = weighted(new).unionByName(old.select(*names).join(ids, same, "left_semi").withColumn(WEIGHT, F.lit(-1).cast("long")))
        rows = old.select(*names).join(ids, same, "left_anti").unionByName(new)
        changes = net_changes(signed)
        if by_bucket:
            view.replace(rows, touched, inputs=inputs, changes=changes)
        else:
            view.publish(rows, inputs=inputs, changes=changes)
        return "incremental"

    def daily_revenue(self, calendar: DataFrame) -> DataFrame:
        """V2 from one row per day; a new calendar needs no order either."""
        days = calendar.groupBy("calendar_date").agg(F.count(F.lit(1)).alias("_n"))
        per_day = self.days.read().select(F.col("order_date").alias("calendar_date"), "orders", _sum_or_null().alias("_sum"))
        return days.join(per_day, "calendar_date", "left").select(
            "calendar_date",
            F.coalesce("orders", F.lit(0).cast("long")).alias("order_count"),
            F.coalesce((F.col("_sum") * F.col("_n")).cast(gold.REVENUE_TYPE), F.lit(0).cast(gold.REVENUE_TYPE)).alias("gross_revenue"),
        )

    def commercial_summary(self, view: VersionedTable, daily: DataFrame, as_of) -> tuple[DataFrame, str]:
        """V3 from counts by market, moved by the change feed of V1, and the daily rows of the window."""
        version, current = view.version(), self.markets.current()
        decision, signed = "incremental", None
        if current is not None:
            try:
                signed = view.changes(current[1].get("gold.customer_value"), version)
            except NoChangeFeed:
                current = None
        if current is None:
            decision, signed = "refresh", weighted(view.read(version))
        if current is None or current[1].get("gold.customer_value") != version:
            w, paid = F.col(WEIGHT), F.col("lifetime_net_revenue")
            moved = signed.groupBy("market").agg(
                F.sum(w).alias("n"),
                F.sum(F.when(F.col("customer_id").isNotNull(), w).otherwise(F.lit(0))).alias("customers"),
                F.sum(F.when(paid.isNotNull(), w).otherwise(F.lit(0))).alias("amounts"),
                F.coalesce(F.sum(paid * w), F.lit(0)).cast(gold.SUMMARY_REVENUE_TYPE).alias("paid"),
            )
            if current is not None:
                moved = self.markets.read(current[0]).unionByName(moved).groupBy("market").agg(
                    *(F.sum(c).alias(c) for c in ("n", "customers", "amounts")), F.sum("paid").cast(gold.SUMMARY_REVENUE_TYPE).alias("paid")
                )
            self.markets.publish(moved.where("n <> 0"), inputs={"gold.customer_value": version})
        rows = self.markets.read().select("market", "customers", _sum_or_null().alias("lifetime_net_revenue"))
        return rows.withColumn("revenue_last_30_days", gold.last_30_days_revenue(daily, as_of).scalar()), decision
