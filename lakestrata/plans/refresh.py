"""Gold refresh: dependency order, skip when no input moved, incremental views.

V4  refresh_gold          customer_value and daily_revenue, then commercial_summary
V5  skip                  a view whose input versions equal those recorded at
                          its last publish is not recomputed
V6  counting              views moved by the change feeds of their sources;
                          incremental_customer_value recomputes affected customers
V7  change feeds          written with each version (sources.tables); changed_rows
                          compares two snapshots that have none
Q5  daily_revenue is published only if ``gross_revenue >= 0`` holds
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import gold
from ..sources.tables import VersionedTable
from .counting import Advance, CountedGold

# Fixed dependency graph of the gold views, in refresh order.
VIEW_INPUTS = {
    "gold.customer_value": ("silver.orders", "silver.customers"),
    "gold.daily_revenue": ("silver.calendar", "silver.orders"),
    "gold.commercial_summary": ("gold.customer_value", "gold.daily_revenue"),
}
REFRESH_ORDER = tuple(VIEW_INPUTS)


@dataclass
class RefreshOutcome:
    view: str
    decision: str  # "refresh" | "incremental" | "skip"
    version: int | None


def refresh_gold(
    spark: SparkSession,
    tables: dict[str, VersionedTable],
    as_of: date | str | None = None,
    incremental: bool = False,
    state: CountedGold | None = None,
) -> list[RefreshOutcome]:
    """Refresh the three gold views in dependency order.

    ``tables`` maps every name in VIEW_INPUTS (sources and views) to its
    VersionedTable.  With ``incremental`` the views follow the change feeds of
    their sources by counts (:mod:`.counting`): no snapshot of orders is read,
    and a view that is a BucketedTable is written in its touched buckets only.
    ``state`` holds the counts, by default below customer_value.  The first
    incremental refresh, and one after a version without a change feed, builds
    them from the snapshots ("refresh").  A ConstraintViolation from
    daily_revenue stops the run before commercial_summary and leaves the old
    daily_revenue published."""
    outcomes = []
    if as_of is None:
        spark_day = spark.range(1).select(F.current_date().alias("day")).first()
        as_of = spark_day["day"]
    step = None
    for view in REFRESH_ORDER:
        inputs = {name: tables[name].version() for name in VIEW_INPUTS[view]}
        if view == "gold.commercial_summary":
            inputs["as_of"] = str(as_of)  # the view moves with its day, not only with its tables
        table = tables[view]
        current = table.current()
        if current is not None and current[1] == inputs:
            outcomes.append(RefreshOutcome(view, "skip", current[0]))
            continue
        if incremental:
            state = state or CountedGold(spark, f"{tables['gold.customer_value'].root}/_counts")
            if step is None and view != "gold.commercial_summary":
                step = state.advance(tables["silver.orders"], tables["silver.customers"])
            decision = _publish_counted(view, tables, state, step, inputs, as_of)
        else:
            _publish_full(view, tables, inputs, as_of)
            decision = "refresh"
        outcomes.append(RefreshOutcome(view, decision, table.version()))
    return outcomes


def _non_negative() -> dict:
    return {"non_negative_revenue": F.col("gross_revenue") >= 0}


def _publish_full(view: str, tables: dict[str, VersionedTable], inputs: dict, as_of) -> None:
    src = [tables[name].read() for name in VIEW_INPUTS[view]]
    if view == "gold.customer_value":
        tables[view].publish(gold.customer_value(*src), inputs=inputs)
    elif view == "gold.daily_revenue":
        tables[view].publish(gold.daily_revenue(*src), checks=_non_negative(), inputs=inputs)
    else:
        tables[view].publish(gold.commercial_summary(*src, str(as_of)), inputs=inputs)


def _publish_counted(view: str, tables: dict[str, VersionedTable], state: CountedGold, step: Advance | None, inputs: dict, as_of) -> str:
    if view == "gold.customer_value":
        return state.refresh_customer_value(tables[view], step, inputs)
    if view == "gold.daily_revenue":
        tables[view].publish(state.daily_revenue(tables["silver.calendar"].read()), checks=_non_negative(), inputs=inputs)
        return "refresh" if step.affected is None else "incremental"
    rows, decision = state.commercial_summary(tables["gold.customer_value"], tables["gold.daily_revenue"].read(), str(as_of))
    tables[view].publish(rows, inputs=inputs)
    return decision


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """V7: rows present in one snapshot and not (as often) in the other, with
    ``side`` = 'old' | 'new'.  An update shows up once on each side.

    ``exceptAll`` is an aggregation over whole rows (partial counts
    map-side), so duplicated keys never pair up as they would in a join on
    the key, and identical hot rows collapse before the shuffle."""
    return old.exceptAll(new).withColumn("side", F.lit("old")).unionByName(
        new.exceptAll(old).withColumn("side", F.lit("new"))
    )


def order_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Changed order rows with their customer: (order_id, side, customer_id, order_date)."""
    return changed_rows(old, new).select("order_id", "side", "customer_id", "order_date")


def affected_customers(order_change_set: DataFrame, customer_change_set: DataFrame | None = None) -> DataFrame:
    """Customers whose gold.customer_value rows may change: the customer of every
    changed order row on either side (old and new customer of a moved order),
    plus changed customers."""
    keys = order_change_set.select("customer_id")
    if customer_change_set is not None:
        keys = keys.unionByName(customer_change_set.select("customer_id"))
    return keys.where(F.col("customer_id").isNotNull()).distinct()


def incremental_customer_value(
    old_view: DataFrame, new_orders: DataFrame, new_customers: DataFrame, affected: DataFrame
) -> DataFrame:
    """V6: old rows of unaffected customers + V1 recomputed for affected ones.

    Equals the full recomputation for SUM / MIN / MAX / COUNT DISTINCT because
    every output row depends only on its own customer's rows."""
    keep = old_view.join(affected, "customer_id", "left_anti")
    redo = gold.customer_value(
        new_orders.join(affected, "customer_id", "left_semi"),
        new_customers.join(affected, "customer_id", "left_semi"),
    )
    return keep.unionByName(redo)


def refresh_decisions(source_versions: DataFrame) -> DataFrame:
    """V5 over a log of input versions: (tick, table_name, version) ->
    (tick, view, decision).

    A base view refreshes at a tick when any of its inputs has a higher
    version than at the previous tick (the first tick always refreshes); a
    view over views refreshes when any input view refreshed.  Windows are
    partitioned by (view, input), so no window spans the whole log."""
    spark = source_versions.sparkSession
    graph = spark.createDataFrame(
        [(v, i) for v, ins in VIEW_INPUTS.items() for i in ins], "view string, table_name string"
    )
    views = set(VIEW_INPUTS)
    base = graph.where(~F.col("table_name").isin(list(views)))
    from pyspark.sql import Window

    w = Window.partitionBy("view", "table_name").orderBy("tick")
    moved = (
        base.join(source_versions, "table_name")
        .withColumn("_prev", F.lag("version").over(w))
        .withColumn("_moved", F.col("_prev").isNull() | (F.col("version") > F.col("_prev")))
        .groupBy("tick", "view")
        .agg(F.max(F.col("_moved").cast("int")).alias("_m"))
    )
    level1 = moved.select("tick", "view", F.when(F.col("_m") == 1, "refresh").otherwise("skip").alias("decision"))
    upper = graph.where(F.col("table_name").isin(list(views)))
    level2 = (
        upper.join(level1.withColumnRenamed("view", "table_name"), "table_name")
        .groupBy("tick", "view")
        .agg(F.max((F.col("decision") == "refresh").cast("int")).alias("_m"))
        .select("tick", "view", F.when(F.col("_m") == 1, "refresh").otherwise("skip").alias("decision"))
    )
    return level1.unionByName(level2)
