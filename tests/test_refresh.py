"""Versioned tables, CHECK-then-publish, refresh order, skip, incremental = full."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata.contracts import ConstraintViolation
from lakestrata.operators import gold
from lakestrata.plans import refresh as R
from lakestrata.sources import adapters as A
from lakestrata.sources.tables import VersionedTable

from conftest import SF001


def _orders(spark, rows):
    return spark.createDataFrame(
        [(o, c, __import__("datetime").date.fromisoformat(d), s, Decimal(a)) for o, c, d, s, a in rows],
        "order_id string, customer_id string, order_date date, order_status string, net_amount decimal(18,2)",
    )


def _tables(spark, workdir, orders, customers, calendar):
    names = list(R.VIEW_INPUTS) + ["silver.orders", "silver.customers", "silver.calendar"]
    t = {n: VersionedTable(spark, f"{workdir}/{n}") for n in names}
    t["silver.orders"].publish(orders)
    t["silver.customers"].publish(customers)
    t["silver.calendar"].publish(calendar)
    return t


def test_refresh_order_skip_and_failed_check(spark, workdir):
    orders = _orders(spark, [("o1", "c1", "2026-09-01", "completed", "10.00"), ("o2", "c2", "2026-09-02", "cancelled", "5.00")])
    customers = spark.createDataFrame([("c1", "DK"), ("c2", "DE"), ("c3", "SE")], "customer_id string, market string")
    cal = spark.range(1).select(gold.calendar_spine("2026-09-01", "2026-09-03"))
    t = _tables(spark, workdir, orders, customers, cal)

    first = R.refresh_gold(spark, t, as_of="2026-09-03")
    assert [o.decision for o in first] == ["refresh"] * 3
    cv = {r.customer_id: r for r in t["gold.customer_value"].read().collect()}
    assert cv["c1"].lifetime_net_revenue == Decimal("10.00") and cv["c3"].lifetime_net_revenue is None
    assert cv["c3"].completed_orders == 0
    dr = {str(r.calendar_date): r.gross_revenue for r in t["gold.daily_revenue"].read().collect()}
    assert dr == {"2026-09-01": Decimal("10.00"), "2026-09-02": Decimal("0.00"), "2026-09-03": Decimal("0.00")}

    assert [o.decision for o in R.refresh_gold(spark, t, as_of="2026-09-03")] == ["skip"] * 3
    # a later day changes the summary though no table moved
    assert [o.decision for o in R.refresh_gold(spark, t, as_of="2027-06-10")] == ["skip", "skip", "refresh"]
    assert [o.decision for o in R.refresh_gold(spark, t, as_of="2026-09-03")] == ["skip", "skip", "refresh"]

    # a refund day makes revenue negative: daily_revenue must not publish
    t["silver.orders"].publish(
        orders.unionByName(_orders(spark, [("o3", "c1", "2026-09-03", "completed", "-50.00")]))
    )
    before = t["gold.daily_revenue"].version()
    with pytest.raises(ConstraintViolation):
        R.refresh_gold(spark, t, as_of="2026-09-03")
    assert t["gold.daily_revenue"].version() == before
    assert t["gold.daily_revenue"].read().count() == 3
    assert t["gold.customer_value"].version() == 1  # refreshed before the failure


def test_incremental_customer_value_equals_full(spark):
    from lakestrata.catalog import old_orders_snapshot

    old_o, new_o = old_orders_snapshot(spark, SF001), A.orders_as_silver(spark, SF001)
    customers = A.customers_as_silver(spark, SF001)
    changes = R.order_changes(old_o, new_o)
    sides = {r.side: r["count"] for r in changes.groupBy("side").count().collect()}
    assert sides["new"] > sides["old"] > 0  # updates on both sides, inserts only new
    inc = R.incremental_customer_value(
        gold.customer_value(old_o, customers), new_o, customers, R.affected_customers(changes)
    )
    full = gold.customer_value(new_o, customers)
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0


def test_order_change_moves_customer(spark):
    old = _orders(spark, [("o1", "c1", "2026-09-01", "completed", "10.00")])
    new = _orders(spark, [("o1", "c2", "2026-09-01", "completed", "10.00")])
    affected = {r.customer_id for r in R.affected_customers(R.order_changes(old, new)).collect()}
    assert affected == {"c1", "c2"}


def test_incremental_refresh_equals_full_refresh(spark, workdir):
    """Publish silver, refresh; publish a changed silver, refresh incrementally
    in one set of tables and fully in another: the gold views are equal."""
    from lakestrata.catalog import old_orders_snapshot

    old_o, new_o = old_orders_snapshot(spark, SF001), A.orders_as_silver(spark, SF001)
    customers = A.customers_as_silver(spark, SF001)
    cal = gold.calendar_from(new_o, "order_date")
    results = {}
    for mode in ("incremental", "full"):
        t = _tables(spark, f"{workdir}/{mode}", old_o, customers, cal)
        R.refresh_gold(spark, t, as_of="2001-08-01", incremental=(mode == "incremental"))
        t["silver.orders"].publish(new_o, changes=True)
        # one customer moves market: a customer-side change
        t["silver.customers"].publish(
            customers.withColumn(
                "market", F.when(F.col("customer_id") == "7", F.lit("MOVED")).otherwise(F.col("market"))
            ),
            changes=True,
        )
        out = R.refresh_gold(spark, t, as_of="2001-08-01", incremental=(mode == "incremental"))
        expected = ["incremental"] * 3 if mode == "incremental" else ["refresh"] * 3
        assert [o.decision for o in out] == expected
        results[mode] = {v: t[v].read() for v in R.REFRESH_ORDER}
    for v in R.REFRESH_ORDER:
        a, b = results["incremental"][v], results["full"][v]
        assert a.count() == b.count()
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, v


def test_publish_pointers_are_atomic_files(spark, workdir):
    import os

    t = VersionedTable(spark, f"{workdir}/t")
    assert t.current() is None and t.pointers().count() == 0
    t.publish(spark.range(3), inputs={"silver.orders": 4})
    t.publish(spark.range(5), inputs={"silver.orders": 5})
    assert t.current() == (1, {"silver.orders": 5})
    rows = {r.version: (r.rows, r.inputs["silver.orders"]) for r in t.pointers().collect()}
    assert rows == {0: (3, 4), 1: (5, 5)}
    assert not [n for n in os.listdir(f"{workdir}/t/_published") if n.startswith(".tmp")]
    assert t.read(0).count() == 3 and t.read().count() == 5
