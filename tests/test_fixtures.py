"""The source formula at the reference's default size (10 pages x 100 rows)."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import gold
from lakestrata.operators.silver import silver_customers, silver_orders
from lakestrata.plans.ingest import ingest
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from tools.source_fixture import source_records


@pytest.fixture(scope="module")
def silver(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("fixtures"))
    out = {}
    for ds in ("orders", "customers"):
        write_pages(source_records(spark, pages=10, page_size=100, dataset=ds), f"{root}/{ds}-landing")
        table = BronzeTable(spark, f"{root}/{ds}-bronze")
        res = ingest(spark, read_pages(spark, f"{root}/{ds}-landing"), table, "RUN-0187")
        assert res.rows_appended == 1000 and res.pages_appended == list(range(1, 11))
        out[ds] = table.read()
    return silver_orders(out["orders"]).cache(), silver_customers(out["customers"]).cache()


def test_orders_silver(silver):
    orders, _ = silver
    assert orders.count() == 1000
    by_status = {r.order_status: r["count"] for r in orders.groupBy("order_status").count().collect()}
    assert by_status == {"completed": 800, "cancelled": 200}
    rev = orders.where("order_status = 'completed'").agg(F.sum("net_amount")).first()[0]
    assert rev == Decimal("194048.00")


def test_customers_silver_grain(silver):
    _, customers = silver
    assert customers.count() == 1000
    assert customers.select("customer_id").distinct().count() == 163
    assert customers.select("customer_id", "market").distinct().count() == 447


def test_customer_value_fans_out_on_unenforced_grain(silver):
    orders, customers = silver
    cv = gold.customer_value(orders, customers)
    tot = cv.agg(F.sum("lifetime_net_revenue"), F.sum("completed_orders")).first()
    assert tot[0] == Decimal("1499947.40")
    assert tot[1] == 2356


def test_commercial_summary_on_fixture(silver):
    orders, customers = silver
    cal = gold.calendar_from(orders, "order_date")
    dr = gold.daily_revenue(cal, orders)
    assert dr.count() == 3
    assert dr.agg(F.sum("gross_revenue")).first()[0] == Decimal("194048.00")
    cs = gold.commercial_summary(gold.customer_value(orders, customers), dr, "2026-09-30")
    rows = cs.collect()
    assert {r.market for r in rows} == {"DK", "DE", "SE"}
    assert all(r.revenue_last_30_days == Decimal("194048.00") for r in rows)
    # far in the future: no date qualifies -> NULL, the row is still there
    later = gold.commercial_summary(gold.customer_value(orders, customers), dr, "2027-06-01").collect()
    assert len(later) == 3 and all(r.revenue_last_30_days is None for r in later)
