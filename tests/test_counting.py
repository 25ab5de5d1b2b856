"""Change feeds, bucketed tables and views kept by counts: equal to full recomputation, touching only what moved."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakestrata.contracts import ConstraintViolation
from lakestrata.operators import gold
from lakestrata.operators.silver import silver_orders
from lakestrata.plans import refresh as R
from lakestrata.plans.ingest import ingest
from lakestrata.plans.silver import prepare_incremental
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.buckets import BucketedTable
from lakestrata.sources.landing import read_pages, write_pages
from lakestrata.sources.tables import WEIGHT, NoChangeFeed, VersionedTable, snapshot_changes
from tools.source_fixture import source_records

ORDERS = "order_id string, customer_id string, order_date date, order_status string, net_amount decimal(18,2)"
CUSTOMERS = "customer_id string, market string"


def _same(a, b):
    assert a.columns == b.columns
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def _random_orders(r, n):
    status = ["completed"] * 3 + ["open", "cancelled"]
    return [
        (
            None if r.random() < 0.03 else f"o{r.randrange(n)}",  # repeated order ids: COUNT(DISTINCT) differs from COUNT
            None if r.random() < 0.03 else f"c{r.randrange(12) if r.random() < 0.6 else 0}",
            None if r.random() < 0.03 else dt.date(2026, 9, r.randint(1, 28)),
            r.choice(status),
            None if r.random() < 0.05 else Decimal(r.randint(0, 9999)) / 100,
        )
        for _ in range(n)
    ]


def _step(r, rows):
    """Deletes, updates and inserts; at times a customer loses a first or last day."""
    rows = [x for x in rows if r.random() > 0.1]
    rows = [(*x[:3], r.choice(["completed", "cancelled"]), x[4]) if r.random() < 0.1 else x for x in rows]
    done = [x for x in rows if x[1] == "c0" and x[2] and x[3] == "completed"]
    if done:
        edge = r.choice([min, max])(x[2] for x in done)
        rows = [x for x in rows if not (x[1] == "c0" and x[2] == edge)]
    return rows + _random_orders(r, 15)


def test_counted_views_equal_full_views_over_random_changes(spark, workdir):
    r = random.Random(11)
    rows, customers = _random_orders(r, 120), [(f"c{i}", r.choice(["DK", "DE", "SE"])) for i in range(10)] + [("c1", "DK"), ("c2", None), (None, "DE")]
    cal = spark.range(1).select(gold.calendar_spine("2026-09-01", "2026-09-30"))
    names = [*R.VIEW_INPUTS, "silver.orders", "silver.customers", "silver.calendar"]
    t = {n: VersionedTable(spark, f"{workdir}/{n}") for n in names}
    t["gold.customer_value"] = BucketedTable(spark, f"{workdir}/cv", ("customer_id",), 4)
    state = R.CountedGold(spark, f"{workdir}/counts", 4)
    t["silver.calendar"].publish(cal)
    for step in range(4):
        orders_df, customers_df = spark.createDataFrame(rows, ORDERS), spark.createDataFrame(customers, CUSTOMERS)
        t["silver.orders"].publish(orders_df, changes=True)
        t["silver.customers"].publish(customers_df, changes=True)
        out = R.refresh_gold(spark, t, as_of="2026-09-25", incremental=True, state=state)
        assert [o.decision for o in out] == (["incremental"] * 3 if step else ["refresh"] * 3)
        cv, dr = gold.customer_value(orders_df, customers_df), gold.daily_revenue(cal, orders_df)
        _same(t["gold.customer_value"].read(), cv)
        _same(t["gold.daily_revenue"].read(), dr)
        _same(t["gold.commercial_summary"].read(), gold.commercial_summary(cv, dr, "2026-09-25"))
        rows = _step(r, rows)
        customers = [c if r.random() > 0.2 else (c[0], r.choice(["DK", "NO"])) for c in customers if r.random() > 0.1] + [(f"c{r.randrange(14)}", "SE")]


def test_a_step_reads_feeds_and_touched_buckets_only(spark, workdir):
    rows = [(f"o{i}", f"c{i % 200}", dt.date(2026, 9, 1 + i % 28), "completed", Decimal(5)) for i in range(1000)]
    customers = spark.createDataFrame([(f"c{i}", "DK") for i in range(200)], CUSTOMERS)
    names = [*R.VIEW_INPUTS, "silver.orders", "silver.customers", "silver.calendar"]
    t = {n: VersionedTable(spark, f"{workdir}/{n}") for n in names}
    t["gold.customer_value"] = BucketedTable(spark, f"{workdir}/cv", ("customer_id",), 32)
    state = R.CountedGold(spark, f"{workdir}/counts", 32)
    t["silver.calendar"].publish(spark.range(1).select(gold.calendar_spine("2026-09-01", "2026-09-30")))
    t["silver.customers"].publish(customers)
    t["silver.orders"].publish(spark.createDataFrame(rows, ORDERS))
    R.refresh_gold(spark, t, as_of="2026-09-25", incremental=True, state=state)
    kept_view = t["gold.customer_value"].read()
    t["silver.orders"].publish(spark.createDataFrame([*rows[1:], ("new", "c7", dt.date(2026, 9, 30), "completed", Decimal(9))], ORDERS), changes=True)

    feed = state.order_delta(t["silver.orders"].changes(0, 1))
    assert {f.split("/_changes/")[1][:3] for f in feed.inputFiles()} == {"v=1"}  # no snapshot is scanned
    assert "Except" not in feed._jdf.queryExecution().optimizedPlan().toString()

    R.refresh_gold(spark, t, as_of="2026-09-25", incremental=True, state=state)
    for table in (state.order_pairs, state.order_dates, state.customer_totals, state.day_pairs, t["gold.customer_value"]):
        moved = [b for b, v in table.files().items() if v > 0]
        assert 1 <= len(moved) <= 2, table.root  # two customers, two orders, two days
        assert len(table.files(0)) > 20
    _same(t["gold.customer_value"].read(0), kept_view)  # the older version stays readable
    assert t["gold.customer_value"].changes(0, 1).count() == 4  # two customers, old row and new row


def test_missing_feed_and_broken_off_run_rebuild_the_state(spark, workdir):
    customers = spark.createDataFrame([("c1", "DK"), ("c2", "DE")], CUSTOMERS)
    names = [*R.VIEW_INPUTS, "silver.orders", "silver.customers", "silver.calendar"]
    t = {n: VersionedTable(spark, f"{workdir}/{n}") for n in names}
    t["silver.calendar"].publish(spark.range(1).select(gold.calendar_spine("2026-09-01", "2026-09-03")))
    t["silver.customers"].publish(customers)

    def orders(*ids):
        return spark.createDataFrame([(i, "c1", dt.date(2026, 9, 2), "completed", Decimal(3)) for i in ids], ORDERS)

    t["silver.orders"].publish(orders("a"))
    state = R.CountedGold(spark, f"{workdir}/counts", 4)
    R.refresh_gold(spark, t, as_of="2026-09-03", incremental=True, state=state)
    t["silver.orders"].publish(orders("a", "b"))  # without a feed
    with pytest.raises(NoChangeFeed):
        t["silver.orders"].changes(0, 1)
    assert [o.decision for o in R.refresh_gold(spark, t, as_of="2026-09-03", incremental=True, state=state)] == ["refresh", "refresh", "incremental"]
    t["silver.orders"].publish(orders("b", "c", "d"), changes=True)
    # one state table went ahead of the others: they stand for no common version
    state.order_pairs.publish(state.order_pairs.read(), inputs={"silver.orders": 2, "silver.customers": 0})
    assert state.inputs() is None
    R.refresh_gold(spark, t, as_of="2026-09-03", incremental=True, state=state)
    _same(t["gold.customer_value"].read(), gold.customer_value(t["silver.orders"].read(), customers))
    assert state.inputs() == {"silver.orders": 2, "silver.customers": 0}


def test_snapshot_changes_count_repeated_rows(spark):
    old = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, None)], "k string, v int")
    new = spark.createDataFrame([("a", 1), ("b", 3), (None, None), (None, None)], "k string, v int")
    got = {(r.k, r.v): r[WEIGHT] for r in snapshot_changes(old, new).collect()}
    assert got == {("a", 1): -1, ("b", 2): -1, ("b", 3): 1, (None, None): 1}
    assert snapshot_changes(None, old).count() == 3


def test_bucketed_silver_rewrites_touched_buckets_and_feeds_changes(spark, workdir):
    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=20, page_size=10), landing)
    bronze = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, read_pages(spark, landing), bronze, "RUN-0187")
    silver = BucketedTable(spark, f"{workdir}/silver", ("source_event_id",), 128)
    assert prepare_incremental(spark, bronze, silver).count() == 200
    before = silver.read()

    # page 3 again, one order of it newer and cheaper; the other nine are replays
    recs = source_records(spark, pages=1, page_size=10, start_page=3)
    newer = F.regexp_replace(F.regexp_replace("value", '"updated_at":"2026-09-01T', '"updated_at":"2026-09-02T'), '"net_amount":"[^"]*"', '"net_amount":"1.00"')
    recs = recs.withColumn("value", F.when(F.col("value").contains("evt-000003-0004"), newer).otherwise(F.col("value")))
    write_pages(recs, f"{workdir}/again")
    ingest(spark, read_pages(spark, f"{workdir}/again"), bronze, "RUN-0188")
    after = prepare_incremental(spark, bronze, silver)
    _same(after, silver_orders(bronze.read()))
    _same(silver.read(0), before)

    feed = silver.changes(0, 1)
    _same(feed.select(*sorted(feed.columns)), snapshot_changes(before, silver.read()).select(*sorted(feed.columns)))
    assert after.where("net_amount = 1").count() == 1
    # a replay ingested later wins its tie by ingested_at, so ten events moved and at most ten buckets
    moved = [b for b, v in silver.files().items() if v == 1]
    assert set(moved) == set(silver.touched(feed)) and len(moved) <= 10
    assert len(silver.files()) > 80


def test_bucketed_table_refuses_rows_of_other_buckets(spark, workdir):
    t = BucketedTable(spark, f"{workdir}/t", ("k",), 8)
    t.publish(spark.createDataFrame([(f"k{i}", i) for i in range(40)], "k string, v int"))
    here = t.touched(spark.createDataFrame([("k1", 0)], "k string, v int"))
    with pytest.raises(ConstraintViolation):
        t.replace(t.read(), here)
    assert t.version() == 0
    t.replace(t.read(only=here).where("k <> 'k1'"), here)
    assert t.read().count() == 39 and t.read(0).count() == 40
    assert t.read(only=[]).count() == 0 and t.read(only=[]).columns == ["k", "v"]
    empty = BucketedTable(spark, f"{workdir}/empty", ("k",), 8)
    empty.publish(t.read().where("false"))
    assert empty.read().count() == 0 and empty.files() == {}
