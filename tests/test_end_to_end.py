"""The whole pipeline on the reference's default source (10 pages x 100):
CLI ingest with the Silver step for both datasets, a calendar table, then
the ordered Gold refresh over published tables."""

from decimal import Decimal

from pyspark.sql import functions as F

from lakestrata.cli import main
from lakestrata.operators import gold
from lakestrata.plans.refresh import REFRESH_ORDER, refresh_gold
from lakestrata.sources.landing import write_pages
from lakestrata.sources.tables import VersionedTable
from tools.source_fixture import source_records


def test_pipeline_end_to_end(spark, workdir, run_id):
    common = ["--run-id", run_id, "--window-start", "2026-09-01T00:00:00Z", "--window-end", "2026-09-02T00:00:00Z"]
    for ds in ("orders", "customers"):
        write_pages(source_records(spark, pages=10, page_size=100, dataset=ds), f"{workdir}/landing/{ds}")
        argv = common + ["--table-uri", f"{workdir}/bronze/{ds}", "--dataset", ds,
                         "--landing-uri", f"{workdir}/landing/{ds}", "--prepare-silver", f"{workdir}/silver/{ds}"]
        assert main(argv, spark=spark) == 0

    t = {
        "silver.orders": VersionedTable(spark, f"{workdir}/silver/orders"),
        "silver.customers": VersionedTable(spark, f"{workdir}/silver/customers"),
        "silver.calendar": VersionedTable(spark, f"{workdir}/silver/calendar"),
    }
    t["silver.calendar"].publish(spark.range(1).select(gold.calendar_spine("2026-09-01", "2026-09-30")))
    for v in REFRESH_ORDER:
        t[v] = VersionedTable(spark, f"{workdir}/{v}")

    out = refresh_gold(spark, t, as_of="2026-09-30")
    assert [o.decision for o in out] == ["refresh"] * 3

    dr = t["gold.daily_revenue"].read()
    assert dr.count() == 30
    assert dr.agg(F.sum("gross_revenue")).first()[0] == Decimal("194048.00")
    assert dr.where(F.col("gross_revenue") == 0).count() == 27  # orders fall on three days only

    cv = t["gold.customer_value"].read()
    assert cv.count() == 447  # (customer, market) pairs: the unenforced grain fans out
    tot = cv.agg(F.sum("lifetime_net_revenue"), F.sum("completed_orders")).first()
    assert tot[0] == Decimal("1499947.40") and tot[1] == 2356

    cs = {r.market: r for r in t["gold.commercial_summary"].read().collect()}
    assert set(cs) == {"DK", "DE", "SE"}
    assert all(r.revenue_last_30_days == Decimal("194048.00") for r in cs.values())
    assert sum(r.lifetime_net_revenue for r in cs.values()) == Decimal("1499947.40")

    # nothing moved: every view is skipped
    assert [o.decision for o in refresh_gold(spark, t, as_of="2026-09-30")] == ["skip"] * 3
