"""prepare_orders / prepare_customers: input contract, reject gate, publish."""

import pytest
from pyspark.sql import functions as F

from lakestrata.contracts import ConstraintViolation, SchemaContractViolation
from lakestrata.plans.ingest import ingest
from lakestrata.plans.silver import prepare_customers, prepare_orders
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from tools.source_fixture import source_records
from lakestrata.sources.tables import VersionedTable


def _bronze(spark, workdir, dataset="orders", **kw):
    landing = f"{workdir}/{dataset}-landing"
    write_pages(source_records(spark, dataset=dataset, **kw), landing)
    table = BronzeTable(spark, f"{workdir}/{dataset}-bronze")
    ingest(spark, read_pages(spark, landing), table, "RUN-0187")
    return table.read()


def test_prepare_orders_publishes(spark, workdir):
    bronze = _bronze(spark, workdir, pages=2, page_size=10)
    silver = VersionedTable(spark, f"{workdir}/silver-orders")
    out = prepare_orders(spark, bronze, silver)
    assert out.count() == 20 and silver.version() == 0
    assert prepare_customers(spark, _bronze(spark, workdir, "customers", pages=1, page_size=5)).count() == 5


def test_prepare_orders_raises_on_missing_bronze_column(spark, workdir):
    bronze = _bronze(spark, workdir, pages=1, page_size=3).drop("payload")
    with pytest.raises(SchemaContractViolation, match="orders_raw") as err:
        prepare_orders(spark, bronze)
    assert "payload" in str(err.value)


def test_rejects_block_publish(spark, workdir):
    bronze = _bronze(spark, workdir, pages=1, page_size=4)
    bad = bronze.withColumn(
        "payload",
        F.when(F.col("source_event_id") == "evt-000001-0002", F.regexp_replace("payload", '"net_amount":"[^"]*"', '"net_amount":"10.005"'))
        .otherwise(F.col("payload")),
    )
    silver = VersionedTable(spark, f"{workdir}/silver-orders")
    with pytest.raises(ConstraintViolation, match="rejects"):
        prepare_orders(spark, bad, silver)
    assert silver.version() is None


def test_incremental_silver_equals_full_rebuild(spark, workdir):
    from lakestrata.operators.silver import silver_orders
    from lakestrata.plans.silver import prepare_incremental

    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=3, page_size=5, start_page=1), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, read_pages(spark, landing), table, "RUN-0187")
    silver = VersionedTable(spark, f"{workdir}/silver")
    assert prepare_incremental(spark, table, silver).count() == 15

    # a later run re-delivers page 2 with newer timestamps and new amounts,
    # replays page 3 unchanged, and delivers a new page 4
    upd = f"{workdir}/landing2"
    recs = source_records(spark, pages=3, page_size=5, start_page=2).withColumn(
        "value",
        F.when(
            F.col("source_page") == 2,
            F.regexp_replace(
                F.regexp_replace("value", '"updated_at":"2026-09-01T', '"updated_at":"2026-09-03T'),
                '"net_amount":"[^"]*"',
                '"net_amount":"1.00"',
            ),
        ).otherwise(F.col("value")),
    )
    write_pages(recs, upd)
    ingest(spark, read_pages(spark, upd), table, "RUN-0188")
    inc = prepare_incremental(spark, table, silver)
    full = silver_orders(table.read())
    assert inc.count() == full.count() == 20
    assert inc.exceptAll(full).count() == 0 and full.exceptAll(inc).count() == 0
    assert inc.where(F.col("net_amount") == 1).count() == 5
    before = silver.version()
    prepare_incremental(spark, table, silver)  # nothing new: no new version
    assert silver.version() == before
    assert set(silver.read().columns) >= {"ingested_at", "payload", "source_page"}  # envelope kept for the next run


def test_empty_bronze_gives_empty_silver(spark, workdir):
    from lakestrata.plans.silver import prepare_incremental

    table = BronzeTable(spark, f"{workdir}/empty-bronze")
    assert table.version() is None and table.read().count() == 0
    assert prepare_orders(spark, table.read()).count() == 0
    silver = VersionedTable(spark, f"{workdir}/silver")
    assert prepare_incremental(spark, table, silver).count() == 0
    assert silver.version() == 0
