"""Streaming ingest: ghost retry through foreachBatch and a restarted query."""

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.silver import silver_orders
from lakestrata.plans.ingest import CheckpointWriteInterrupted
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import write_pages
from tools.source_fixture import source_records
from lakestrata.streaming.bronze_stream import run_to_completion, start_bronze_stream


def _land_one_file_per_page(spark, landing, **kw):
    write_pages(source_records(spark, **kw).repartition("source_page"), landing)


def test_stream_ghost_retry_then_restart(spark, workdir, run_id):
    landing, ckpt = f"{workdir}/landing", f"{workdir}/ckpt"
    _land_one_file_per_page(spark, landing, pages=3, page_size=5, start_page=41)
    table = BronzeTable(spark, f"{workdir}/bronze")

    def crash(page, version):
        if page == 42:
            raise CheckpointWriteInterrupted("crash after commit, before progress")

    q = start_bronze_stream(spark, landing, table, run_id, checkpoint=ckpt, after_commit=crash, max_files_per_trigger=1)
    with pytest.raises(Exception):
        run_to_completion(q)
    assert table.version() == 1

    run_to_completion(start_bronze_stream(spark, landing, table, run_id, checkpoint=ckpt, max_files_per_trigger=1))
    rows = table.read()
    assert rows.count() == 20
    assert rows.select("source_event_id").distinct().count() == 15
    assert rows.where(F.col("source_page") == 42).count() == 10
    assert silver_orders(rows).count() == 15


def test_stream_idempotent_mode_does_not_duplicate(spark, workdir, run_id):
    landing, ckpt = f"{workdir}/landing", f"{workdir}/ckpt"
    _land_one_file_per_page(spark, landing, pages=3, page_size=5, start_page=41)
    table = BronzeTable(spark, f"{workdir}/bronze")

    def crash(page, version):
        if page == 42:
            raise CheckpointWriteInterrupted("crash")

    with pytest.raises(Exception):
        run_to_completion(
            start_bronze_stream(
                spark, landing, table, run_id, checkpoint=ckpt, after_commit=crash, idempotent=True, max_files_per_trigger=1
            )
        )
    run_to_completion(
        start_bronze_stream(spark, landing, table, run_id, checkpoint=ckpt, idempotent=True, max_files_per_trigger=1)
    )
    assert table.read().count() == 15


def test_stream_stops_on_invalid_page(spark, workdir, run_id):
    landing, ckpt = f"{workdir}/landing", f"{workdir}/ckpt"
    recs = source_records(spark, pages=3, page_size=3, start_page=1).withColumn(
        "value",
        F.when(F.col("source_page") == 2, F.regexp_replace("value", '"event_id":"[^"]*"', '"event_id":""')).otherwise(
            F.col("value")
        ),
    )
    write_pages(recs.repartition("source_page"), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    with pytest.raises(Exception) as err:
        run_to_completion(start_bronze_stream(spark, landing, table, run_id, checkpoint=ckpt, max_files_per_trigger=1))
    assert "missing event_id" in str(err.value)
    assert sorted(r.source_page for r in table.read().select("source_page").distinct().collect()) == [1]


@pytest.mark.parametrize("per_trigger", [1, 2, 100])
def test_pages_of_several_files_are_whole_in_bronze(spark, workdir, run_id, per_trigger):
    landing = f"{workdir}/landing"
    records = source_records(spark, pages=2, page_size=30, start_page=1)
    for k in range(3):  # three files a page
        write_pages(records.where(F.abs(F.hash("value")) % 3 == k).coalesce(1), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    run_to_completion(start_bronze_stream(spark, landing, table, run_id, max_files_per_trigger=per_trigger))
    assert table.read().count() == 60
    assert table.version() == 1


def test_late_file_of_a_completed_page_stops_the_stream(spark, workdir, run_id):
    landing = f"{workdir}/landing"
    _land_one_file_per_page(spark, landing, pages=1, page_size=5, start_page=1)
    table = BronzeTable(spark, f"{workdir}/bronze")
    run_to_completion(start_bronze_stream(spark, landing, table, run_id))
    _land_one_file_per_page(spark, landing, pages=1, page_size=2, start_page=1)
    with pytest.raises(Exception, match="landed after the ingest"):
        run_to_completion(start_bronze_stream(spark, landing, table, run_id))
    assert table.read().count() == 5


def test_stream_reads_progress_once_and_one_log(spark, workdir, run_id, monkeypatch):
    from lakestrata.streaming import bronze_stream as S

    asked, real = [], S.completed_pages
    monkeypatch.setattr(S, "completed_pages", lambda *a: asked.append(a) or real(*a))
    landing, ckpt = f"{workdir}/landing", f"{workdir}/ckpt"
    _land_one_file_per_page(spark, landing, pages=5, page_size=4, start_page=1)
    table = BronzeTable(spark, f"{workdir}/bronze")

    def crash(page, version):
        if page == 4:
            raise CheckpointWriteInterrupted("crash")

    with pytest.raises(Exception):
        run_to_completion(start_bronze_stream(spark, landing, table, run_id, ckpt, crash, max_files_per_trigger=1))
    assert len(asked) == 1  # not once a micro-batch
    run_to_completion(start_bronze_stream(spark, landing, table, run_id, ckpt, max_files_per_trigger=1))
    assert len(asked) == 2
    log = table.commit_log()
    assert "Union" not in log._jdf.queryExecution().analyzed().toString()  # one scan, however many batches
    pages = [r.source_page for r in log.orderBy("commit_version").collect()]
    assert sorted(pages) == [1, 2, 3, 4, 4, 5] and {r.rows for r in log.collect()} == {4}
    assert sorted(r.source_page for r in table.progress().collect()) == [1, 2, 3, 4, 5]
    assert {r.source_page: r["count"] for r in table.read().groupBy("source_page").count().collect()} == {1: 4, 2: 4, 3: 4, 4: 8, 5: 4}
