"""Run manifests, gate, status actions, image pin rule."""

from pyspark.sql import functions as F

from lakestrata.plans import runs as RUNS
from lakestrata.plans.ingest import CheckpointWriteInterrupted
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from tools.source_fixture import source_records


def test_image_pin_rule(spark):
    good = "registry.io/ingest@sha256:" + "a" * 64
    df = spark.createDataFrame(
        [(good,), ("registry.io/ingest:latest",), ("registry.io/ingest:v1.4.2",), ("registry.io/ingest",)], "image string"
    )
    assert [r.p for r in df.select(RUNS.image_pinned("image").alias("p")).collect()] == [True, False, False, False]


def test_status_action_and_owner(spark):
    statuses = ["ok", "validation_error: x", "schema_contract_violation: x", "checkpoint_write_interrupted: x", "error: x", None]
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    rows = df.select(RUNS.status_action("status").alias("a"), RUNS.failure_owner("status").alias("o")).collect()
    assert [r.a for r in rows] == ["proceed", "fail", "fail", "resubmit", "inspect", "inspect"]
    assert [r.o for r in rows][:5] == [None, "runtime", "table", "runtime", "runtime"]


def test_manifest_written_on_every_outcome_and_gate(spark, workdir, run_id):
    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=3, page_size=5, start_page=41), landing)
    pages = read_pages(spark, landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    mpath = f"{workdir}/manifests"

    def crash(page, version):
        if page == 42:
            raise CheckpointWriteInterrupted("crash")

    m1 = RUNS.run_ingest(spark, pages, table, run_id, mpath, after_commit=crash, max_pages_per_batch=1)
    assert m1["status"].startswith("checkpoint_write_interrupted:")
    assert m1["pages_appended"] == [41, 42] and m1["version_after"] == 1
    m2 = RUNS.run_ingest(spark, pages, table, run_id, mpath, max_pages_per_batch=1)
    assert m2["status"] == "ok" and m2["pages_skipped"] == [41] and m2["version_after"] == 3
    m3 = RUNS.run_ingest(spark, pages, table, run_id, mpath)
    assert m3["status"] == "ok" and m3["pages_appended"] == [] and m3["version_after"] == 3

    g = RUNS.gate(spark.read.parquet(mpath)).orderBy("finished_at").collect()
    assert [(r.action, r.gated) for r in g] == [("resubmit", False), ("proceed", True), ("proceed", False)]


def test_exit_codes(spark):
    statuses = ["ok", "validation_error: x", "schema_contract_violation: x", "checkpoint_write_interrupted: x", "error: x"]
    df = spark.createDataFrame([(s,) for s in statuses], "status string")
    assert [r.c for r in df.select(RUNS.exit_code("status").alias("c")).collect()] == [0, 2, 3, 4, 1]


def test_chained_run_reports_silver_contract_violation(spark, workdir, run_id):
    """Ingest succeeds, the Silver step fails its input contract; the
    manifest still lists the appended pages and carries the status."""
    from lakestrata.plans.silver import prepare_orders

    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=2, page_size=3), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")

    def silver_step(t):
        prepare_orders(spark, t.read().drop("payload"))

    m = RUNS.run_ingest(spark, read_pages(spark, landing), table, run_id, f"{workdir}/m", prepare_silver=silver_step)
    assert m["status"].startswith("schema_contract_violation:") and "payload" in m["status"]
    assert m["pages_appended"] == [1, 2] and m["version_after"] == 1
    assert table.is_complete(run_id, 1) and table.version_for(run_id, 2) == 1
    assert not table.is_complete("RUN-OTHER", 1)


def test_gate_keeps_tables_apart(spark):
    rows = [("a", "r1", "ok", 50, 1), ("b", "r2", "ok", 3, 2), ("a", "r3", "ok", 50, 3), ("b", "r4", "ok", 4, 4)]
    df = spark.createDataFrame(rows, "table_uri string, run_id string, status string, version_after long, finished_at int")
    assert {r.run_id: r.gated for r in RUNS.gate(df).collect()} == {"r1": True, "r2": True, "r3": False, "r4": True}
