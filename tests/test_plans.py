"""Physical-plan properties that matter at scale (checked on the formatted plan)."""

import contextlib
import io

from pyspark.sql import functions as F

from lakestrata.catalog import gold_views
from lakestrata.operators.dedupe import dedupe_by_source_event
from lakestrata.operators.silver import silver_orders
from lakestrata.plans.ingest import ingest
from lakestrata.sources import adapters as A
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from tools.source_fixture import source_records

from conftest import SF001


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode="formatted")
    return buf.getvalue()


def test_dedupe_limits_before_the_shuffle(spark):
    p = plan(dedupe_by_source_event(A.events_as_bronze(spark, SF001)))
    assert p.count("WindowGroupLimit") >= 2  # partial (map side) + final
    first_limit, first_exchange = p.index("WindowGroupLimit"), p.index("Exchange")
    assert first_limit < first_exchange  # tree printed top-down: final limit above the exchange
    tail = p[first_exchange:]
    assert "WindowGroupLimit" in tail  # and a partial one below it


def test_gold_has_no_cartesian_or_nested_loop_join(spark):
    for df in gold_views(spark, SF001):
        p = plan(df)
        assert "CartesianProduct" not in p
        assert "BroadcastNestedLoopJoin" not in p


def test_gold_scans_are_pruned(spark):
    cv = gold_views(spark, SF001)[0]
    p = plan(cv)
    assert "ReadSchema: struct<c_custkey:bigint,c_mktsegment:string>" in p
    assert "o_orderpriority" not in p and "c_acctbal" not in p


def test_bronze_reads_prune_commit_versions(spark, workdir):
    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=3, page_size=4), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, read_pages(spark, landing), table, "RUN-0187")
    p = plan(table.read_since(1))
    assert "PartitionFilters" in p and "commit_version" in p.split("PartitionFilters", 1)[1].split("\n", 1)[0]
    assert table.read_since(1).count() == 4
    # landing page filters prune page directories too
    lp = plan(read_pages(spark, landing).where(F.col("source_page") == 2))
    assert "PartitionFilters" in lp


def test_silver_plan_is_codegen_only(spark):
    p = plan(silver_orders(A.orders_as_bronze(spark, SF001)))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p
