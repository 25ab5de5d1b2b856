"""Completed pages as bitmaps, and counts of stored tables from Parquet footers."""

import contextlib
import io
import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators import quality as Q
from lakestrata.operators import validation as V
from lakestrata.plans.ingest import completed_pages, ingest
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from tools.source_fixture import source_records


def _progress(spark, done):
    return spark.createDataFrame([(run, p) for run, ps in done.items() for p in ps], "run_id string, source_page int")


def test_bit_test_equals_the_anti_join(spark):
    r = random.Random(5)
    edge = [0, 1, 2, 7, 8, 9, 32767, 32768, 32769, 65536, 65537, -1, -8, -32768, -40000, 2_000_000_000]
    done = {"A": r.sample(edge, 9) + r.sample(range(100_000), 400), "B": [5]}
    pages = spark.createDataFrame([(p,) for p in edge + r.sample(range(100_000), 500) + done["A"][:200]], "source_page int").distinct()
    progress = _progress(spark, done)
    bitmaps = V.page_bitmaps(progress.unionAll(progress))  # repeated progress rows
    for run in ("A", "B", "C"):
        want = V.pending_pages(pages, progress.withColumn("complete", F.lit(True)), run)
        got = V.pending_by_bitmap(pages, bitmaps, run).select(*want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        own = V.PageSet(bitmaps.where(F.col("run_id") == run))
        members = set(done.get(run, []))
        assert all((p in own) == (p in members) for p in edge + list(range(0, 100_000, 37)) + done["A"])
    assert bitmaps.count() <= 12


def test_ingest_skips_by_bitmap(spark, workdir):
    write_pages(source_records(spark, pages=5, page_size=2), f"{workdir}/landing")
    table = BronzeTable(spark, f"{workdir}/bronze")
    assert 1 not in completed_pages(table, "RUN-1")
    ingest(spark, read_pages(spark, f"{workdir}/landing").where("source_page <> 3"), table, "RUN-1")
    done = completed_pages(table, "RUN-1")
    assert [p for p in range(8) if p in done] == [1, 2, 4, 5]
    assert ingest(spark, read_pages(spark, f"{workdir}/landing"), table, "RUN-1").pages_appended == [3]


@pytest.fixture
def stored(spark, workdir):
    df = spark.range(1000).select(
        "id", F.when(F.col("id") % 7 == 0, None).otherwise(F.col("id").cast("string")).alias("text"),
        F.lit(None).cast("date").alias("day"), F.when(F.col("id") < 10, F.lit(1.5)).alias("x"), (F.col("id") % 3).alias("part"),
    )
    df.repartition(4).write.partitionBy("part").parquet(f"{workdir}/t")
    return f"{workdir}/t"


def test_footer_counts_equal_a_scan_and_read_no_column(spark, stored):
    got = {r.column_name: (r.null_count, r.rows) for r in Q.stored_null_counts(spark, stored, "t").collect()}
    want = {r.column_name: (r.null_count, r.rows) for r in Q.null_counts(spark.read.parquet(stored), "t").collect()}
    assert got == want and got["day"] == (1000, 1000) and got["x"] == (990, 1000)
    before = spark.conf.get("spark.sql.sources.useV1SourceList")
    with Q.footer_reads(spark):
        out = io.StringIO()
        with contextlib.redirect_stdout(out):
            Q.footer_counts(spark, stored).explain(mode="formatted")
    assert "PushedAggregation: [COUNT(" in out.getvalue()
    assert spark.conf.get("spark.sql.sources.useV1SourceList") == before != ""


def test_footer_counts_of_an_empty_table(spark, workdir):
    spark.range(0).withColumn("s", F.lit("a")).write.parquet(f"{workdir}/empty")
    got = {r.column_name: (r.null_count, r.rows) for r in Q.stored_null_counts(spark, f"{workdir}/empty", "t").collect()}
    assert got == {"id": (0, 0), "s": (0, 0)}
