"""What other readers see of Bronze after a crash, and pages that replace their earlier delivery."""

import os
import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lakestrata.plans.ingest import CheckpointWriteInterrupted, IngestError, ingest, ingest_replacing
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from lakestrata.sources.pages import PageTable
from tools.source_fixture import source_records


def _landed(spark, folder, **how):
    write_pages(source_records(spark, **how), folder)
    return read_pages(spark, folder)


@pytest.mark.parametrize("seed", [1, 2])
def test_every_reader_sees_the_committed_pages_alone(spark, workdir, seed):
    pages, size = 6, 5
    landed = _landed(spark, f"{workdir}/landing", pages=pages, page_size=size)
    table = BronzeTable(spark, f"{workdir}/bronze")
    bad = random.Random(seed).randint(2, pages - 1)

    def crash(page, version):
        if page == bad:
            raise CheckpointWriteInterrupted("stop")

    with pytest.raises(IngestError):
        ingest(spark, landed, table, "RUN-1", after_commit=crash)

    def counts():
        plain = spark.read.parquet(table.root).count()
        duck = duckdb.connect().sql(f"SELECT count(*) AS n FROM read_parquet('{table.root}/batch=*/commit_version=*/*.parquet')").df()["n"][0]
        return plain, duck, table.read().count()

    assert counts() == (bad * size,) * 3
    assert table.version() == bad - 1
    # the retry takes a new batch and version above all staged ones, and the crashed page comes again
    again = ingest(spark, landed, table, "RUN-1")
    assert again.pages_appended == list(range(bad, pages + 1)) and again.first_version == bad
    assert counts() == ((pages + 1) * size,) * 3
    assert sorted(os.listdir(table.root)) == ["_progress", "_staging", "batch=0", "batch=1"]


def test_crash_between_move_and_marker(spark, workdir, monkeypatch):
    landed = _landed(spark, f"{workdir}/landing", pages=2, page_size=3)
    table = BronzeTable(spark, f"{workdir}/bronze")
    from lakestrata.sources import bronze as B

    def broken(*a):
        raise OSError("gone")

    with monkeypatch.context() as m:
        m.setattr(B.fs, "write_text_atomic", broken)
        with pytest.raises(OSError):
            ingest(spark, landed, table, "RUN-1")
    # both pages are in sight for everyone, and their versions are not given again
    assert table.version() == 1 and table.read().count() == spark.read.parquet(table.root).count() == 6
    assert ingest(spark, landed, table, "RUN-1").first_version == 2


def test_a_page_replaces_itself(spark, workdir):
    landed = _landed(spark, f"{workdir}/landing", pages=4, page_size=5)
    table = PageTable(spark, f"{workdir}/pages")
    assert table.read().count() == 0
    ingest_replacing(spark, landed, table, "RUN-1")
    ingest_replacing(spark, landed.where("source_page in (2, 3)"), table, "RUN-1")
    assert table.read().count() == 20
    ingest_replacing(spark, landed.where("source_page = 1"), table, "RUN-2")
    assert table.read().count() == 25
    # a shorter second delivery is the page's whole content
    shorter = landed.where((F.col("source_page") == 4) & ~F.col("value").contains("evt-000004-0003"))
    ingest_replacing(spark, shorter, table, "RUN-1")
    assert table.read().where("ingestion_run_id = 'RUN-1'").groupBy("source_page").count().orderBy("source_page").collect()[-1]["count"] == 4


def test_replacing_stops_at_the_first_invalid_page(spark, workdir):
    landed = _landed(spark, f"{workdir}/landing", pages=4, page_size=3)
    broken = landed.withColumn("value", F.when(F.col("value").contains("evt-000003-0001"), F.regexp_replace("value", '"event_id":"[^"]*"', '"event_id":""')).otherwise(F.col("value")))
    table = PageTable(spark, f"{workdir}/pages")
    out = {r.source_page: r.committable for r in ingest_replacing(spark, broken, table, "RUN-1").collect()}
    assert out == {1: True, 2: True, 3: False, 4: False}
    assert sorted(r[0] for r in table.read().select("source_page").distinct().collect()) == [1, 2]


@pytest.mark.parametrize("hook", [None, lambda page, version: None])
def test_listings_do_not_grow_with_pages(spark, workdir, monkeypatch, hook):
    from lakestrata.sources import bronze as B

    listed, real = [], B.fs.list_dirs
    monkeypatch.setattr(B.fs, "list_dirs", lambda *a: listed.append(a) or real(*a))
    calls = []
    for pages in (2, 9):
        landed = _landed(spark, f"{workdir}/landing{pages}", pages=pages, page_size=3)
        table = BronzeTable(spark, f"{workdir}/bronze{pages}")
        listed.clear()
        assert ingest(spark, landed, table, "RUN-1", after_commit=hook).last_version == pages - 1
        calls.append(len(listed))
        assert table.version() == pages - 1 and table.read().count() == 3 * pages
        assert table.commit_log().count() == table.progress().count() == pages
    assert calls[0] == calls[1]


def test_append_comes_into_sight_by_one_move(spark, workdir, monkeypatch):
    from lakestrata.sources import bronze as B

    moved, real = [], B.fs.move
    monkeypatch.setattr(B.fs, "move", lambda *a: moved.append(a) or real(*a))
    table = BronzeTable(spark, f"{workdir}/bronze")
    for first in (0, 5):
        table.append(spark.range(20).selectExpr("id", f"id % 5 + {first} as commit_version"))
    assert len(moved) == 2 and table.committed_versions() == list(range(10))
    assert table.read().count() == spark.read.parquet(table.root).count() == 40


def test_stream_reads_progress_once_a_batch(spark, workdir, monkeypatch):
    from lakestrata.plans import ingest as I
    from lakestrata.streaming import bronze_stream as S

    asked, real = [], I.completed_pages
    for module in (I, S):
        monkeypatch.setattr(module, "completed_pages", lambda *a: asked.append(a) or real(*a))
    _landed(spark, f"{workdir}/landing", pages=4, page_size=3)
    table = BronzeTable(spark, f"{workdir}/bronze")
    S.run_to_completion(S.start_bronze_stream(spark, f"{workdir}/landing", table, "RUN-1", f"{workdir}/ckpt"))
    assert len(asked) == 1 and table.read().count() == 12


def test_listing_asks_the_jvm_in_pieces(spark, workdir, monkeypatch):
    from py4j.clientserver import ClientServerConnection
    from lakestrata.sources import fs

    names = [f"commit_version={i}" for i in range(100)] + ["a b; isDirectory=false;x", "n\nm"]
    for n in names:
        os.makedirs(f"{workdir}/t/{n}")
    open(f"{workdir}/t/c; isDirectory=true; d", "w").close()
    assert fs.list_dirs(spark, f"{workdir}/t") == sorted(names) and fs.list_files(spark, f"{workdir}/t") == ["c; isDirectory=true; d"]
    os.rmdir(f"{workdir}/t/n\nm")
    calls, real = [], ClientServerConnection.send_command
    monkeypatch.setattr(ClientServerConnection, "send_command", lambda self, command: calls.append(command) or real(self, command))
    assert fs.list_dirs(spark, f"{workdir}/t") == sorted(names[:-1])
    assert len(calls) < 100  # over 400 with calls for each entry


def test_log_of_a_batch_that_moves_whole(spark, workdir):
    landed = _landed(spark, f"{workdir}/landing", pages=3, page_size=4)
    table = BronzeTable(spark, f"{workdir}/bronze")
    assert ingest(spark, landed, table, "RUN-1", pages=[1, 2, 3, 4]).last_version == 3  # page 4 is empty
    assert ingest(spark, landed.where("false"), table, "RUN-1", pages=[5]).last_version == 4  # nothing but an empty page
    assert {(r.commit_version, r.source_page, r.rows) for r in table.commit_log().collect()} == {(0, 1, 4), (1, 2, 4), (2, 3, 4), (3, 4, 0), (4, 5, 0)}
    assert table.read().columns[:1] == ["source_page"] and table.read().count() == spark.read.parquet(table.root).count() == 12


def test_read_has_the_columns_of_every_batch(spark, workdir):
    table = BronzeTable(spark, f"{workdir}/bronze")
    table.append(spark.range(6).selectExpr("id", "id % 3 as commit_version"))
    table.append(spark.range(6).selectExpr("id", "cast(id as string) as extra", "id % 3 + 3 as commit_version"))
    got = table.read()
    assert got.schema == spark.read.option("mergeSchema", "true").parquet(table.root).schema
    assert got.columns == ["id", "extra", "batch", "commit_version"]
    assert got.where("extra is null").count() == 6 and got.where("commit_version = 4").count() == 2
