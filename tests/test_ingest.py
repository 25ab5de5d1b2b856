"""Batch ingest: crashes and retries, history, dedupe, validation cut-off."""

import random

import pytest
from pyspark.sql import functions as F

from lakestrata.operators.history import commit_history
from lakestrata.operators.silver import silver_orders
from lakestrata.plans.ingest import CheckpointWriteInterrupted, IngestError, SourcePayloadError, ingest
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import read_pages, write_pages
from tools.source_fixture import source_records


def crash_on(page_to_kill):
    def hook(page, version):
        if page == page_to_kill:
            raise CheckpointWriteInterrupted(f"stopped behind page {page}")

    return hook


def _land(spark, workdir, **kw):
    landing = f"{workdir}/landing"
    write_pages(source_records(spark, **kw), landing)
    return read_pages(spark, landing)


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_random_crashes_follow_the_model(spark, workdir, seed):
    """Attempts of random chunk sizes that break off behind random pages, against a list of commits kept by hand."""
    r = random.Random(seed)
    first, n, size = r.randint(1, 50), r.randint(3, 5), r.randint(2, 4)
    pages = list(range(first, first + n))
    landed = _land(spark, workdir, pages=n, page_size=size, start_page=first)
    table = BronzeTable(spark, f"{workdir}/bronze")
    commits, done = [], set()
    for attempt in range(3):
        left = [p for p in pages if p not in done]
        stop = r.choice(left) if attempt < 2 and left else None
        hook = crash_on(stop) if stop is not None else None
        chunk = r.choice([1, 2, 100])
        if stop is None:
            result = ingest(spark, landed, table, "RUN-M", after_commit=hook, max_pages_per_batch=chunk)
        else:
            with pytest.raises(IngestError) as err:
                ingest(spark, landed, table, "RUN-M", after_commit=hook, max_pages_per_batch=chunk)
            assert isinstance(err.value.cause, CheckpointWriteInterrupted)
            result = err.value.result
        reached = left if stop is None else left[: left.index(stop) + 1]  # the page it stops behind is committed
        assert result.pages_skipped == sorted(done) and result.pages_appended == reached
        assert result.rows_appended == size * len(reached)
        base = len(commits)
        assert (result.first_version, result.last_version) == ((base, base + len(reached) - 1) if reached else (None, None))
        commits += reached
        done |= set(reached) - {stop}
        # the table is the list of commits, whatever the chunks were
        history = {x.commit_version: (x.source_page, x.rows, x.ingestion_run_id) for x in commit_history(table.read()).collect()}
        assert history == {v: (p, size, "RUN-M") for v, p in enumerate(commits)}
        assert [x.source_page for x in table.commit_log().orderBy("commit_version").collect()] == commits
        assert {x.source_page for x in table.progress().where("complete").collect()} == done
    assert len(commits) > n  # pages came again
    silver = silver_orders(table.read())
    assert silver.count() == n * size == silver.select("order_id").distinct().count()


def test_append_below_the_current_version_is_refused(spark, workdir, run_id):
    pages = _land(spark, workdir, pages=2, page_size=5, start_page=1)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, pages, table, run_id)
    old = table.read().where("commit_version = 0").drop("batch")
    with pytest.raises(ValueError, match="not above"):
        table.append(old)
    assert table.version() == 1 and table.read().count() == 10


def test_failed_write_keeps_earlier_chunks_on_record(spark, workdir, run_id, monkeypatch):
    pages = _land(spark, workdir, pages=3, page_size=5, start_page=1)
    table = BronzeTable(spark, f"{workdir}/bronze")
    write = BronzeTable.write_batch

    def full_disk(self, rows):
        if self.version() is not None:
            raise OSError("no space left")
        return write(self, rows)

    monkeypatch.setattr(BronzeTable, "write_batch", full_disk)
    with pytest.raises(IngestError) as err:
        ingest(spark, pages, table, run_id, max_pages_per_batch=2)
    assert err.value.result.pages_appended == [1, 2]
    assert err.value.result.rows_appended == 10


def test_other_run_id_reappends_everything(spark, workdir, run_id):
    pages = _land(spark, workdir, pages=2, page_size=5, start_page=1)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, pages, table, run_id)
    again = ingest(spark, pages, table, run_id)
    assert again.pages_appended == [] and again.pages_skipped == [1, 2]
    other = ingest(spark, pages, table, "RUN-0188")
    assert other.pages_appended == [1, 2]
    assert table.read().count() == 20


def test_validation_commits_pages_before_first_bad_page(spark, workdir, run_id):
    landing = f"{workdir}/landing"
    good = source_records(spark, pages=4, page_size=3, start_page=1)
    # page 3 loses one event id; page 4 is fine but comes after it
    broken = good.withColumn(
        "value",
        F.when(
            (F.col("source_page") == 3) & F.col("value").contains("evt-000003-0001"),
            F.regexp_replace("value", '"event_id":"[^"]*"', '"event_id":""'),
        ).otherwise(F.col("value")),
    )
    write_pages(broken, landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    with pytest.raises(IngestError) as err:
        ingest(spark, read_pages(spark, landing), table, run_id)
    assert isinstance(err.value.cause, SourcePayloadError)
    assert "page 3" in str(err.value)
    assert err.value.result.pages_appended == [1, 2]
    assert sorted(r.source_page for r in table.read().select("source_page").distinct().collect()) == [1, 2]


def test_unparsable_timestamp_is_a_plain_error(spark, workdir, run_id):
    landing = f"{workdir}/landing"
    recs = source_records(spark, pages=2, page_size=2, start_page=1).withColumn(
        "value",
        F.when(F.col("source_page") == 2, F.regexp_replace("value", '"updated_at":"[^"]*"', '"updated_at":"yesterday"'))
        .otherwise(F.col("value")),
    )
    write_pages(recs, landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    with pytest.raises(IngestError) as err:
        ingest(spark, read_pages(spark, landing), table, run_id)
    assert type(err.value.cause) is ValueError
    assert err.value.result.pages_appended == [1]


def test_incomplete_batch_is_invisible(spark, workdir, run_id):
    pages = _land(spark, workdir, pages=1, page_size=4, start_page=1)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, pages, table, run_id)
    # a second batch that a writer left staged when it died
    pages.limit(2).write.parquet(f"{workdir}/bronze/_staging/batch=1/commit_version=9")
    assert table.version() == 0
    assert table.read().count() == 4
    assert table.next_batch() == 2


def test_ingest_folder_lists_pages_without_scanning(spark, workdir, run_id):
    from lakestrata.plans.ingest import ingest_folder

    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=4, page_size=3, start_page=5), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    res = ingest_folder(spark, landing, table, run_id, max_pages_per_batch=3)
    assert res.pages_appended == [5, 6, 7, 8] and res.rows_appended == 12 and len(res.batches) == 2
    log = {(r.commit_version, r.source_page, r.rows) for r in table.commit_log().collect()}
    assert log == {(0, 5, 3), (1, 6, 3), (2, 7, 3), (3, 8, 3)}
    hist = {(r.commit_version, r.source_page, r.rows) for r in commit_history(table.read()).collect()}
    assert hist == log


def test_idempotent_batch_retry_does_not_duplicate(spark, workdir, run_id):
    pages = _land(spark, workdir, pages=3, page_size=5, start_page=41)
    table = BronzeTable(spark, f"{workdir}/bronze")
    with pytest.raises(IngestError):
        ingest(spark, pages, table, run_id, after_commit=crash_on(42), max_pages_per_batch=1, idempotent=True)
    res = ingest(spark, pages, table, run_id, max_pages_per_batch=1, idempotent=True)
    assert res.pages_skipped == [41, 42] and res.pages_appended == [43]
    assert table.read().count() == 15


def test_empty_landed_page_keeps_versions_consistent(spark, workdir, run_id):
    import os

    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=2, page_size=3, start_page=1), landing)
    os.makedirs(f"{landing}/source_page=3", exist_ok=True)
    open(f"{landing}/source_page=3/part-empty.txt", "w").close()
    from lakestrata.plans.ingest import ingest_folder

    table = BronzeTable(spark, f"{workdir}/bronze")
    res = ingest_folder(spark, landing, table, run_id)
    assert res.pages_appended == [1, 2, 3] and res.rows_appended == 6
    assert table.version() == 2  # the empty page holds version 2 without rows
    write_pages(source_records(spark, pages=1, page_size=3, start_page=4), landing)
    res2 = ingest_folder(spark, landing, table, run_id)
    assert res2.pages_appended == [4] and res2.first_version == 3


def test_schema_merge_append_and_second_reader(spark, workdir, run_id):
    """An append with an extra nullable column; old rows read NULL in it,
    and a plain Parquet reader sees every row."""
    pages = _land(spark, workdir, pages=1, page_size=20, start_page=41)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, pages, table, run_id)
    assert spark.read.parquet(f"{workdir}/bronze/batch=0").count() == 20
    extra = table.read().limit(5).withColumn("source_region", F.lit(None).cast("string")).withColumn(
        "commit_version", F.lit(1).cast("long")
    )
    table.append(extra.drop("batch"))
    merged = table.read()
    assert "source_region" in merged.columns and merged.count() == 25
    assert merged.where(F.col("source_region").isNotNull()).count() == 0


def test_legacy_append_is_a_breaking_schema(spark, workdir, run_id):
    from lakestrata.contracts import BRONZE_ORDERS_RAW
    from lakestrata.operators.quality import check_schema
    from lakestrata.plans.ingest import legacy_append

    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=2, page_size=3), landing)
    legacy = legacy_append(spark, landing, f"{workdir}/legacy", run_id)
    assert legacy.count() == 6
    r = check_schema(spark, BRONZE_ORDERS_RAW, legacy, nullability="ignore").first()
    assert r.kind == "breaking"
    assert "source_updated_at:timestamp>string" in r.retyped and "source_page:int>bigint" in r.retyped


def test_second_engine_reads_bronze(spark, workdir, run_id):
    """Another engine (DuckDB) reads the committed Bronze files directly."""
    import duckdb

    pages = _land(spark, workdir, pages=1, page_size=20, start_page=41)
    table = BronzeTable(spark, f"{workdir}/bronze")
    ingest(spark, pages, table, run_id)
    n, versions = duckdb.sql(
        f"SELECT COUNT(*), COUNT(DISTINCT commit_version) FROM read_parquet("
        f"'{workdir}/bronze/batch=*/commit_version=*/*.parquet', hive_partitioning = true)"
    ).fetchall()[0]
    assert (n, versions) == (20, 1)


def test_ingest_folder_never_reads_completed_pages(spark, workdir, run_id):
    import glob

    from lakestrata.plans.ingest import ingest_folder

    landing = f"{workdir}/landing"
    write_pages(source_records(spark, pages=2, page_size=3, start_page=1), landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    assert ingest_folder(spark, landing, table, run_id).pages_appended == [1, 2]
    for f in glob.glob(f"{landing}/source_page=1/*.txt"):
        with open(f, "w") as fh:
            fh.write("not json at all\n")
    write_pages(source_records(spark, pages=1, page_size=3, start_page=3), landing)
    res = ingest_folder(spark, landing, table, run_id)
    assert res.pages_skipped == [1, 2] and res.pages_appended == [3]
    assert table.read().count() == 9


def test_bad_page_in_second_chunk(spark, workdir, run_id):
    """Chunks of 2 pages: chunk 1 (pages 1-2) commits; in chunk 2 page 3 is
    committed and page 4, holding the bad record, and everything after it is not."""
    landing = f"{workdir}/landing"
    recs = source_records(spark, pages=5, page_size=2, start_page=1).withColumn(
        "value",
        F.when(
            (F.col("source_page") == 4) & F.col("value").contains("evt-000004-0001"),
            F.regexp_replace("value", '"updated_at":"[^"]*"', '"updated_at":""'),
        ).otherwise(F.col("value")),
    )
    write_pages(recs, landing)
    table = BronzeTable(spark, f"{workdir}/bronze")
    with pytest.raises(IngestError) as err:
        ingest(spark, read_pages(spark, landing), table, run_id, max_pages_per_batch=2)
    assert isinstance(err.value.cause, SourcePayloadError) and "updated_at" in str(err.value)
    assert err.value.result.pages_appended == [1, 2, 3]
    assert sorted(r.source_page for r in table.read().select("source_page").distinct().collect()) == [1, 2, 3]
    assert table.version() == 2
    # after the source is fixed, the retry appends 4 and 5 only
    fixed = f"{workdir}/landing-fixed"
    write_pages(source_records(spark, pages=5, page_size=2, start_page=1), fixed)
    again = ingest(spark, read_pages(spark, fixed), table, run_id, max_pages_per_batch=2)
    assert again.pages_skipped == [1, 2, 3] and again.pages_appended == [4, 5]
    assert table.read().count() == 10
