"""Guarded casts and Silver rejects (edge rows from FIXTURES.md section 3)."""

from decimal import Decimal

from pyspark.sql import functions as F

from lakestrata.functions.parsing import iso_timestamp, present, strict_date, strict_decimal
from lakestrata.operators.dedupe import dedupe_by_source_event
from lakestrata.operators.silver import parse_orders


def test_strict_decimal(spark):
    vals = ["10.005", "abc", "12345678901234567", "10.500", "1e2", "10.50", None]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.d for r in df.select(strict_decimal("v").alias("d")).collect()]
    assert got == [None, None, None, Decimal("10.50"), Decimal("100.00"), Decimal("10.50"), None]


def test_strict_date_and_presence(spark):
    df = spark.createDataFrame([("2026-09-01",), ("2026-9-1",), ("2026-09-01T00:00:00",), ("",), (None,)], "v string")
    rows = df.select(strict_date("v").alias("d"), present("v").alias("p")).collect()
    assert [r.d is not None for r in rows] == [True, False, False, False, False]
    assert [r.p for r in rows] == [True, True, True, False, False]


def test_iso_timestamp_utc(spark):
    df = spark.createDataFrame([("2026-09-01T08:00:00Z",), ("2026-09-01T10:00:00+02:00",), ("yesterday",)], "v string")
    got = [r.t for r in df.select(iso_timestamp("v").cast("string").alias("t")).collect()]
    assert got == ["2026-09-01 08:00:00", "2026-09-01 08:00:00", None]


def _bronze(spark, rows):
    return spark.createDataFrame(
        rows,
        "source_event_id string, source_updated_at timestamp, ingested_at timestamp, ingestion_run_id string, "
        "source_page int, payload string",
    )


def test_rejects_carry_reasons(spark):
    from datetime import datetime

    t = datetime(2026, 9, 1)
    good = '{"order_id":"o1","customer_id":"c","order_date":"2026-09-01","status":"Completed","net_amount":"10.50"}'
    rows = [
        ("e1", t, t, "r", 1, good),
        ("e2", t, t, "r", 1, good.replace("10.50", "10.005")),
        ("e3", t, t, "r", 1, good.replace("2026-09-01", "2026-9-1")),
        ("e4", t, t, "r", 1, "{not json"),
        ("e5", t, t, "r", 1, good.replace('"status":"Completed",', "")),
    ]
    parsed = {r.source_event_id: r for r in parse_orders(_bronze(spark, rows)).collect()}
    assert parsed["e1"].reject_reason is None and parsed["e1"].order_status == "completed"
    assert parsed["e2"].reject_reason == "bad_net_amount"
    assert parsed["e3"].reject_reason == "bad_order_date"
    assert parsed["e4"].reject_reason == "malformed_json"
    assert parsed["e5"].reject_reason == "missing_status"


def test_dedupe_prefers_newest_update_then_ingest(spark):
    from datetime import datetime

    a, b = datetime(2026, 9, 1, 8), datetime(2026, 9, 1, 9)
    rows = [
        ("e1", a, b, "r", 1, "old-update-late-ingest"),
        ("e1", b, a, "r", 1, "new-update"),
        ("e2", a, a, "r", 1, "first"),
        ("e2", a, b, "r", 2, "replay"),
        ("e3", None, b, "r", 1, "null-ts"),
        ("e3", a, a, "r", 1, "has-ts"),
    ]
    kept = {r.source_event_id: r.payload for r in dedupe_by_source_event(_bronze(spark, rows)).collect()}
    assert kept == {"e1": "new-update", "e2": "replay", "e3": "has-ts"}
    assert dedupe_by_source_event(_bronze(spark, [])).count() == 0


def test_sorted_key_json_keeps_nulls(spark):
    from lakestrata.functions.parsing import sorted_key_json

    df = spark.createDataFrame([("x", None, "1")], "updated_at string, event_id string, amount string")
    assert df.select(sorted_key_json(*df.columns).alias("j")).first().j == '{"amount":"1","event_id":null,"updated_at":"x"}'


def test_dedupe_full_timestamp_tie_is_deterministic(spark):
    from datetime import datetime

    t = datetime(2026, 9, 1, 8)
    rows = [
        ("e1", t, t, "RUN-1", 1, '{"v":"b"}'),
        ("e1", t, t, "RUN-1", 2, '{"v":"a"}'),  # later page wins the tie
        ("e2", t, t, "RUN-1", 1, '{"v":"b"}'),
        ("e2", t, t, "RUN-1", 1, '{"v":"a"}'),  # same page: smaller payload wins
    ]
    for _ in range(2):  # independent of input order / partitioning
        df = _bronze(spark, rows).repartition(3)
        kept = {r.source_event_id: r.payload for r in dedupe_by_source_event(df).collect()}
        assert kept == {"e1": '{"v":"a"}', "e2": '{"v":"a"}'}
        rows.reverse()


def test_page_ranges_compact_gaps(spark):
    from lakestrata.operators.history import page_ranges

    df = spark.createDataFrame(
        [("r1", p) for p in (1, 2, 3, 5, 7, 8, 8)] + [("r2", 4)], "ingestion_run_id string, source_page int"
    )
    got = {r.ingestion_run_id: (r.pages, r.page_count) for r in page_ranges(df, ["ingestion_run_id"]).collect()}
    assert got == {"r1": ("1-3,5,7-8", 6), "r2": ("4", 1)}


def test_iso_timestamp_needs_a_whole_date(spark):
    bad = ["10:00", "T10:00:00", "2026", "2026-09", "2026-09-01 10:00:00 Europe/Copenhagen", "", "now"]
    good = ["2026-09-01T10:00:00Z", "2026-09-01T12:00:00+02:00", "2026-09-01 10:00:00", "2026-09-01T10:00"]
    df = spark.createDataFrame([(x,) for x in bad + good], "v string").select("v", iso_timestamp("v").alias("t"))
    got = {r.v: r.t for r in df.collect()}
    assert all(got[x] is None for x in bad)
    assert len({got[x] for x in good}) == 1 and None not in {got[x] for x in good}
