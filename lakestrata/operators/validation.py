"""Page-level validation, commit cut-off, envelope and page skipping.

P1  page_validation   one aggregate per page (map-side partial counts)
P2  committable_pages pages before the first bad page (first bad page is a
                      scalar subquery, not a cross join)
P3  envelope          record text -> Bronze envelope columns
P6  pending_pages     pages not yet complete for this run (left anti join)
    page_bitmaps      the same from one bit per completed page
"""

from __future__ import annotations

from datetime import datetime
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.parsing import ENVELOPE_FIELDS, iso_timestamp, json_struct, present


@lru_cache(maxsize=1)
def _record(jvm) -> Column:
    return json_struct("value", ENVELOPE_FIELDS).alias("_r")


def _envelope_fields(landing: DataFrame, *more: str) -> DataFrame:
    return landing.select("source_page", "value", *more, _record(landing.sparkSession.sparkContext._jvm))


@lru_cache(maxsize=1)
def _flags(jvm) -> dict[str, Column]:
    """Columns of :func:`envelope_with_flags`, made once: a stream would spend
    more on making them in each micro-batch than on the records."""
    ts = iso_timestamp("_r.updated_at")
    return {
        "source_updated_at": ts.alias("source_updated_at"),
        "_missing_id": (~present("_r.event_id")).alias("_missing_id"),
        "_missing_ts": (~present("_r.updated_at")).alias("_missing_ts"),
        "_bad_ts": (present("_r.updated_at") & ts.isNull()).alias("_bad_ts"),
    }


def page_validation(landing: DataFrame) -> DataFrame:
    """P1 + F16: per page, records lacking a truthy event_id / updated_at, and
    updated_at text that is present but not a timestamp."""
    r = _envelope_fields(landing)
    has_id = present("_r.event_id")
    has_ts = present("_r.updated_at")
    bad_ts = has_ts & iso_timestamp("_r.updated_at").isNull()
    return (
        r.groupBy("source_page")
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.count_if(~has_id).alias("missing_event_id"),
            F.count_if(~has_ts).alias("missing_updated_at"),
            F.count_if(bad_ts).alias("bad_updated_at"),
        )
        .withColumn(
            "is_valid",
            (F.col("missing_event_id") == 0) & (F.col("missing_updated_at") == 0) & (F.col("bad_updated_at") == 0),
        )
    )


def committable_pages(validation: DataFrame) -> DataFrame:
    """Pages are committed in order up to, not including, the first bad page."""
    first_bad = validation.where(~F.col("is_valid")).agg(F.min("source_page")).scalar()
    return validation.select(
        "source_page",
        "is_valid",
        F.coalesce(F.col("source_page") < first_bad, F.lit(True)).alias("committable"),
    )


def envelope(landing: DataFrame, run_id: str, ingested_at: datetime | str) -> DataFrame:
    """Bronze envelope; the landed record text is kept verbatim as payload."""
    r = _envelope_fields(landing)
    return r.select(
        F.col("_r.event_id").alias("source_event_id"),
        iso_timestamp("_r.updated_at").alias("source_updated_at"),
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("ingestion_run_id"),
        F.col("source_page").cast("int").alias("source_page"),
        F.col("value").alias("payload"),
    )


def envelope_with_flags(landing: DataFrame, run_id: str, ingested_at: datetime | str | Column, *more: str) -> DataFrame:
    """P3 plus the P1 flags of each record, from ONE parse of the record text:
    ``_missing_id``, ``_missing_ts`` and ``_bad_ts`` (present but unparsable).

    ``more`` names columns of ``landing`` to keep; ``ingested_at`` may be one of them."""
    r = _envelope_fields(landing, *more)
    flags = _flags(landing.sparkSession.sparkContext._jvm)
    return r.select(
        F.col("_r.event_id").alias("source_event_id"),
        flags["source_updated_at"],
        F.lit(ingested_at).cast("timestamp").alias("ingested_at"),
        F.lit(run_id).alias("ingestion_run_id"),
        F.col("source_page").cast("int").alias("source_page"),
        F.col("value").alias("payload"),
        flags["_missing_id"],
        flags["_missing_ts"],
        flags["_bad_ts"],
        *more,
    )


def pending_pages(pages: DataFrame, progress: DataFrame, run_id: str) -> DataFrame:
    """Pages of ``pages`` not complete for ``run_id`` (another run re-appends all)."""
    done = progress.where((F.col("run_id") == run_id) & F.col("complete")).select("source_page")
    return pages.join(done, "source_page", "left_anti").withColumn("run_id", F.lit(run_id))


BITMAP_BITS = 32_768  # of Spark's bitmap functions


def page_bitmaps(completed: DataFrame) -> DataFrame:
    """Completed (run_id, source_page) rows as (run_id, bucket, pages): 4 KB for 32,768 pages.

    Partial bitmaps are built map-side, so a run of any size ships one row
    per bucket and task."""
    page = F.col("source_page").cast("long")
    return completed.groupBy("run_id", F.bitmap_bucket_number(page).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(page)).alias("pages")
    )


def pending_by_bitmap(pages: DataFrame, bitmaps: DataFrame, run_id: str) -> DataFrame:
    """P6 / J4 by a bit test instead of an anti join on pages."""
    own = bitmaps.where(F.col("run_id") == run_id).select("bucket", F.col("pages").alias("_pages"))
    page = F.col("source_page").cast("long")
    place = F.bitmap_bit_position(page)
    byte = F.conv(F.hex(F.expr("substring(_pages, cast(_place div 8 as int) + 1, 1)")), 16, 10).cast("int")
    tested = pages.withColumn("bucket", F.bitmap_bucket_number(page)).withColumn("_place", place).join(own, "bucket", "left")
    done = F.coalesce(byte.bitwiseAND(F.expr("shiftleft(1, cast(_place % 8 as int))")) != 0, F.lit(False))
    return tested.where(~done).drop("bucket", "_place", "_pages").withColumn("run_id", F.lit(run_id))


class PageSet:
    """Membership test over collected bitmaps of one run: one bit per page on the driver."""

    def __init__(self, bitmaps: DataFrame):
        self.bits = {r["bucket"]: bytearray(r["pages"]) for r in bitmaps.select("bucket", "pages").collect()}

    @staticmethod
    def _place(page: int) -> tuple[int, int]:
        return (1 + (page - 1) // BITMAP_BITS, (page - 1) % BITMAP_BITS) if page > 0 else (-(-page // BITMAP_BITS), -page % BITMAP_BITS)

    def __contains__(self, page: int) -> bool:
        bucket, place = self._place(page)
        bits = self.bits.get(bucket)
        return bits is not None and bool(bits[place // 8] >> place % 8 & 1)

    def add(self, page: int) -> None:
        bucket, place = self._place(page)
        self.bits.setdefault(bucket, bytearray(BITMAP_BITS // 8))[place // 8] |= 1 << place % 8
