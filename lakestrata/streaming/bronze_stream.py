"""I1-I4 as Structured Streaming: landed page files -> Bronze.

``readStream`` over the landing folder (text, one JSON record per line);
the page number comes from the file path.  A micro-batch only announces
pages: inside ``foreachBatch`` each announced page that is not complete is
read whole from its directory and goes through the batch ingest (validate,
envelope, append one commit version per page, hook, progress).  So it does
not matter how a page's files fall into micro-batches.  Landing rule: a page's
directory appears with all its files.  Records that land in a completed
page later stop the stream with :class:`LateRecords`.

Delivery is at-least-once and replay-visible, exactly like the batch path:
if the hook raises after the append, the stream stops before the batch is
marked committed in the streaming checkpoint; on restart the same files are
re-delivered and the pages without progress are appended again.  Commit
versions are max + 1 over the table, never the micro-batch id (a retried
micro-batch keeps its id, and two commits of one page must stay two).

``idempotent=True`` skips pages already committed for this run according
to the table's own commit log (written before the batch becomes visible)
instead of the progress rows, so a retry does not duplicate (I4).
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.validation import PageSet
from ..plans.ingest import completed_pages, ingest
from ..sources.bronze import BronzeTable
from ..sources.landing import read_page_dirs

PAGE_FROM_PATH = r"source_page=(\d+)"


def landing_stream(spark: SparkSession, landing: str, max_files_per_trigger: int = 1000) -> DataFrame:
    """Streaming (source_page, value) over ``<landing>/source_page=<p>/*`` files."""
    raw = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .option("recursiveFileLookup", "true")
        .load(landing)
    )
    page = F.regexp_extract(F.col("_metadata.file_path"), PAGE_FROM_PATH, 1).cast("int")
    return raw.select(page.alias("source_page"), "value")


class LateRecords(RuntimeError):
    """Files arrived for a page that was already ingested."""


def refuse_late_records(spark: SparkSession, landing: str, table: BronzeTable, run_id: str, pages: list[int]) -> None:
    """Fail if a completed page now holds other than the records it was committed with."""
    now = read_page_dirs(spark, landing, pages).groupBy("source_page").agg(F.count("*").alias("landed"))
    log = table.commit_log().where(F.col("ingestion_run_id") == run_id).groupBy("source_page").agg(F.max_by("rows", "commit_version").alias("rows"))
    late = [r.source_page for r in now.join(log, "source_page").where("landed <> rows").select("source_page").collect()]
    if late:
        raise LateRecords(f"run {run_id}: records landed after the ingest of pages {sorted(late)}")


def start_bronze_stream(
    spark: SparkSession,
    landing: str,
    table: BronzeTable,
    run_id: str,
    checkpoint: str | None = None,
    after_commit: Callable[[int, int], None] | None = None,
    max_files_per_trigger: int = 1000,
    max_pages_per_batch: int = 10_000,
    idempotent: bool = False,
    available_now: bool = True,
) -> StreamingQuery:
    checkpoint = checkpoint or f"{table.root}/_stream/{run_id}"  # the same on a restart

    known: list[PageSet] = []  # the pages done, read in the first micro-batch; the stream is the table's one writer

    def each_batch(batch: DataFrame, batch_id: int) -> None:
        # The micro-batch only announces pages (at most maxFilesPerTrigger); each is read whole from its directory.
        session = batch.sparkSession
        own = replace(table, spark=session)  # with the stream's settings
        pages = sorted(r.source_page for r in batch.select("source_page").distinct().collect())
        if not pages:
            return
        if not known:
            known.append(completed_pages(own, run_id, idempotent))
        done = known[0]
        if again := [p for p in pages if p in done]:
            refuse_late_records(session, landing, own, run_id, again)
        if pending := [p for p in pages if p not in done]:
            ingest(
                session,
                read_page_dirs(session, landing, pending),
                own,
                run_id,
                after_commit=after_commit,
                max_pages_per_batch=max_pages_per_batch,
                pages=pending,
                idempotent=idempotent,
                done=done,
            )
            for p in pending:
                done.add(p)

    writer = landing_stream(spark, landing, max_files_per_trigger).writeStream.foreachBatch(each_batch).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def run_to_completion(query: StreamingQuery) -> None:
    """Block until an availableNow query drains; re-raise its failure."""
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise exc
