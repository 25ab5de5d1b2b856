"""Registered queries: one per operator family, each over the driver tables.

Every entry takes ``(spark, sf_dir)`` and returns a DataFrame.  Results are
passed through :func:`report`, which converts exact decimals to DOUBLE and
timestamps to TIMESTAMP_NTZ at the very end, so the result compares equal to
the DuckDB oracle (whose pandas export turns DECIMAL into float64).  All
arithmetic before that is exact decimal.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .contracts import FEED_CONTRACTS
from .functions.parsing import json_field
from .operators import gold
from .operators import history
from .operators import quality as Q
from .operators import silver
from .operators import validation as V
from .operators.dedupe import dedupe_by_source_event
from .plans import refresh as R
from .plans import runs as RUNS
from .sources import adapters as A

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

GOLD_AS_OF = "2001-08-01"


def register(name: str):
    """Register a query; it runs with the session time zone pinned to UTC,
    which the pipeline's timestamp semantics assume."""

    def wrap(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return fn

    return wrap


def report(df: DataFrame) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.TimestampType):
            c = c.cast("timestamp_ntz")
        cols.append(c.alias(f.name))
    return df.select(*cols)


# --------------------------------------------------------------------- gold


def _orders_calendar(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    orders = A.orders_as_silver(spark, sf_dir)
    return orders, gold.calendar_from(orders, "order_date")


@register("gold_customer_value")
def q_gold_customer_value(spark, sf_dir):
    return report(gold.customer_value(A.orders_as_silver(spark, sf_dir), A.customers_as_silver(spark, sf_dir)))


@register("gold_daily_revenue")
def q_gold_daily_revenue(spark, sf_dir):
    orders, cal = _orders_calendar(spark, sf_dir)
    return report(gold.daily_revenue(cal, orders))


def gold_views(spark: SparkSession, sf_dir: str, as_of: str = GOLD_AS_OF):
    orders, cal = _orders_calendar(spark, sf_dir)
    cv = gold.customer_value(orders, A.customers_as_silver(spark, sf_dir))
    dr = gold.daily_revenue(cal, orders)
    return cv, dr, gold.commercial_summary(cv, dr, as_of)


@register("gold_commercial_summary")
def q_gold_commercial_summary(spark, sf_dir):
    return report(gold_views(spark, sf_dir)[2])


# ------------------------------------------------------------------- silver


@register("silver_dedupe_events")
def q_silver_dedupe_events(spark, sf_dir):
    return report(dedupe_by_source_event(A.events_as_bronze(spark, sf_dir)))


@register("payload_json_field")
def q_payload_json_field(spark, sf_dir):
    b = A.events_as_bronze(spark, sf_dir)
    return report(b.select("source_event_id", "source_page", "commit_version", json_field("payload", "k").alias("k")))


@register("silver_orders")
def q_silver_orders(spark, sf_dir):
    return report(silver.silver_orders(A.orders_as_bronze(spark, sf_dir)))


@register("silver_rejects")
def q_silver_rejects(spark, sf_dir):
    rej = silver.silver_order_rejects(A.orders_as_bronze(spark, sf_dir, defects=True))
    return report(rej.select("source_event_id", "source_page", silver.REJECT))


@register("silver_customers")
def q_silver_customers(spark, sf_dir):
    return report(silver.silver_customers(A.customers_as_bronze(spark, sf_dir)))


@register("customer_value_fanout")
def q_customer_value_fanout(spark, sf_dir):
    """V1 over customers whose grain is not enforced: the join fans out."""
    return report(gold.customer_value(A.orders_as_silver(spark, sf_dir), A.events_as_customers(spark, sf_dir)))


@register("customer_value_grain_enforced")
def q_customer_value_grain_enforced(spark, sf_dir):
    from .operators.dedupe import keep_latest

    cust = keep_latest(
        A.events_as_customers(spark, sf_dir),
        ["customer_id"],
        (F.col("source_updated_at").desc_nulls_last(), F.col("source_event_id").desc_nulls_last()),
    )
    return report(gold.customer_value(A.orders_as_silver(spark, sf_dir), cust))


# ------------------------------------------------------------------- ingest


LANDING_INGEST_TIME = "2024-02-01 00:00:00"
PROGRESS_CUTOFF = "2024-01-16 00:00:00"


@register("bronze_envelope")
def q_bronze_envelope(spark, sf_dir):
    landing = A.events_as_landing(spark, sf_dir)
    return report(V.envelope(landing, A.RUN_ID, LANDING_INGEST_TIME))


@register("page_validation")
def q_page_validation(spark, sf_dir):
    return report(V.page_validation(A.events_as_landing(spark, sf_dir)))


@register("committable_pages")
def q_committable_pages(spark, sf_dir):
    return report(V.committable_pages(V.page_validation(A.events_as_landing(spark, sf_dir))))


def _progress_from_events(spark, sf_dir):
    """Progress of an earlier run RUN-A that ingested the pages whose events
    all precede PROGRESS_CUTOFF."""
    ev = A.read(spark, sf_dir, "events")
    return (
        ev.groupBy(A.event_page())
        .agg(F.max("ts").alias("_last"))
        .where(F.col("_last") < F.lit(PROGRESS_CUTOFF).cast("timestamp_ntz"))
        .select(
            F.lit("RUN-A").alias("run_id"),
            "source_page",
            F.lit(True).alias("complete"),
            (F.col("source_page") - 1).cast("long").alias("commit_version"),
        )
    )


@register("pending_pages")
def q_pending_pages(spark, sf_dir):
    pages = A.events_as_landing(spark, sf_dir).select("source_page").distinct()
    progress = _progress_from_events(spark, sf_dir)
    return report(
        V.pending_pages(pages, progress, "RUN-A").unionByName(V.pending_pages(pages, progress, "RUN-B"))
    )


@register("commit_history")
def q_commit_history(spark, sf_dir):
    h = history.commit_history(A.events_as_bronze(spark, sf_dir))
    per_page = Window.partitionBy("ingestion_run_id", "source_page")
    return report(h.withColumn("commits_for_page", F.count(F.lit(1)).over(per_page)))


@register("bronze_replay_report")
def q_bronze_replay_report(spark, sf_dir):
    return report(history.replay_report(A.events_as_bronze(spark, sf_dir)))


@register("replayed_events")
def q_replayed_events(spark, sf_dir):
    return report(history.replayed_events(A.events_as_bronze(spark, sf_dir)))


@register("ingest_summary")
def q_ingest_summary(spark, sf_dir):
    return report(history.ingest_summary(A.events_as_bronze(spark, sf_dir)))


# ------------------------------------------------------------------ quality


@register("contract_classification")
def q_contract_classification(spark, sf_dir):
    observed = {c.name: A.read(spark, sf_dir, c.name.split(".", 1)[1]) for c in FEED_CONTRACTS}
    return report(Q.classify(Q.contract_columns(spark, FEED_CONTRACTS), Q.observed_columns(spark, observed)))


def _bronze_with_null_payloads(spark, sf_dir):
    """Events Bronze where error events arrive without a payload."""
    b = A.events_as_bronze(spark, sf_dir)
    ev = A.read(spark, sf_dir, "events").select(F.col("event_id").cast("string").alias("source_event_id"), "event_type")
    return b.join(ev, "source_event_id").select(
        *[c for c in b.columns if c != "payload"],
        F.when(F.col("event_type") == "error", F.lit(None).cast("string")).otherwise(F.col("payload")).alias("payload"),
    )


@register("null_audit")
def q_null_audit(spark, sf_dir):
    return report(Q.null_counts(_bronze_with_null_payloads(spark, sf_dir), "orders_raw"))


@register("grain_violations")
def q_grain_violations(spark, sf_dir):
    return report(Q.grain_violations(A.events_as_customers(spark, sf_dir), ["customer_id"]))


def signed_event_orders(spark, sf_dir):
    """Events as completed orders whose amount is the value, and -3 x value for
    error events (refunds), so some days end with negative revenue."""
    ev = A.read(spark, sf_dir, "events")
    amount = F.col("value").cast("decimal(18,2)")
    return ev.select(
        F.col("event_id").cast("string").alias("order_id"),
        F.col("user_id").cast("string").alias("customer_id"),
        F.col("ts").cast("date").alias("order_date"),
        F.lit("completed").alias("order_status"),
        F.when(F.col("event_type") == "error", amount * F.lit(-3)).otherwise(amount).cast("decimal(18,2)").alias(
            "net_amount"
        ),
    )


@register("constraint_violations")
def q_constraint_violations(spark, sf_dir):
    orders = signed_event_orders(spark, sf_dir)
    dr = gold.daily_revenue(gold.calendar_from(orders, "order_date"), orders)
    return report(Q.constraint_violations(dr, F.col("gross_revenue") >= 0))


# ------------------------------------------------------------------ refresh


INCREMENTAL_CUTOFF = "2001-01-01"
LATE_COMPLETION_FROM = "2000-07-01"


def old_orders_snapshot(spark, sf_dir):
    """Silver orders as they stood on INCREMENTAL_CUTOFF: later orders not yet
    there, and orders completed since LATE_COMPLETION_FROM still open."""
    o = A.orders_as_silver(spark, sf_dir).where(F.col("order_date") < F.lit(INCREMENTAL_CUTOFF).cast("date"))
    late = (F.col("order_date") >= F.lit(LATE_COMPLETION_FROM).cast("date")) & (F.col("order_status") == "completed")
    return o.withColumn("order_status", F.when(late, F.lit("open")).otherwise(F.col("order_status")))


@register("customer_value_incremental")
def q_customer_value_incremental(spark, sf_dir):
    """V6/V7: incremental customer_value from the old snapshot's view plus the
    change set; the oracle is the FULL view over the new snapshot."""
    old_o, new_o = old_orders_snapshot(spark, sf_dir), A.orders_as_silver(spark, sf_dir)
    customers = A.customers_as_silver(spark, sf_dir)
    old_view = gold.customer_value(old_o, customers)
    affected = R.affected_customers(R.order_changes(old_o, new_o))
    return report(R.incremental_customer_value(old_view, new_o, customers, affected))


def source_version_log(spark, sf_dir):
    """(tick, table_name, version): one tick per day of ``events``.  silver.orders
    moves on days where an events page completes, silver.customers on days a
    new user appears, silver.calendar never; version = commit days before the tick."""
    ev = A.read(spark, sf_dir, "events")
    ticks = gold.calendar_from(ev.select(F.col("ts").cast("date").alias("d")), "d").select(
        F.col("calendar_date").alias("tick")
    )
    order_days = ev.groupBy(A.event_page()).agg(F.max("ts").cast("date").alias("tick")).select("tick").distinct()
    cust_days = ev.groupBy("user_id").agg(F.min("ts").cast("date").alias("tick")).select("tick").distinct()
    w = Window.partitionBy("table_name").orderBy("tick").rowsBetween(Window.unboundedPreceding, -1)

    def log(name, days):
        flagged = ticks.join(days.withColumn("_c", F.lit(1)), "tick", "left").select(
            "tick", F.lit(name).alias("table_name"), F.coalesce(F.col("_c"), F.lit(0)).alias("_c")
        )
        return flagged.withColumn("version", F.coalesce(F.sum("_c").over(w), F.lit(0)).cast("long")).drop("_c")

    static = ticks.select("tick", F.lit("silver.calendar").alias("table_name"), F.lit(0).cast("long").alias("version"))
    return log("silver.orders", order_days).unionByName(log("silver.customers", cust_days)).unionByName(static)


@register("refresh_decision")
def q_refresh_decision(spark, sf_dir):
    return report(R.refresh_decisions(source_version_log(spark, sf_dir)))


@register("schema_merge_append")
def q_schema_merge_append(spark, sf_dir):
    """Append a batch carrying an extra nullable column, read merged."""
    from .session import scratch_dir
    from .sources.bronze import BronzeTable

    table = BronzeTable(spark, scratch_dir(spark, "schema-merge"))
    bronze = A.events_as_bronze(spark, sf_dir)
    table.append(bronze.where(F.col("ingested_at") == F.lit(A.FIRST_INGEST).cast("timestamp")))
    table.append(
        bronze.where(F.col("ingested_at") > F.lit(A.FIRST_INGEST).cast("timestamp")).withColumn(
            "source_region", json_field("payload", "k")
        )
    )
    merged = table.read()
    return report(
        merged.groupBy("commit_version").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("source_region").alias("region_rows"),
            F.max("source_region").alias("max_region"),
        )
    )


@register("streaming_bronze_counts")
def q_streaming_bronze_counts(spark, sf_dir):
    """Stream the landed events pages (several files each) into Bronze,
    crash once after the commit of the last page, restart from the streaming checkpoint; rows,
    distinct events and commits of every page as they stand in Bronze."""
    from pyspark.errors import StreamingQueryException

    from .plans.ingest import CheckpointWriteInterrupted
    from .session import few_listing_tasks, scratch_dir
    from .sources.bronze import BronzeTable
    from .sources.landing import write_pages
    from .streaming.bronze_stream import run_to_completion, start_bronze_stream

    landing, root = scratch_dir(spark, "stream-landing"), scratch_dir(spark, "stream-bronze")
    ckpt = scratch_dir(spark, "stream-ckpt")
    write_pages(A.events_as_landing(spark, sf_dir, defects=False), landing)
    table = BronzeTable(spark, root)
    last = A.read(spark, sf_dir, "events").agg(F.max(A.event_page()).alias("page")).first()["page"]
    crashed = []

    def crash_once(page, version):
        if page == last and not crashed:
            crashed.append(page)
            raise CheckpointWriteInterrupted("simulated crash after commit")

    try:
        with few_listing_tasks(spark):
            run_to_completion(start_bronze_stream(spark, landing, table, A.RUN_ID, ckpt, crash_once, max_files_per_trigger=64))
    except StreamingQueryException as exc:
        if "simulated crash after commit" not in str(exc):
            raise
    if crashed != ([] if last is None else [last]):
        raise RuntimeError(f"the stream did not stop after page {last}")
    with few_listing_tasks(spark):
        run_to_completion(start_bronze_stream(spark, landing, table, A.RUN_ID, ckpt, max_files_per_trigger=64))
    return report(
        table.read().groupBy("source_page").agg(
            F.count(F.lit(1)).alias("rows"),
            F.countDistinct("source_event_id").alias("events"),
            F.countDistinct("commit_version").alias("commits"),
            F.min("source_updated_at").alias("first_update"),
        )
    )


# -------------------------------------------------------------------- runs


def manifests_from_events(spark, sf_dir):
    """One ingest run per day of ``events``.  Status follows the day's first
    event type; a run commits the pages that complete that day (0 when
    none), and versions accumulate over earlier runs (one row per run, so an
    ordered window over the whole manifest table is fine)."""
    ev = A.read(spark, sf_dir, "events")
    page_done = ev.groupBy(A.event_page()).agg(F.max("ts").cast("date").alias("day"))
    completions = page_done.groupBy("day").agg(F.count(F.lit(1)).alias("_pages"))
    days = ev.groupBy(F.col("ts").cast("date").alias("day")).agg(
        F.min_by("event_type", "ts").alias("_first"), F.count(F.lit(1)).alias("rows_appended")
    )
    status = (
        F.when(F.col("_first").isin("purchase", "click"), F.lit("ok"))
        .when(F.col("_first") == "view", F.lit("validation_error: record missing event_id"))
        .when(F.col("_first") == "signup", F.lit("checkpoint_write_interrupted: simulated crash after commit"))
        .otherwise(F.lit("error: unparsable updated_at"))
    )
    appended = F.when(
        F.col("status").startswith("error:") | F.col("status").startswith("validation_error:"), F.lit(0)
    ).otherwise(F.coalesce(F.col("_pages"), F.lit(0)))
    m = (
        days.join(completions, "day", "left")
        .withColumn("status", status)
        .withColumn("_commits", appended.cast("long"))
    )
    w = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_commits").over(w), F.lit(0)).cast("long")
    return m.select(
        F.concat(F.lit("RUN-"), F.date_format("day", "yyyyMMdd")).alias("run_id"),
        F.col("day").cast("timestamp").alias("finished_at"),
        "status",
        "rows_appended",
        before.alias("version_before"),
        (before + F.col("_commits")).alias("version_after"),
    )


@register("manifest_gate")
def q_manifest_gate(spark, sf_dir):
    g = RUNS.gate(manifests_from_events(spark, sf_dir))
    return report(g.select("run_id", "status", "action", "version_before", "version_after", "gated"))


@register("failure_owner")
def q_failure_owner(spark, sf_dir):
    """Runtime failures from the run manifests plus logic failures from
    daily_revenue refreshes that broke the CHECK, counted per owner."""
    runs = manifests_from_events(spark, sf_dir).select("status")
    orders = signed_event_orders(spark, sf_dir)
    dr = gold.daily_revenue(gold.calendar_from(orders, "order_date"), orders)
    refresh = Q.constraint_violations(dr, F.col("gross_revenue") >= 0).select(
        F.lit("constraint_violation: non_negative_revenue").alias("status")
    )
    failures = runs.unionByName(refresh).select(RUNS.failure_owner("status").alias("owner"), "status")
    return report(
        failures.where(F.col("owner").isNotNull())
        .groupBy("owner", F.split("status", ":").getItem(0).alias("status_kind"))
        .agg(F.count(F.lit(1)).alias("failures"))
    )


@register("image_pin_audit")
def q_image_pin_audit(spark, sf_dir):
    """Every event as a submitted run with an image reference."""
    ev = A.read(spark, sf_dir, "events")
    digest = F.sha2(F.col("props"), 256)
    image = (
        F.when(F.col("event_type") == "purchase", F.concat(F.lit("lakehouse/ingest@sha256:"), digest))
        .when(F.col("event_type") == "view", F.lit("lakehouse/ingest:latest"))
        .when(F.col("event_type") == "click", F.lit("lakehouse/ingest:v1.4.2"))
        .when(F.col("event_type") == "signup", F.lit("lakehouse/ingest"))
        .otherwise(F.concat(F.lit("lakehouse/ingest@sha256:"), F.upper(digest)))
    )
    runs = ev.select(
        F.concat(F.lit("RUN-"), F.col("event_id").cast("string")).alias("run_id"),
        image.alias("image"),
        F.upper(F.substring(F.md5("props"), 1, 6)).alias("git_commit"),
    )
    return report(runs.withColumn("pinned", RUNS.image_pinned("image")))


def two_commit_silver(spark, sf_dir, silver):
    """Silver built incrementally: first deliveries committed and folded in,
    then the later updates committed and folded in."""
    from .plans.silver import prepare_incremental
    from .session import scratch_dir
    from .sources.bronze import BronzeTable

    bronze = A.orders_as_bronze(spark, sf_dir)
    first_ingest = F.lit(A.FIRST_INGEST).cast("timestamp")
    table = BronzeTable(spark, scratch_dir(spark, "inc-silver-bronze"))
    table.append(bronze.where(F.col("ingested_at") == first_ingest).withColumn("commit_version", F.lit(0).cast("long")))
    prepare_incremental(spark, table, silver)
    table.append(bronze.where(F.col("ingested_at") > first_ingest).withColumn("commit_version", F.lit(1).cast("long")))
    return prepare_incremental(spark, table, silver)


def bucketed_silver(spark):
    from .session import scratch_dir
    from .sources.buckets import BucketedTable

    return BucketedTable(spark, scratch_dir(spark, "bucket-silver"), ("source_event_id",), 16)


@register("silver_orders_incremental")
def q_silver_orders_incremental(spark, sf_dir):
    """Incremental Silver in a plain versioned table; equals the full Silver."""
    from .session import scratch_dir
    from .sources.tables import VersionedTable

    return report(two_commit_silver(spark, sf_dir, VersionedTable(spark, scratch_dir(spark, "inc-silver"))))


@register("silver_orders_bucketed")
def q_silver_orders_bucketed(spark, sf_dir):
    """S5 + W1 on hash buckets of the event id; equals the full Silver."""
    return report(two_commit_silver(spark, sf_dir, bucketed_silver(spark)))


@register("silver_change_feed")
def q_silver_change_feed(spark, sf_dir):
    """V7: the feed written with the second Silver version; the oracle is the
    difference of the two snapshots, both ways."""
    silver = bucketed_silver(spark)
    two_commit_silver(spark, sf_dir, silver)
    names = ["source_event_id", "order_id", "order_status", "net_amount", "source_updated_at", "change_weight"]
    return report(silver.changes(0, silver.version()).select(*names))


@register("gold_refresh_incremental")
def q_gold_refresh_incremental(spark, sf_dir):
    """refresh_gold over published tables: full on the old orders snapshot,
    then incremental after the new snapshot is published; customer_value."""
    from .session import scratch_dir
    from .sources.tables import VersionedTable

    old_o, new_o = old_orders_snapshot(spark, sf_dir), A.orders_as_silver(spark, sf_dir)
    root = scratch_dir(spark, "inc-gold")
    t = {n: VersionedTable(spark, f"{root}/{n}") for n in list(R.VIEW_INPUTS) + ["silver.orders", "silver.customers", "silver.calendar"]}
    t["silver.orders"].publish(old_o)
    t["silver.customers"].publish(A.customers_as_silver(spark, sf_dir))
    t["silver.calendar"].publish(gold.calendar_from(new_o, "order_date"))
    R.refresh_gold(spark, t, as_of=GOLD_AS_OF, incremental=True)
    t["silver.orders"].publish(new_o, changes=True)
    out = R.refresh_gold(spark, t, as_of=GOLD_AS_OF, incremental=True)
    assert out[0].decision == "incremental", out
    return report(t["gold.customer_value"].read())


def old_orders_with_returns(spark, sf_dir):
    """The old snapshot, where some orders that are cancelled by now still
    counted as completed: rows that leave the views, extremes among them."""
    o = old_orders_snapshot(spark, sf_dir)
    return o.withColumn("order_status", F.when(F.col("order_status") == "cancelled", F.lit("completed")).otherwise(F.col("order_status")))


def counted_views(spark, sf_dir):
    """V6 by counting over bucketed views: state from the old snapshot, then
    one step along the change feeds (inserts, updates, leaving rows)."""
    from .session import scratch_dir
    from .sources.buckets import BucketedTable
    from .sources.tables import VersionedTable

    new_o = A.orders_as_silver(spark, sf_dir)
    root = scratch_dir(spark, "counted-gold")
    t = {n: VersionedTable(spark, f"{root}/{n}") for n in list(R.VIEW_INPUTS) + ["silver.orders", "silver.customers", "silver.calendar"]}
    t["gold.customer_value"] = BucketedTable(spark, f"{root}/gold.customer_value", ("customer_id",), 16)
    t["silver.orders"].publish(old_orders_with_returns(spark, sf_dir))
    t["silver.customers"].publish(A.customers_as_silver(spark, sf_dir))
    t["silver.calendar"].publish(gold.calendar_from(new_o, "order_date"))
    state = R.CountedGold(spark, f"{root}/counts", 16)
    R.refresh_gold(spark, t, as_of=GOLD_AS_OF, incremental=True, state=state)
    t["silver.orders"].publish(new_o, changes=True)
    t["silver.customers"].publish(A.customers_as_silver(spark, sf_dir), changes=True)
    out = R.refresh_gold(spark, t, as_of=GOLD_AS_OF, incremental=True, state=state)
    assert [o.decision for o in out] == ["incremental"] * 3, out
    return t


@register("gold_counted_customer_value")
def q_gold_counted_customer_value(spark, sf_dir):
    return report(counted_views(spark, sf_dir)["gold.customer_value"].read())


@register("gold_counted_daily_revenue")
def q_gold_counted_daily_revenue(spark, sf_dir):
    return report(counted_views(spark, sf_dir)["gold.daily_revenue"].read())


@register("gold_counted_summary")
def q_gold_counted_summary(spark, sf_dir):
    return report(counted_views(spark, sf_dir)["gold.commercial_summary"].read())


@register("external_count")
def q_external_count(spark, sf_dir):
    """Bronze as any Parquet reader finds it below its root, after a crash
    just past the commit of the middle page; the pages behind it stay unseen."""
    from .plans.ingest import CheckpointWriteInterrupted, IngestError, ingest
    from .session import scratch_dir
    from .sources.bronze import BronzeTable

    landing = A.events_as_landing(spark, sf_dir, defects=False)
    middle = A.read(spark, sf_dir, "events").agg(((F.max(A.event_page()) + 1) / 2).cast("int").alias("page")).first()["page"]
    table = BronzeTable(spark, scratch_dir(spark, "external-bronze"))

    def crash(page, version):
        if page == middle:
            raise CheckpointWriteInterrupted("simulated crash after commit")

    try:
        ingest(spark, landing, table, A.RUN_ID, after_commit=crash)
    except IngestError as exc:
        if not isinstance(exc.cause, CheckpointWriteInterrupted):
            raise
    plain = spark.read.parquet(table.root)
    return report(plain.groupBy("source_page", "commit_version").agg(F.count(F.lit(1)).alias("rows"), F.max("source_updated_at").alias("last_update")))


@register("idempotent_pages")
def q_idempotent_pages(spark, sf_dir):
    """I4: every events page delivered, then a third of them once more by the
    same run and a third by another run."""
    from .plans.ingest import ingest_replacing
    from .session import scratch_dir
    from .sources.pages import PageTable

    landing = A.events_as_landing(spark, sf_dir, defects=False)
    table = PageTable(spark, scratch_dir(spark, "page-table"))
    ingest_replacing(spark, landing, table, "RUN-A")
    ingest_replacing(spark, landing.where("source_page % 3 = 0"), table, "RUN-A")
    ingest_replacing(spark, landing.where("source_page % 3 = 1"), table, "RUN-B")
    return report(
        table.read().groupBy("ingestion_run_id", "source_page").agg(
            F.count(F.lit(1)).alias("rows"), F.countDistinct("source_event_id").alias("events"), F.max("source_updated_at").alias("last_update")
        )
    )


@register("null_audit_stored")
def q_null_audit_stored(spark, sf_dir):
    """Q4 of the stored table from Parquet footers."""
    from .session import scratch_dir

    path = scratch_dir(spark, "null-audit")
    _bronze_with_null_payloads(spark, sf_dir).write.parquet(path)
    return report(Q.stored_null_counts(spark, path, "orders_raw"))


@register("pending_pages_bitmap")
def q_pending_pages_bitmap(spark, sf_dir):
    """P6 / J4 by bitmaps of completed pages; the same oracle as the anti join."""
    pages = A.events_as_landing(spark, sf_dir).select("source_page").distinct()
    bitmaps = V.page_bitmaps(_progress_from_events(spark, sf_dir).where("complete"))
    return report(
        V.pending_by_bitmap(pages, bitmaps, "RUN-A").unionByName(V.pending_by_bitmap(pages, bitmaps, "RUN-B"))
    )
