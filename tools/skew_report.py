"""Hot-key behaviour of the operators, measured from Spark's event log.

Usage: python tools/skew_report.py [sf_dir] > SKEW.md

Builds skewed inputs from the driver tables: every ``F`` order is moved to
one customer (a third of all orders), and one Bronze event is replayed until
its copies are a third of all rows.  Each operator runs with shuffle joins
forced (no broadcast) and partition coalescing off, so every shuffle
partition is visible.  For each shuffle stage the report gives the records
read and the share of the busiest task: a share near 1/partitions is even,
a share near 1/3 means the hot key went to one task whole.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PARTITIONS = 16


def main() -> None:
    from pyspark.sql import functions as F

    from lakestrata.operators import gold
    from lakestrata.operators.dedupe import dedupe_by_source_event
    from lakestrata.operators.history import replay_report
    from lakestrata.operators.quality import grain_violations
    from lakestrata.session import get_spark
    from lakestrata.sources import adapters as A

    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    log_dir = tempfile.mkdtemp(prefix="lakestrata-eventlog-")
    spark = get_spark(
        "local[8]",
        app_name="skew-report",
        shuffle_partitions=PARTITIONS,
        extra_conf={
            "spark.eventLog.enabled": "true",
            "spark.eventLog.dir": log_dir,
            "spark.eventLog.compress": "false",
            "spark.eventLog.rolling.enabled": "false",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    )
    orders = A.orders_as_silver(spark, sf)
    raw = A.read(spark, sf, "orders").select(F.col("o_orderkey").cast("string").alias("order_id"), "o_orderstatus")
    hot_orders = orders.join(raw, "order_id").select(
        "order_id",
        F.when(F.col("o_orderstatus") == "F", F.lit("HOT")).otherwise(F.col("customer_id")).alias("customer_id"),
        "order_date",
        "order_status",
        "net_amount",
    )
    hot_day = orders.join(raw, "order_id").select(
        "order_id",
        "customer_id",
        F.when(F.col("o_orderstatus") == "F", F.lit("1998-08-02").cast("date")).otherwise(F.col("order_date")).alias(
            "order_date"
        ),
        "order_status",
        "net_amount",
    )
    calendar = gold.calendar_from(orders, "order_date")
    customers = A.customers_as_silver(spark, sf).unionByName(
        spark.range(1).select(F.lit("HOT").alias("customer_id"), F.lit("HOUSEHOLD").alias("market"))
    )
    bronze = A.events_as_bronze(spark, sf, replayed_pages=())
    n = bronze.count()
    one = bronze.where(F.col("source_event_id") == "0")
    copies = one.select("*", F.explode(F.sequence(F.lit(1), F.lit(n // 2))).alias("_copy")).select(
        *[c for c in bronze.columns if c != "commit_version"],
        (F.col("commit_version") + F.col("_copy")).alias("commit_version"),
    )
    hot_bronze = bronze.unionByName(copies)

    def naive_customer_value(o, c):
        j = c.join(gold.completed_orders(o), "customer_id", "left")
        return j.groupBy("customer_id", "market").agg(
            F.min("order_date"), F.max("order_date"), F.sum("net_amount"), F.countDistinct("order_id")
        )

    jobs = [
        ("gold.customer_value, hot customer", lambda: gold.customer_value(hot_orders, customers)),
        ("naive join-then-group, hot customer", lambda: naive_customer_value(hot_orders, customers)),
        ("gold.daily_revenue, hot day", lambda: gold.daily_revenue(calendar, hot_day)),
        ("grain_violations, hot customer", lambda: grain_violations(hot_orders, ["customer_id"])),
        ("dedupe_by_source_event, hot event", lambda: dedupe_by_source_event(hot_bronze)),
        ("replay_report, hot event", lambda: replay_report(hot_bronze)),
    ]
    for label, build in jobs:
        spark.sparkContext.setJobDescription(label)
        build().write.format("noop").mode("overwrite").save()
    spark.sparkContext.setJobDescription(None)
    app = spark.sparkContext.applicationId
    spark.stop()
    report(log_dir, app, [label for label, _ in jobs])


def report(log_dir: str, app: str, labels: list[str]) -> None:
    found = [p for p in glob.glob(os.path.join(log_dir, "*")) if app in os.path.basename(p)][0]
    files = sorted(glob.glob(os.path.join(found, "events_*"))) if os.path.isdir(found) else [found]
    stage_label: dict[int, str] = {}
    tasks: dict[int, list[int]] = {}
    for path in files:
        for line in open(path):
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                desc = (ev.get("Properties") or {}).get("spark.job.description")
                for sid in ev.get("Stage IDs", []):
                    if desc:
                        stage_label[sid] = desc
            elif kind == "SparkListenerTaskEnd":
                m = ev.get("Task Metrics") or {}
                rec = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                if rec:
                    tasks.setdefault(ev["Stage ID"], []).append(rec)
    print("# Hot keys: records per shuffle task\n")
    print("Generated by `python tools/skew_report.py` from Spark's event log (sf0.1 driver tables, made skewed: one")
    print("customer holds every `F` order, about a third of all orders; one event is replayed until its copies are")
    print(f"a third of Bronze). Shuffle joins forced, {PARTITIONS} shuffle partitions, no coalescing. \"Busiest task\" is")
    print("the largest share of a stage's shuffle records read by one task; even spread is 1/16 = 0.06.\n")
    print("| Operator | Stage | Shuffle records read | Busiest task | Busiest task share |")
    print("|---|---|---|---|---|")
    for label in labels:
        for sid in sorted(s for s, lab in stage_label.items() if lab == label and s in tasks):
            recs = tasks[sid]
            total = sum(recs)
            print(f"| {label} | {sid} | {total:,} | {max(recs):,} | {max(recs) / total:.2f} |")


if __name__ == "__main__":
    main()
