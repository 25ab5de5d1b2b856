"""Bronze -> Silver jobs with input contract check, reject gate and publish.

``prepare_orders`` / ``prepare_customers``:
1. classify the Bronze schema against the envelope contract (names and
   types from the schema, no data read; nullability is metadata, as
   declared) and raise SchemaContractViolation when breaking;
2. dedupe by source event (one shuffle) and parse;
3. write the good rows as a new Silver version while an Observation counts
   the rejects in the same pass; publish only if there are none.

``prepare_incremental`` gives the same Silver rows without re-sorting all
of Bronze on every run.  Its table stores, next to the contract columns, the
envelope columns the dedupe order needs (``ingested_at``, ``source_page``,
``payload``, ``source_event_id``; extra columns are "additive" under the
contract), so every published row is the current winner of its event.  A
run reads only the Bronze commits newer than the ones already folded in
(partition-pruned on ``commit_version``), keeps the newest delivery of each
touched event and decides it against the event's previous winner.  The result
equals a full rebuild because the winner over all deliveries is the winner over
(previous winner, winner of the new deliveries).

The rows that win or lose their place are the version's change feed.  On a
:class:`BucketedTable` only the buckets of touched events are read and only
those of changed events are written; a plain :class:`VersionedTable` is
rewritten whole.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from ..contracts import BRONZE_CUSTOMERS_RAW, BRONZE_ORDERS_RAW, SILVER_CUSTOMERS, SILVER_ORDERS, TableContract
from ..operators import quality as Q
from ..operators.dedupe import dedupe_by_source_event, envelope_order
from ..operators.silver import REJECT, parse_customers, parse_orders
from ..session import scratch_dir
from ..sources.bronze import BronzeTable
from ..sources.buckets import BucketedTable
from ..sources.tables import WEIGHT, VersionedTable


def _check_input(spark: SparkSession, contract: TableContract, bronze: DataFrame) -> None:
    contract_cols = bronze.select(*[c for c in bronze.columns if c not in ("batch", "commit_version")])
    Q.raise_if_breaking(Q.check_schema(spark, contract, contract_cols, nullability="ignore"))


def _prepare(spark, bronze, silver, input_contract, output_contract, parse) -> DataFrame:
    _check_input(spark, input_contract, bronze)
    obs = Observation(f"silver_rejects_{uuid.uuid4().hex}")
    parsed = parse(dedupe_by_source_event(bronze)).observe(obs, F.count_if(F.col(REJECT).isNotNull()).alias("rejects"))
    good = parsed.where(F.col(REJECT).isNull()).select(*output_contract.names)
    if silver is not None:
        silver.publish(good, gate=lambda: {"rejects": obs.get["rejects"]})
        return silver.read()
    return good


def prepare_orders(spark: SparkSession, bronze: DataFrame, silver: VersionedTable | None = None) -> DataFrame:
    return _prepare(spark, bronze, silver, BRONZE_ORDERS_RAW, SILVER_ORDERS, parse_orders)


def prepare_customers(spark: SparkSession, bronze: DataFrame, silver: VersionedTable | None = None) -> DataFrame:
    return _prepare(spark, bronze, silver, BRONZE_CUSTOMERS_RAW, SILVER_CUSTOMERS, parse_customers)


ENVELOPE = ["source_event_id", "source_updated_at", "ingested_at", "ingestion_run_id", "source_page", "payload"]


def prepare_incremental(
    spark: SparkSession,
    bronze: BronzeTable,
    silver: VersionedTable,
    dataset: str = "orders",
) -> DataFrame:
    """Silver refresh from the Bronze commits not yet folded in (see module doc).

    Returns the contract columns of the published version."""
    input_contract, output_contract, parse = (
        (BRONZE_ORDERS_RAW, SILVER_ORDERS, parse_orders)
        if dataset == "orders"
        else (BRONZE_CUSTOMERS_RAW, SILVER_CUSTOMERS, parse_customers)
    )
    stored = output_contract.names + [c for c in ENVELOPE if c not in output_contract.names]
    bronze_version = bronze.version()
    current = silver.current()
    if current is not None and current[1].get("bronze") == bronze_version:
        return silver.read().select(*output_contract.names)
    inputs = {"bronze": bronze_version}
    obs = Observation(f"silver_rejects_{uuid.uuid4().hex}")
    rejects = F.count_if(F.col(REJECT).isNotNull()).alias("rejects")
    if current is None or current[1].get("bronze") is None:
        full = bronze.read()
        _check_input(spark, input_contract, full)
        parsed = parse(dedupe_by_source_event(full.select(*ENVELOPE))).observe(obs, rejects)
        good = parsed.where(F.col(REJECT).isNull()).select(*stored)
        silver.publish(good, gate=lambda: {"rejects": obs.get["rejects"]}, inputs=inputs)
        return silver.read().select(*output_contract.names)

    new = bronze.read_since(current[1]["bronze"])
    _check_input(spark, input_contract, new)
    new = dedupe_by_source_event(new.select(*ENVELOPE))
    by_bucket = isinstance(silver, BucketedTable)
    previous = silver.read(current[0], only=silver.touched(new)) if by_bucket else silver.read(current[0])
    path = scratch_dir(spark, "silver-changes")
    changed_winners(previous.select(*stored), parse(new)).observe(obs, rejects).write.parquet(path)
    gate = {"rejects": obs.get["rejects"]}
    changes = spark.read.parquet(path).drop(REJECT)
    changed = changes.select("source_event_id").distinct()
    if by_bucket:
        touched = silver.touched(changed)
        previous = silver.read(current[0], only=touched)
    kept = previous.select(*stored).join(changed, "source_event_id", "left_anti")
    out = kept.unionByName(changes.where(F.col(WEIGHT) > 0).select(*stored))
    if by_bucket:
        silver.replace(out, touched, inputs=inputs, changes=changes, gate=lambda: gate)
    else:
        silver.publish(out, gate=lambda: gate, inputs=inputs, changes=changes)
    return silver.read().select(*output_contract.names)


def changed_winners(previous: DataFrame, parsed: DataFrame) -> DataFrame:
    """V7: rows of events whose winner changes, the old one (change_weight -1) and the new one (1).

    ``previous`` has the current winners, ``parsed`` at most one new delivery
    of an event (with its reject reason).  At most two rows of an event meet;
    on a full tie the current winner stays."""
    old = previous.withColumn(REJECT, F.lit(None).cast("string")).withColumn(WEIGHT, F.lit(-1).cast("long"))
    new = parsed.select(*old.columns[:-1]).withColumn(WEIGHT, F.lit(1).cast("long"))
    old = old.join(new.select("source_event_id"), "source_event_id", "left_semi").select(*old.columns)
    event = Window.partitionBy("source_event_id")
    place = F.row_number().over(event.orderBy(*envelope_order(), F.col(WEIGHT)))
    both = old.unionByName(new).withColumn("_place", place)
    moved = F.max((F.col("_place") == 1) & (F.col(WEIGHT) > 0)).over(event)
    both = both.withColumn("_moved", moved)
    return both.where("_moved").drop("_place", "_moved")
