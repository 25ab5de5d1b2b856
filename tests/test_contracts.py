"""Contract classification (Q1/Q2) and audits (Q4/Q6)."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakestrata.contracts import BRONZE_ORDERS_RAW, GOLD_CUSTOMER_VALUE, SILVER_CUSTOMERS, SILVER_ORDERS, SchemaContractViolation
from lakestrata.operators import quality as Q


CONTRACTS = [BRONZE_ORDERS_RAW, SILVER_ORDERS, SILVER_CUSTOMERS, GOLD_CUSTOMER_VALUE]
OTHER_TYPE = {T.StringType(): T.BinaryType(), T.IntegerType(): T.LongType(), T.LongType(): T.IntegerType(), T.TimestampType(): T.StringType()}


def _empty(spark, schema):
    return spark.createDataFrame([], schema)


def _edited(contract, r):
    """A schema some random edits away from the contract, and the finding that they must give."""
    found = {"added": [], "removed": [], "retyped": [], "loosened": []}
    fields = []
    for f in contract.schema():
        edit = r.choice(["keep"] * 5 + ["drop", "retype", "loosen", "tighten"])
        if edit == "drop":
            found["removed"].append(f.name)
            continue
        kind, nullable = f.dataType, f.nullable
        if edit == "retype":
            kind = OTHER_TYPE.get(kind, T.StringType())
            found["retyped"].append(f"{f.name}:{f.dataType.simpleString()}>{kind.simpleString()}")
        elif edit == "loosen" and not nullable:
            nullable = True
            found["loosened"].append(f.name)
        elif edit == "tighten":
            nullable = False
        fields.append(T.StructField(f.name, kind, nullable))
    for k in range(r.choice([0, 0, 1, 3])):
        found["added"].append(f"extra_{k}")
        fields.append(T.StructField(f"extra_{k}", T.DoubleType()))
    r.shuffle(fields)  # the order of columns is no part of a contract
    broken = found["removed"] or found["retyped"] or found["loosened"]
    kind = "breaking" if broken else "additive" if found["added"] else "none"
    return T.StructType(fields), kind, {k: ",".join(sorted(v)) for k, v in found.items()}


def test_random_edits_are_classified_by_what_they_do(spark):
    r, kinds = random.Random(31), set()
    for n in range(24):
        contract = CONTRACTS[n % len(CONTRACTS)]
        schema, kind, found = _edited(contract, r) if n >= 4 else (contract.schema(), "none", dict.fromkeys(("added", "removed", "retyped", "loosened"), ""))
        row = Q.check_schema(spark, contract, _empty(spark, schema)).collect()[0]
        assert (row.table_name, row.kind) == (contract.name, kind), found
        assert {k: row[k] or "" for k in found} == found
        kinds.add(kind)
    assert kinds == {"none", "additive", "breaking"}


def test_breaking_columns_are_rows_and_the_error_lists_them(spark):
    fields = [f for f in BRONZE_ORDERS_RAW.schema() if f.name not in ("payload", "source_page")]
    found = Q.check_schema(spark, BRONZE_ORDERS_RAW, _empty(spark, T.StructType([*fields, T.StructField("source_page", T.LongType())])))
    rows = sorted(tuple(r) for r in Q.breaking_columns(found).collect())
    assert rows == [
        ("orders_raw", "loosened", "source_page"),
        ("orders_raw", "removed", "payload"),
        ("orders_raw", "retyped", "source_page:int>bigint"),
    ]
    with pytest.raises(SchemaContractViolation, match="orders_raw.payload removed"):
        Q.raise_if_breaking(found)


def test_data_nullability_on_parquet_reads(spark, workdir):
    """Parquet reads mark every column nullable; data-level checks do not."""
    df = spark.createDataFrame([("a", 1), (None, 2)], "k string, v int")
    df.write.parquet(f"{workdir}/t")
    back = spark.read.parquet(f"{workdir}/t")
    counts = {r.column_name: r.null_count for r in Q.null_counts(back, "t").collect()}
    assert counts == {"k": 1, "v": 0}
    obs = {r.column_name: r.nullable for r in Q.observed_columns(spark, {"t": back}).collect()}
    assert obs == {"k": True, "v": False}


def test_grain_violations_and_constraints(spark):
    df = spark.createDataFrame([("c1", 1), ("c1", 2), ("c2", -1), ("c3", None)], "customer_id string, x int")
    assert [(r.customer_id, r.rows) for r in Q.grain_violations(df, ["customer_id"]).collect()] == [("c1", 2)]
    bad = Q.constraint_violations(df, F.col("x") >= 0).collect()
    assert [r.customer_id for r in bad] == ["c2"]  # NULL passes a CHECK
