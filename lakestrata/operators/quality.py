"""Contract classification and data-quality audits as Spark jobs.

Q1 classify            expected vs observed column metadata of many tables
                       at once: full outer join on (table, column), flags,
                       then one row per table with its severity
Q2 breaking_columns, raise_if_breaking   offending columns as rows; raise from them
Q4 null_counts         one pass, count_if(col IS NULL) for every column
   stored_null_counts  the same of a stored table from its Parquet footers
Q5 constraint_violations  rows failing a CHECK (NULL passes, as in SQL CHECK)
Q6 grain_violations    keys of a declared grain that occur more than once

Nullability of a Parquet read is always "nullable", so observed
nullability is taken from the data (a column is nullable when it holds a
NULL) unless the caller asks for the schema flag.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import SchemaContractViolation, TableContract

COLUMN_META = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("column_name", T.StringType(), False),
        T.StructField("data_type", T.StringType(), False),
        T.StructField("nullable", T.BooleanType(), False),
    ]
)


def contract_columns(spark: SparkSession, contracts: Iterable[TableContract]) -> DataFrame:
    rows = [(c.name, col.name, col.dtype.simpleString(), col.nullable) for c in contracts for col in c.columns]
    return spark.createDataFrame(rows, COLUMN_META)


def _sql_str(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def column_profile(df: DataFrame, table_name: str) -> DataFrame:
    """(table_name, column_name, data_type, null_count, rows) in a single scan.

    One global aggregate (partial counts per task, one row shuffled per
    task), then ``stack`` turns its one row into one row per column."""
    fields = df.schema.fields
    aggs = [F.count(F.lit(1)).alias("_rows")] + [
        F.count_if(F.col(f"`{f.name}`").isNull()).alias(f"_n{i}") for i, f in enumerate(fields)
    ]
    triples = ", ".join(
        f"{_sql_str(f.name)}, {_sql_str(f.dataType.simpleString())}, _n{i}" for i, f in enumerate(fields)
    )
    return df.agg(*aggs).select(
        F.lit(table_name).alias("table_name"),
        F.expr(f"stack({len(fields)}, {triples}) AS (column_name, data_type, null_count)"),
        F.col("_rows").alias("rows"),
    )


def null_counts(df: DataFrame, table_name: str) -> DataFrame:
    """Q4: (table_name, column_name, null_count, rows) in a single scan of ``df``."""
    return column_profile(df, table_name).drop("data_type")


def observed_columns(
    spark: SparkSession, tables: Mapping[str, DataFrame], nullability: str = "data"
) -> DataFrame:
    """Observed (table, column, type, nullable) for each named DataFrame.

    ``nullability="data"`` profiles each table in one scan (a column is
    nullable when it holds a NULL); ``"schema"`` trusts the schema flag and
    reads no data."""
    out = None
    for name, df in tables.items():
        if nullability == "data":
            meta = column_profile(df, name).select(
                "table_name", "column_name", "data_type", (F.col("null_count") > 0).alias("nullable")
            )
        else:
            meta = spark.createDataFrame(
                [(name, f.name, f.dataType.simpleString(), f.nullable) for f in df.schema.fields], COLUMN_META
            )
        out = meta if out is None else out.unionByName(meta)
    if out is None:
        return spark.createDataFrame([], COLUMN_META)
    return out


def _joined(items: Column) -> Column:
    return F.array_join(F.array_sort(items), ",")


def classify(expected: DataFrame, observed: DataFrame) -> DataFrame:
    """Q1: per expected table, ``kind`` (none / additive / breaking) and the
    added, removed, retyped (``col:expected>observed``) and loosened columns.

    Column order is ignored; a column can be both retyped and loosened;
    tightening (contract nullable, observed not) is allowed."""
    e = expected.select(
        "table_name", "column_name", F.col("data_type").alias("e_type"), F.col("nullable").alias("e_null")
    )
    o = observed.select(
        "table_name", "column_name", F.col("data_type").alias("o_type"), F.col("nullable").alias("o_null")
    )
    j = e.join(o, ["table_name", "column_name"], "full_outer")
    flagged = j.select(
        "table_name",
        F.col("e_type").isNotNull().alias("_expected"),
        F.when(F.col("e_type").isNull(), F.col("column_name")).alias("_added"),
        F.when(F.col("o_type").isNull(), F.col("column_name")).alias("_removed"),
        F.when(
            F.col("e_type").isNotNull() & F.col("o_type").isNotNull() & (F.col("e_type") != F.col("o_type")),
            F.concat_ws("", F.col("column_name"), F.lit(":"), F.col("e_type"), F.lit(">"), F.col("o_type")),
        ).alias("_retyped"),
        F.when(
            F.col("o_type").isNotNull() & ~F.col("e_null") & F.col("o_null"), F.col("column_name")
        ).alias("_loosened"),
    )
    # only tables that have a contract are classified (a per-table flag
    # instead of a semi join, whose key would be a folded literal per table)
    per_table = flagged.groupBy("table_name").agg(
        F.max(F.col("_expected").cast("int")).alias("_has_contract"),
        _joined(F.collect_list("_added")).alias("added"),
        _joined(F.collect_list("_removed")).alias("removed"),
        _joined(F.collect_list("_retyped")).alias("retyped"),
        _joined(F.collect_list("_loosened")).alias("loosened"),
    )
    breaking = (F.col("removed") != "") | (F.col("retyped") != "") | (F.col("loosened") != "")
    kind = F.when(breaking, F.lit("breaking")).when(F.col("added") != "", F.lit("additive")).otherwise(F.lit("none"))
    return per_table.where(F.col("_has_contract") == 1).select(
        "table_name", kind.alias("kind"), "added", "removed", "retyped", "loosened"
    )


def breaking_columns(classification: DataFrame) -> DataFrame:
    """Q2: one row (table_name, change, column_name) per column that breaks its contract.

    ``column_name`` of a retyped column carries both types, as in :func:`classify`;
    a comma within brackets is part of a decimal type."""
    changes = F.array(
        *(F.struct(F.lit(c).alias("change"), F.col(c).alias("names")) for c in ("loosened", "removed", "retyped"))
    )
    return (
        classification.select("table_name", F.inline(changes))
        .where(F.col("names") != "")
        .select("table_name", "change", F.explode(F.split("names", r",(?![^(]*\))")).alias("column_name"))
    )


def raise_if_breaking(classification: DataFrame) -> None:
    """Q2: raise with every offending column (metadata rows, at most one per contract column and change)."""
    found = breaking_columns(classification).orderBy("table_name", "change", "column_name").collect()
    if found:
        raise SchemaContractViolation(", ".join(f"{r.table_name}.{r.column_name} {r.change}" for r in found))


def check_schema(spark: SparkSession, contract: TableContract, df: DataFrame, nullability: str = "schema") -> DataFrame:
    """Classify one DataFrame against one contract (``nullability="schema"`` reads no data)."""
    if nullability == "ignore":
        observed = observed_columns(spark, {contract.name: df}, "schema").withColumn("nullable", F.lit(False))
    else:
        observed = observed_columns(spark, {contract.name: df}, nullability)
    return classify(contract_columns(spark, [contract]), observed)


def grain_violations(df: DataFrame, keys: list[str] | tuple[str, ...]) -> DataFrame:
    """Q6: keys of the declared grain occurring more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > 1)


def constraint_violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a CHECK condition is FALSE (NULL passes)."""
    return df.where(~F.coalesce(condition, F.lit(True)))


FOOTER_READ = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def footer_reads(spark: SparkSession) -> Iterator[None]:
    """Parquet through the V2 reader with aggregates pushed into the scan, for plans made and run inside."""
    before = {k: spark.conf.get(k) for k in FOOTER_READ}
    try:
        for k, v in FOOTER_READ.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def footer_counts(spark: SparkSession, path: str) -> DataFrame:
    """COUNT(*) and COUNT(column) of a stored table; use inside :func:`footer_reads`."""
    stored = spark.read.parquet(path)
    return stored.agg(F.count(F.lit(1)).alias("_rows"), *(F.count(c).alias(c) for c in stored.columns))


def stored_null_counts(spark: SparkSession, path: str, table_name: str) -> DataFrame:
    """Q4 of a stored Parquet table from its footers alone: no column is read.

    The counts (one number per column) are found at once, as the pushed plan
    needs its settings while it runs.  Columns of nested types can't be pushed
    by Spark; a table that has any is counted by a scan."""
    with footer_reads(spark):
        row = {c: n or 0 for c, n in footer_counts(spark, path).first().asDict().items()}  # null without any file
    rows = row.pop("_rows")
    return spark.createDataFrame(
        [(table_name, c, rows - n, rows) for c, n in row.items()], "table_name string, column_name string, null_count long, rows long"
    )
