"""Versioned, append-only Bronze table on plain Parquet (no table format jar).

Layout::

    <root>/_staging/batch=<b>/commit_version=<v>/part-*.parquet   written, not yet committed
    <root>/batch=<b>/commit_version=<v>/part-*.parquet            committed
    <root>/batch=<b>/_pages/*.parquet                             (version, page, run, rows) of the batch
    <root>/batch=<b>/_visible/<v>                                 committed up to this version (pages committed one by one: empty ones only)
    <root>/_progress/                                             (run_id, page) progress rows

A write job appends any number of pages; each page becomes its own commit
version, so the commit identity travels with the rows and history is an
aggregation over the data.  A job writes below ``_staging``, which Spark's
and other Parquet readers skip as they skip every name with an underscore;
committing a version moves its directory into sight.  So any reader of the
root sees the committed versions and nothing else, after a crash too (readers
that open underscore names read ``batch=*/commit_version=*/*.parquet``).  (The
move is one rename on HDFS and local disks; an object store copies, and a
reader may meet a version while it is being copied.)  Between the write and the
commit the ingest may drop version directories (pages at or after the first
invalid page).  The next batch and version numbers are max + 1 over what is on
storage, chosen when the write starts.  One writer per table is assumed: this
is not a transaction log.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import BRONZE_ORDERS_RAW
from ..session import few_listing_tasks
from . import fs

VISIBLE = "_visible"
STAGING = "_staging"

PROGRESS_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("source_page", T.IntegerType(), False),
        T.StructField("complete", T.BooleanType(), False),
        T.StructField("commit_version", T.LongType(), True),
    ]
)


PAGE_LOG_SCHEMA = T.StructType(
    [
        T.StructField("commit_version", T.LongType(), False),
        T.StructField("source_page", T.IntegerType(), False),
        T.StructField("ingestion_run_id", T.StringType(), False),
        T.StructField("rows", T.LongType(), False),
    ]
)


VISIBLE_SCHEMA = T.StructType([T.StructField("batch", T.IntegerType(), False), T.StructField("last", T.LongType(), False)])


ARROW_TYPES = {T.StringType(): pa.string(), T.IntegerType(): pa.int32(), T.LongType(): pa.int64(), T.BooleanType(): pa.bool_()}


def arrow_table(rows: list[tuple], schema: T.StructType) -> pa.Table:
    fields = [pa.field(f.name, ARROW_TYPES[f.dataType], f.nullable) for f in schema.fields]
    return pa.Table.from_pylist([dict(zip(schema.names, r, strict=True)) for r in rows], schema=pa.schema(fields))


def local_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Some rows of the driver as a DataFrame that no Python worker has to read."""
    return spark.createDataFrame(arrow_table(rows, schema))


def write_rows(spark: SparkSession, folder: str, rows: list[tuple], schema: T.StructType) -> None:
    """Add some rows of the driver to a Parquet folder as one file, without a Spark job."""
    out = pa.BufferOutputStream()
    pq.write_table(arrow_table(rows, schema), out, compression="snappy")
    fs.write_bytes_atomic(spark, f"{folder}/part-{uuid.uuid4()}.snappy.parquet", out.getvalue().to_pybytes())


def _num(name: str, key: str) -> int | None:
    if name.startswith(key + "="):
        try:
            return int(name.split("=", 1)[1])
        except ValueError:
            return None
    return None


@dataclass
class BronzeTable:
    spark: SparkSession
    root: str

    # ----------------------------------------------------------- layout
    def _batches(self, below: str = "") -> list[int]:
        names = fs.list_dirs(self.spark, f"{self.root}{below}")
        return sorted(b for b in (_num(n, "batch") for n in names) if b is not None)

    def committed_batches(self) -> list[int]:
        return [b for b in self._batches() if self.last_visible(b) is not None]

    def batch_path(self, batch: int) -> str:
        return f"{self.root}/batch={batch}"

    def staged_path(self, batch: int) -> str:
        return f"{self.root}/{STAGING}/batch={batch}"

    def versions_in(self, batch: int, staged: bool = False) -> list[int]:
        names = fs.list_dirs(self.spark, self.staged_path(batch) if staged else self.batch_path(batch))
        return sorted(v for v in (_num(n, "commit_version") for n in names) if v is not None)

    def committed_versions(self) -> list[int]:
        """Every committed version (lists each committed batch; for audits)."""
        return sorted(v for b in self.committed_batches() for v in self.versions_in(b))

    def version(self) -> int | None:
        """Latest visible version, None when the table does not exist.

        Versions grow with batches: batches are looked at newest first, and
        the first one with a visible version ends the search."""
        for b in reversed(self._batches()):
            last = self.last_visible(b)
            if last is not None:
                return last
        return None

    def last_visible(self, batch: int) -> int | None:
        """Newest committed version of a batch.

        The version of an empty page has a marker ``_visible/<version>`` but
        no directory; a directory may lack its marker, as those of pages committed
        one by one do."""
        vs = [int(n) for n in fs.list_files(self.spark, f"{self.batch_path(batch)}/{VISIBLE}") if n.isdigit()]
        return max(vs + self.versions_in(batch), default=None)

    def next_batch(self) -> int:
        return max(self._batches() + self._batches(f"/{STAGING}"), default=-1) + 1

    # ------------------------------------------------------------- read
    def read(self) -> DataFrame:
        """Full snapshot, contract columns + ``batch`` and ``commit_version``."""
        newest = {b: vs[-1] for b in self._batches() if (vs := self.versions_in(b))}
        if not newest:
            schema = BRONZE_ORDERS_RAW.schema().add("batch", T.IntegerType()).add("commit_version", T.LongType())
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", self.root)
        with few_listing_tasks(self.spark):
            # one write made all files of a batch: the footers of one of its versions have the columns of all
            one_each = [f"{self.batch_path(b)}/commit_version={v}" for b, v in newest.items()]
            schema = reader.option("mergeSchema", "true").parquet(*one_each).schema
            return reader.schema(schema).parquet(*map(self.batch_path, newest))

    def read_since(self, version: int) -> DataFrame:
        """V7 for Bronze: rows committed after ``version`` (partition-pruned)."""
        return self.read().where(F.col("commit_version") > F.lit(version))

    # ------------------------------------------------------------ write
    def write_batch(self, rows: DataFrame) -> int:
        """S3, first half: write rows that already carry ``commit_version`` into
        a new batch below the staging folder; returns the batch number.

        No shuffle: landed files already hold whole pages, so each task
        writes one file per page it read."""
        batch = self.next_batch()
        rows.write.mode("error").partitionBy("commit_version").parquet(self.staged_path(batch))
        return batch

    def drop_versions(self, batch: int, versions: list[int]) -> None:
        """Remove version directories of an uncommitted batch."""
        for v in versions:
            fs.delete(self.spark, f"{self.staged_path(batch)}/commit_version={v}")

    def write_page_log(self, batch: int, rows: list[tuple[int, int, str, int]], staged: bool = False) -> None:
        """Record (commit_version, source_page, ingestion_run_id, rows) of a batch
        before it is committed: a tiny commit log read instead of the data.

        ``staged``: with the data, for a batch that will be committed whole."""
        folder = f"{self.staged_path(batch) if staged else self.batch_path(batch)}/_pages"
        fs.delete(self.spark, folder)
        write_rows(self.spark, folder, rows, PAGE_LOG_SCHEMA)

    def commit_log(self) -> DataFrame:
        """S8 without scanning data: one row per commit of committed batches
        written by the ingest (batches written by plain ``append`` have none)."""
        visible = {
            b: last
            for b in self._batches()
            if (last := self.last_visible(b)) is not None and fs.exists(self.spark, f"{self.batch_path(b)}/_pages")
        }
        if not visible:
            return self.spark.createDataFrame([], PAGE_LOG_SCHEMA)
        reader = self.spark.read.option("basePath", self.root).schema(T.StructType([*PAGE_LOG_SCHEMA, T.StructField("batch", T.IntegerType())]))
        with few_listing_tasks(self.spark):
            logs = reader.parquet(*[f"{self.batch_path(b)}/_pages" for b in visible])
        ends = local_table(self.spark, list(visible.items()), VISIBLE_SCHEMA)
        return logs.join(F.broadcast(ends), "batch").where("commit_version <= last").select(*PAGE_LOG_SCHEMA.names)

    def commit_batch(self, batch: int, last_version: int, staged: list[int] | None = None) -> None:
        """S3, second half: move the batch's versions up to this one into sight (no Spark job).

        Called again with a later version it goes on from there.  A batch that
        is committed whole, with nothing of it in sight yet, moves in one rename.
        ``staged`` saves the listing where the caller has just made it."""
        if staged is None:
            staged = self.versions_in(batch, staged=True)
        if staged and staged[-1] <= last_version and not fs.exists(self.spark, self.batch_path(batch)):
            fs.move(self.spark, self.staged_path(batch), self.batch_path(batch))
        else:
            for v in staged:
                if v <= last_version:
                    self._move_version(batch, v)
        self._mark_visible(batch, last_version)

    def commit_version(self, batch: int, version: int, staged: bool | None = None) -> None:
        """:meth:`commit_batch` for the version after the last committed one: it lists nothing.

        The version's directory in sight is its own marker; an empty page has none.
        ``staged`` tells whether there is one, where the caller knows."""
        if staged is None:
            staged = fs.exists(self.spark, f"{self.staged_path(batch)}/commit_version={version}")
        if staged:
            self._move_version(batch, version)
        else:
            self._mark_visible(batch, version)

    def _move_version(self, batch: int, version: int) -> None:
        name = f"commit_version={version}"
        fs.move(self.spark, f"{self.staged_path(batch)}/{name}", f"{self.batch_path(batch)}/{name}")

    def _mark_visible(self, batch: int, version: int) -> None:
        fs.write_text_atomic(self.spark, f"{self.batch_path(batch)}/{VISIBLE}/{int(version)}", "")

    def rows_per_version(self, batch: int) -> dict[int, int]:
        """Row count per commit version of one staged batch (Parquet footers; no column is read)."""
        with few_listing_tasks(self.spark):
            df = self.spark.read.schema("commit_version long").parquet(self.staged_path(batch))
        return {int(r.commit_version): int(r["count"]) for r in df.groupBy("commit_version").count().collect()}

    def append(self, rows: DataFrame) -> int:
        """S3: write and commit in one step; returns the batch number.

        Its versions must lie above the table's: a version once visible never changes."""
        current = self.version()
        batch = self.write_batch(rows)
        versions = self.versions_in(batch, staged=True)
        if versions and current is not None and versions[0] <= current:
            fs.delete(self.spark, self.staged_path(batch))
            raise ValueError(f"version {versions[0]} is not above the table's version {current}")
        if versions:
            self.commit_batch(batch, versions[-1], versions)
        return batch

    # --------------------------------------------------------- progress
    @property
    def progress_path(self) -> str:
        return f"{self.root}/_progress"

    def progress(self) -> DataFrame:
        """(run_id, source_page, complete, commit_version) rows."""
        if not fs.exists(self.spark, self.progress_path):
            return self.spark.createDataFrame([], PROGRESS_SCHEMA)
        return self.spark.read.schema(PROGRESS_SCHEMA).parquet(self.progress_path)

    def is_complete(self, run_id: str, page: int) -> bool:
        """S10 lookup: has ``page`` a complete progress row for ``run_id``."""
        hit = self.progress().where((F.col("run_id") == run_id) & (F.col("source_page") == page) & F.col("complete"))
        return bool(hit.limit(1).count())

    def version_for(self, run_id: str, page: int) -> int | None:
        """S10 lookup: the commit version recorded with the page's progress row."""
        r = (
            self.progress()
            .where((F.col("run_id") == run_id) & (F.col("source_page") == page))
            .agg(F.max("commit_version"))
            .first()
        )
        return None if r[0] is None else int(r[0])

    def mark_complete(self, rows: DataFrame) -> None:
        rows.select(*[F.col(f.name).cast(f.dataType) for f in PROGRESS_SCHEMA.fields]).coalesce(1).write.mode(
            "append"
        ).parquet(self.progress_path)

    def mark_pages(self, rows: list[tuple[str, int, bool, int | None]]) -> None:
        """:meth:`mark_complete` for rows of the driver, without a Spark job."""
        write_rows(self.spark, self.progress_path, rows, PROGRESS_SCHEMA)
