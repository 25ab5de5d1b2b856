"""Versioned tables whose rows are dealt to hash buckets of their key.

Layout: ``<root>/v=<n>/bucket=<b>/part-*.parquet``.  The pointer of a version
names, for every bucket, the version directory that holds its rows.  A version
that touches a few keys writes the buckets of these keys only; all other
buckets stay with the files of earlier versions, and every older version stays
readable.

Choose the number of buckets by the table's size (some 100 MB a bucket), so
that a delta of some thousand keys touches a small part of a large table.  The
pointer holds one number per bucket, and only bucket numbers ever reach the
driver.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ConstraintViolation
from . import fs
from .tables import VersionedTable

BUCKET = "bucket"
DEFAULT_BUCKETS = 64


@dataclass
class BucketedTable(VersionedTable):
    keys: tuple[str, ...] = ()
    buckets: int = DEFAULT_BUCKETS

    def bucket(self) -> Column:
        """Bucket of a row that has the key columns."""
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """Buckets that rows with the key columns belong to; at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias(BUCKET)).distinct().collect())

    def files(self, version: int | None = None) -> dict[int, int]:
        """bucket -> version directory that holds it, for the buckets that have rows."""
        v = self.version() if version is None else version
        return {} if v is None else {int(b): int(d) for b, d in self._pointer(v)["files"].items()}

    def read(self, version: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """All rows of a version, or those of the buckets ``only`` (no other file is opened)."""
        v = self.version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"{self.root}: nothing published")
        doc = self._pointer(v)
        schema = T.StructType.fromJson(doc["schema"])
        held = {int(b): d for b, d in doc["files"].items()}
        wanted = held if only is None else set(only)
        paths = [f"{self.root}/v={d}/{BUCKET}={b}" for b, d in held.items() if b in wanted]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def _write(self, df: DataFrame, version: int, mode: str) -> None:
        dealt = df.withColumn(BUCKET, self.bucket()).repartition(BUCKET)
        dealt.write.mode(mode).partitionBy(BUCKET).parquet(f"{self.root}/v={version}")
        self._schema = df.schema

    def _point(self, version, previous, rows, inputs, changes, carried: dict[int, int] | None = None, **more) -> None:
        written = [int(n.split("=", 1)[1]) for n in fs.list_dirs(self.spark, f"{self.root}/v={version}") if n.startswith(f"{BUCKET}=")]
        files = (carried or {}) | dict.fromkeys(written, version)
        super()._point(version, previous, rows, inputs, changes, files={str(b): d for b, d in sorted(files.items())}, schema=self._schema.jsonValue(), **more)

    def replace(self, rows: DataFrame, touched: Iterable[int], inputs: dict | None = None, changes: DataFrame | None = None, gate=None) -> int:
        """New version in which the buckets ``touched`` hold ``rows`` and all others what they held.

        ``rows`` must be all rows of these buckets; a row of another bucket
        stops the publish."""
        touched, previous = set(touched), self.version()
        version = self._next()
        obs = Observation(f"replace_{uuid.uuid4().hex}")
        inside = self.bucket().isin(sorted(touched)) if touched else F.lit(False)
        counted = rows.observe(obs, F.count(F.lit(1)).alias("rows"), F.count_if(~inside).alias("outside"))
        self._write(counted, version, "error")
        failed = {"rows of other buckets": int(obs.get["outside"])} | (gate() if gate is not None else {})
        failed = {k: int(n) for k, n in failed.items() if int(n) > 0}
        if failed:
            raise ConstraintViolation(f"{self.root} v={version} not published; violations: {failed}")
        if changes is not None:
            changes.write.mode("overwrite").parquet(self.changes_path(version))
        carried = {b: d for b, d in self.files(previous).items() if b not in touched}
        self._point(version, previous, int(obs.get["rows"]), inputs, changes is not None, carried=carried)
        return version
