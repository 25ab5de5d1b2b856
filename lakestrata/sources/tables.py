"""Versioned derived tables (Silver, Gold) with check-then-publish.

Layout::

    <root>/v=<n>/part-*.parquet     one directory per refresh
    <root>/_changes/v=<n>/          change feed of a version, if it was given one:
                                    the rows it added (change_weight 1) and
                                    removed (-1) against the version before
    <root>/_published/v=<n>.json    one pointer per published version (version,
                                    published_at, rows, inputs, previous, changes),
                                    written atomically; the current version is
                                    found by listing this folder (no Spark job)

A refresh writes a new version directory while the current one stays
readable (Spark cannot overwrite a path it is reading), counts CHECK
violations with an ``Observation`` during that same write, and appends the
pointer row only when every check passed.  A failed refresh therefore
leaves the previous version as the published one.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contracts import ConstraintViolation
from . import fs

POINTER_SCHEMA = T.StructType(
    [
        T.StructField("version", T.LongType(), False),
        T.StructField("published_at", T.TimestampType(), False),
        T.StructField("rows", T.LongType(), False),
        T.StructField("inputs", T.MapType(T.StringType(), T.LongType()), True),
    ]
)


WEIGHT = "change_weight"


class NoChangeFeed(LookupError):
    """A version between the two asked for was published without its changes."""


def snapshot_changes(old: DataFrame | None, new: DataFrame) -> DataFrame:
    """Rows of ``new`` (change_weight > 0) and ``old`` (< 0) that the other has not as often.

    One aggregation over whole rows; a row in both, however often repeated,
    collapses before the shuffle."""
    signed = new.withColumn(WEIGHT, F.lit(1).cast("long"))
    if old is not None:
        signed = signed.unionByName(old.select(*new.columns).withColumn(WEIGHT, F.lit(-1).cast("long")))
    return net_changes(signed)


def net_changes(signed: DataFrame) -> DataFrame:
    """One row per distinct changed row with its summed, non-zero change_weight."""
    names = [c for c in signed.columns if c != WEIGHT]
    return signed.groupBy(*names).agg(F.sum(WEIGHT).alias(WEIGHT)).where(F.col(WEIGHT) != 0)


@dataclass
class VersionedTable:
    spark: SparkSession
    root: str

    @property
    def pointer_path(self) -> str:
        return f"{self.root}/_published"

    def pointers(self) -> DataFrame:
        """Every published version as a DataFrame (for audits)."""
        if not fs.list_files(self.spark, self.pointer_path):
            return self.spark.createDataFrame([], POINTER_SCHEMA)
        return self.spark.read.schema(POINTER_SCHEMA).json(f"{self.pointer_path}/v=*.json")

    def _published_versions(self) -> list[int]:
        names = fs.list_files(self.spark, self.pointer_path)
        return sorted(int(n[2:-5]) for n in names if n.startswith("v=") and n.endswith(".json"))

    def current(self) -> tuple[int, dict] | None:
        """Latest published (version, inputs): one listing and one small read."""
        vs = self._published_versions()
        if not vs:
            return None
        doc = self._pointer(vs[-1])
        return int(doc["version"]), doc.get("inputs") or {}

    def _pointer(self, version: int) -> dict:
        return json.loads(fs.read_text(self.spark, f"{self.pointer_path}/v={version}.json"))

    def version(self) -> int | None:
        cur = self.current()
        return None if cur is None else cur[0]

    def read(self, version: int | None = None) -> DataFrame:
        v = self.version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"{self.root}: nothing published")
        return self.spark.read.parquet(f"{self.root}/v={v}")

    def changes(self, after: int | None, upto: int) -> DataFrame:
        """V7: net changes from version ``after`` to ``upto``, read from the feeds alone.

        ``after`` None means from nothing.  Pointers are followed back from
        ``upto``; NoChangeFeed is raised where one has no feed."""
        paths, v = [], upto
        while v is not None and v != after:
            doc = self._pointer(v)
            if not doc.get("changes"):
                raise NoChangeFeed(f"{self.root}: version {v} has no change feed")
            paths.append(self.changes_path(v))
            v = doc.get("previous")
        if v != after:
            raise NoChangeFeed(f"{self.root}: version {after} is not behind {upto}")
        if not paths:
            return net_changes(self.read(upto).where("false").withColumn(WEIGHT, F.lit(1).cast("long")))
        return net_changes(self.spark.read.parquet(*paths))

    def changes_path(self, version: int) -> str:
        return f"{self.root}/_changes/v={version}"

    def _next(self) -> int:
        vs = [int(n.split("=", 1)[1]) for n in fs.list_dirs(self.spark, self.root) if n.startswith("v=")]
        return (max(vs) + 1) if vs else 0

    def publish(
        self,
        df: DataFrame,
        checks: dict[str, Column] | None = None,
        inputs: dict | None = None,
        mode: str = "error",
        gate=None,
        changes: DataFrame | bool | None = None,
    ) -> int:
        """Write a new version, check during the write, publish if clean.

        ``changes`` is its change feed (rows with change_weight); True finds
        it by comparing the snapshots.  ``gate`` is an optional callable run after the write and before the
        publish; it returns ``{name: count}`` of failures gathered elsewhere
        (e.g. an Observation on an upstream DataFrame)."""
        checks = checks or {}
        obs = Observation(f"checks_{uuid.uuid4().hex}")
        metrics = [F.count(F.lit(1)).alias("_rows")] + [
            F.count_if(~F.coalesce(cond, F.lit(True))).alias(name) for name, cond in checks.items()
        ]
        version = self._next()
        previous = self.version()
        self._write(df.observe(obs, *metrics), version, mode)
        got = obs.get
        failed = {k: int(got[k]) for k in checks if int(got[k]) > 0}
        if gate is not None:
            failed.update({k: int(v) for k, v in gate().items() if int(v) > 0})
        if failed:
            raise ConstraintViolation(f"{self.root} v={version} not published; violations: {failed}")
        if changes is True:
            written = self.spark.read.schema(df.schema).parquet(f"{self.root}/v={version}")
            changes = snapshot_changes(None if previous is None else self.read(previous), written.select(*df.columns))
        if changes is not None:
            changes.write.mode("overwrite").parquet(self.changes_path(version))
        self._point(version, previous, int(got["_rows"]), inputs, changes is not None)
        return version

    def _write(self, df: DataFrame, version: int, mode: str) -> None:
        df.write.mode(mode).parquet(f"{self.root}/v={version}")

    def _point(self, version: int, previous: int | None, rows: int, inputs: dict | None, changes: bool, **more) -> None:
        doc = {
            "version": version,
            "published_at": datetime.now(timezone.utc).isoformat(),
            "rows": rows,
            "inputs": inputs or {},
            "previous": previous,
            "changes": changes,
            **more,
        }
        fs.write_text_atomic(self.spark, f"{self.pointer_path}/v={version}.json", json.dumps(doc, sort_keys=True))
