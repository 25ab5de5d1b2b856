"""I4: a page table in which a page delivered again by its run replaces itself.

Layout: ``<root>/ingestion_run_id=<run>/source_page=<p>/part-*.parquet``.  A
write is a dynamic partition overwrite: the job's committer swaps exactly the
(run, page) directories that it wrote, so a retried page leaves its rows once
and other pages and runs are not touched.  Replays are not visible here; for
that the Bronze table (:mod:`.bronze`) stays the default.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..contracts import BRONZE_ORDERS_RAW
from . import fs

PAGE_KEYS = ("ingestion_run_id", "source_page")


@dataclass
class PageTable:
    spark: SparkSession
    root: str

    def read(self) -> DataFrame:
        """Rows of every page, in the envelope's columns."""
        if not any(n.startswith(PAGE_KEYS[0]) for n in fs.list_dirs(self.spark, self.root)):
            return self.spark.createDataFrame([], BRONZE_ORDERS_RAW.schema())
        return self.spark.read.schema(BRONZE_ORDERS_RAW.schema()).parquet(self.root).select(*BRONZE_ORDERS_RAW.names)

    def replace_pages(self, rows: DataFrame) -> None:
        """Write whole pages; each takes the place of its earlier delivery by the same run.

        Rows must hold pages whole.  Landed files do, so there is no shuffle;
        a page that several tasks read is written by each of them into the
        same new directory."""
        rows.select(*BRONZE_ORDERS_RAW.names).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
            *PAGE_KEYS
        ).parquet(self.root)
