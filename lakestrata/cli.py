"""Shell entry to one ingest run over a landing folder.

The pages of ``--landing-uri`` that the run has not finished are appended to
the Bronze table at ``--table-uri``, and ``--prepare-silver`` rebuilds a
Silver table from it afterwards.  The outcome is a row in the manifest
(``_manifests`` below the table unless ``--manifest-uri`` says otherwise) and
the code of :func:`lakestrata.plans.runs.exit_code_for`.
"""

from __future__ import annotations

import argparse
import sys

from .plans.runs import exit_code_for, run_ingest
from .session import get_spark
from .sources.bronze import BronzeTable
from .sources.tables import VersionedTable

# Flags of a run, with the default of those that may be left out
REQUIRED = ("--run-id", "--window-start", "--window-end", "--table-uri", "--landing-uri")
OPTIONAL = {"--manifest-uri": None, "--prepare-silver": None, "--git-commit": "unknown", "--image-digest": "unknown"}


def parse_args(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="lakestrata")
    for flag in REQUIRED:
        p.add_argument(flag, required=True)
    for flag, default in OPTIONAL.items():
        p.add_argument(flag, default=default)
    p.add_argument("--dataset", choices=["orders", "customers"], default="orders")
    p.add_argument("--max-pages-per-batch", type=int, default=10_000)
    return p.parse_args(argv)


def main(argv: list[str] | None = None, spark=None) -> int:
    args = parse_args(argv)
    spark = spark or get_spark()
    table = BronzeTable(spark, args.table_uri)

    def prepare(t: BronzeTable) -> None:
        from .plans.silver import prepare_customers, prepare_orders

        job = prepare_orders if args.dataset == "orders" else prepare_customers
        job(spark, t.read(), VersionedTable(spark, args.prepare_silver))

    manifest = run_ingest(
        spark,
        args.landing_uri,
        table,
        args.run_id,
        args.manifest_uri or f"{args.table_uri}/_manifests",
        window=(args.window_start, args.window_end),
        git_commit=args.git_commit,
        image_digest=args.image_digest,
        prepare_silver=prepare if args.prepare_silver else None,
        max_pages_per_batch=args.max_pages_per_batch,
    )
    return exit_code_for(manifest["status"])


if __name__ == "__main__":
    sys.exit(main())
