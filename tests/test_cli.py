"""The command line: a run, a rerun that skips, the Silver step, exit codes."""

import pytest

from lakestrata.cli import exit_code_for, main
from lakestrata.sources.bronze import BronzeTable
from lakestrata.sources.landing import write_pages
from lakestrata.sources.tables import VersionedTable
from tools.source_fixture import source_records


def test_cli_run_rerun_and_silver(spark, workdir, run_id):
    table, silver, landing = f"{workdir}/bronze", f"{workdir}/silver", f"{workdir}/landing"
    write_pages(source_records(spark, pages=3, page_size=4), landing)
    argv = [
        "--run-id", run_id, "--window-start", "2026-09-01T00:00:00Z", "--window-end", "2026-09-02T00:00:00Z",
        "--table-uri", table, "--landing-uri", landing, "--prepare-silver", silver,
    ]
    assert main(argv, spark=spark) == 0
    assert main(argv, spark=spark) == 0  # the same pages: all skipped for this run
    m = spark.read.parquet(f"{table}/_manifests").orderBy("finished_at").collect()
    assert [len(r.pages_appended) for r in m] == [3, 0] and [r.pages_skipped for r in m] == [[], [1, 2, 3]]
    assert m[0].window.start == "2026-09-01T00:00:00Z"
    assert BronzeTable(spark, table).read().count() == 12
    assert VersionedTable(spark, silver).read().count() == 12


def test_landing_folder_is_required():
    with pytest.raises(SystemExit):
        main(["--run-id", "r", "--window-start", "a", "--window-end", "b", "--table-uri", "t"], spark=object())


def test_exit_code_mapping():
    assert [exit_code_for(s) for s in ["ok", "validation_error: x", "schema_contract_violation: y",
                                       "checkpoint_write_interrupted: z", "error: w"]] == [0, 2, 3, 4, 1]
