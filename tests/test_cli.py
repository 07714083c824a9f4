"""The command line drives the same jobs (in-process, test session reused)."""

import json
import tempfile

import pytest
from conftest import by_month

from lakeshift import cli
from lakeshift.sinks.files import write_bronze


@pytest.fixture(scope="module")
def landed(spark, fx):
    """Source tables as Parquet, then extract -> Silver -> Gold through the CLI."""
    root = tempfile.mkdtemp(prefix="lakeshift-cli-")
    for name in ("merchants", "customers", "payments", "settlements"):
        df = getattr(fx, f"{name}_raw")
        (by_month(df) if name in ("payments", "settlements") else df).write.parquet(f"{root}/src/{name}")
    assert cli.main(["extract-full", "--source-dir", f"{root}/src", "--bronze-dir", f"{root}/bronze", "--run-id", "c1", "--batch-size", "400"]) == 0
    assert cli.main(["bronze-to-silver", "--bronze-run", f"{root}/bronze/run_id=c1", "--silver-dir", f"{root}/silver", "--quarantine-dir", f"{root}/q", "--run-id", "c1"]) == 0
    assert cli.main(["silver-to-gold", "--silver-run", f"{root}/silver/run_id=c1", "--gold-dir", f"{root}/gold", "--run-id", "c1"]) == 0
    return root


def _lines(capsys):
    return [json.loads(line) for line in capsys.readouterr().out.strip().splitlines()]


def test_cli_reconcile_and_metrics(landed, capsys):
    root = landed
    capsys.readouterr()
    assert cli.main(["reconcile", "--source-dir", f"{root}/src", "--silver-run", f"{root}/silver/run_id=c1", "--gold-run", f"{root}/gold/run_id=c1", "--output", f"{root}/audit"]) == 0
    report = _lines(capsys)[-1]
    assert report["status"] == "PASSED" and report["target_valid_payment_count"] == 1471
    assert cli.main(["metrics", "--quality-report", f"{root}/silver/run_id=c1/_quality_report", "--reconciliation-report", f"{root}/audit", "--output", f"{root}/metrics"]) == 0
    metrics = {m["metric_name"]: m["value"] for m in _lines(capsys)}
    assert metrics["PipelineSuccess"] == 1 and metrics["ValidPayments"] == 1471
    assert cli.main(["metrics", "--quality-report", "unused", "--pipeline-status", "failure", "--output", f"{root}/fail"]) == 0
    assert _lines(capsys)[-1]["value"] == 0


def test_cli_merge_scd2_validate_publish_upload_plan(landed, spark, fx, capsys):
    root = landed
    for name in ("merchants", "payments", "settlements"):
        df = getattr(fx, f"{name}_inc")
        write_bronze(df if name == "merchants" else by_month(df), f"{root}/bronze/run_id=i1/{name}")
    capsys.readouterr()
    assert cli.main(["merge", "--base-silver-run", f"{root}/silver/run_id=c1", "--incremental-bronze-run", f"{root}/bronze/run_id=i1", "--silver-dir", f"{root}/silver", "--quarantine-dir", f"{root}/q", "--run-id", "m1"]) == 0
    merged = {(r["section"], r["name"]): r["value"] for r in _lines(capsys)}
    assert merged[("merged_rows", "payments")] == 1478
    assert cli.main(["scd2", "--base-history", f"{root}/gold/run_id=c1/merchant_scd2", "--incremental-bronze-run", f"{root}/bronze/run_id=i1", "--gold-dir", f"{root}/gold", "--run-id", "h1", "--insert-new"]) == 0
    scd2 = _lines(capsys)[-1]
    assert (scd2["changed_merchants"], scd2["total_scd2_rows"]) == (2, 13)
    assert cli.main(["validate", "--silver-run", f"{root}/silver/run_id=c1", "--gold-run", f"{root}/gold/run_id=c1", "--output-dir", f"{root}/quality", "--run-id", "v1"]) == 0
    capsys.readouterr()
    assert cli.main(["publish", "--silver-run", f"{root}/silver/run_id=m1", "--gold-run", f"{root}/gold/run_id=c1", "--scd2-run", f"{root}/gold/run_id=h1", "--output", f"{root}/published/publication_id=p1"]) == 0
    assert len(_lines(capsys)) == 9
    assert cli.main(["plan-upload", "--source", f"{root}/published/publication_id=p1", "--source-root", f"{root}/published", "--prefix", "proj", "--output", f"{root}/plan"]) == 0
    assert _lines(capsys)[-1]["files"] > 9
    keys = [r["object_key"] for r in spark.read.json(f"{root}/plan").collect()]
    assert all(k.startswith("proj/published/publication_id=p1/") for k in keys)
