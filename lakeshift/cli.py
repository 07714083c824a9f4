"""Command line for the migration jobs: ``python -m lakeshift.cli <command> ...``.

Each command maps to one job in ``lakeshift.plans.jobs`` (or the publication
sinks) and prints the job's report as JSON lines. Sources for extraction are
either Parquet tables (``--source-dir DIR`` with ``DIR/<table>``) or a JDBC
database (``--jdbc-url``); paths may be any Hadoop file system URI.
"""

from __future__ import annotations

import argparse
import sys
from datetime import datetime

from lakeshift.plans import jobs

TABLES = ["merchants", "customers", "payments", "settlements"]


def _spark(args):
    from lakeshift.session import build_session

    return build_session(args.master, app=f"lakeshift-{args.command}")


def _sources(spark, args, tables):
    if args.jdbc_url:
        from lakeshift.schema import ENTITIES
        from lakeshift.sources.jdbc import read_table

        props = {"user": args.jdbc_user or "", "password": args.jdbc_password or ""}
        return {
            t: read_table(spark, args.jdbc_url, t, ENTITIES[t]["extract_key"], args.partitions, props, dense_key=ENTITIES[t]["extract_key"] == "source_record_id")
            for t in tables
        }
    return {t: spark.read.parquet(f"{args.source_dir.rstrip('/')}/{t}") for t in tables}


def _print(df) -> None:
    """Print a job report (a small aggregate by construction)."""
    for row in df.toJSON().collect():
        print(row)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lakeshift")
    p.add_argument("--master", default=None, help="Spark master (default: from spark-submit)")
    sub = p.add_subparsers(dest="command", required=True)

    def source_args(sp):
        sp.add_argument("--source-dir")
        sp.add_argument("--jdbc-url")
        sp.add_argument("--jdbc-user")
        sp.add_argument("--jdbc-password")
        sp.add_argument("--partitions", type=int, default=64)
        sp.add_argument("--tables", nargs="+", choices=TABLES, default=TABLES)

    sp = sub.add_parser("extract-full")
    source_args(sp)
    sp.add_argument("--bronze-dir", required=True)
    sp.add_argument("--run-id", required=True)
    sp.add_argument("--batch-size", type=int, default=50_000)

    sp = sub.add_parser("extract-incremental")
    source_args(sp)
    sp.add_argument("--bronze-dir", required=True)
    sp.add_argument("--state-dir", required=True)
    sp.add_argument("--run-id")
    sp.add_argument("--initialize", action="store_true")
    sp.add_argument("--cutoff", help="ISO timestamp; default now (UTC)")
    sp.add_argument("--batch-size", type=int, default=50_000)

    sp = sub.add_parser("bronze-to-silver")
    sp.add_argument("--bronze-run", required=True, help="path of the Bronze run_id=... directory")
    sp.add_argument("--silver-dir", required=True)
    sp.add_argument("--quarantine-dir", required=True)
    sp.add_argument("--run-id", required=True)

    sp = sub.add_parser("merge")
    sp.add_argument("--base-silver-run", required=True)
    sp.add_argument("--incremental-bronze-run", required=True)
    sp.add_argument("--silver-dir", required=True)
    sp.add_argument("--quarantine-dir", required=True)
    sp.add_argument("--run-id", required=True)

    sp = sub.add_parser("silver-to-gold")
    sp.add_argument("--silver-run", required=True)
    sp.add_argument("--gold-dir", required=True)
    sp.add_argument("--run-id", required=True)

    sp = sub.add_parser("scd2")
    sp.add_argument("--base-history", required=True, help="path of a merchant_scd2 dataset")
    sp.add_argument("--incremental-bronze-run", required=True)
    sp.add_argument("--gold-dir", required=True)
    sp.add_argument("--run-id", required=True)
    sp.add_argument("--insert-new", action="store_true")

    sp = sub.add_parser("validate")
    sp.add_argument("--silver-run", required=True)
    sp.add_argument("--gold-run", required=True)
    sp.add_argument("--output-dir", required=True)
    sp.add_argument("--run-id", required=True)

    sp = sub.add_parser("reconcile")
    source_args(sp)
    sp.add_argument("--silver-run", required=True)
    sp.add_argument("--gold-run", required=True)
    sp.add_argument("--output", required=True)

    sp = sub.add_parser("metrics")
    sp.add_argument("--quality-report", required=True)
    sp.add_argument("--reconciliation-report")
    sp.add_argument("--pipeline-status", choices=["success", "failure"], default="success")
    sp.add_argument("--output", required=True)

    sp = sub.add_parser("publish")
    sp.add_argument("--silver-run", required=True)
    sp.add_argument("--gold-run", required=True)
    sp.add_argument("--scd2-run", required=True)
    sp.add_argument("--output", required=True, help="publication root, e.g. .../publication_id=v1")

    sp = sub.add_parser("plan-upload")
    sp.add_argument("--source", required=True)
    sp.add_argument("--source-root", required=True)
    sp.add_argument("--prefix", required=True)
    sp.add_argument("--output", required=True, help="where the full path -> key plan is written (JSON)")

    args = p.parse_args(argv)
    spark = _spark(args)
    c = args.command
    if c == "extract-full":
        out = jobs.extract_full(spark, _sources(spark, args, args.tables), args.bronze_dir, args.run_id, args.batch_size)
    elif c == "extract-incremental":
        sources = _sources(spark, args, args.tables)
        if args.initialize:
            out = jobs.initialize_state(spark, sources, args.state_dir)
        else:
            run_id = args.run_id or f"incremental-{jobs._utc_now():%Y%m%dT%H%M%SZ}"
            cutoff = datetime.fromisoformat(args.cutoff) if args.cutoff else None
            out = jobs.extract_incremental(spark, sources, args.bronze_dir, run_id, args.state_dir, cutoff, args.batch_size)
    elif c == "bronze-to-silver":
        out = jobs.bronze_to_silver_job(spark, args.bronze_run, args.silver_dir, args.quarantine_dir, args.run_id)
    elif c == "merge":
        out = jobs.merge_job(spark, args.base_silver_run, args.incremental_bronze_run, args.silver_dir, args.quarantine_dir, args.run_id)
    elif c == "silver-to-gold":
        out = jobs.silver_to_gold_job(spark, args.silver_run, args.gold_dir, args.run_id)
    elif c == "scd2":
        out = jobs.scd2_job(spark, args.base_history, args.incremental_bronze_run, args.gold_dir, args.run_id, args.insert_new)
    elif c == "validate":
        out = jobs.validate_job(spark, args.silver_run, args.gold_run, args.output_dir, args.run_id)
    elif c == "reconcile":
        src = _sources(spark, args, ["payments", "merchants"])
        out = jobs.reconcile_job(spark, src["payments"], src["merchants"], args.silver_run, args.gold_run, args.output)
    elif c == "metrics":
        if args.pipeline_status == "failure":
            from lakeshift.plans.audit import failure_metrics
            from lakeshift.sinks.files import write_report

            write_report(failure_metrics(spark), args.output)
            out = spark.read.json(args.output)
        else:
            out = jobs.metrics_job(spark, args.quality_report, args.reconciliation_report, args.output)
    elif c == "publish":
        from lakeshift.sinks.publish import publication_bundle, publish

        out = publish(spark, publication_bundle(args.silver_run, args.gold_run, args.scd2_run), args.output)
    else:  # plan-upload: the full plan is a dataset; print its totals
        from pyspark.sql import functions as F

        from lakeshift.sinks.publish import plan_publication

        plan = plan_publication(spark, args.source, args.source_root, args.prefix)
        plan.write.mode("errorifexists").json(args.output)
        out = spark.read.json(args.output).agg(F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"))
    _print(out)
    return 0


if __name__ == "__main__":
    try:
        sys.exit(main())
    except jobs.CheckFailed as e:
        sys.exit(str(e))
