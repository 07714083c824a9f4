"""Benchmark: run every registered query at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``.

What several queries share (Silver, Gold, the merges, the ledger) is built and
written in rows of its own, ``stage_*``, so that no query pays for it and none is
timed without it. Each query is then executed in full through the ``noop`` sink
(no driver collect). Prints ONE JSON line; ``value`` is the total of all rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, HERE)

HEADLINE = [
    "merchant_daily_metrics",
    "payment_reconciliation",
    "payments_merged",
    "settlements_merged",
    "scd2_merge",
    "expectation_suite",
    "migration_reconciliation",
    "quality_report",
]


def run_jobs(spark, sf_dir: str) -> dict[str, float]:
    """Opt-in (BENCH_JOBS=1): the write path end to end in a fresh temp folder."""
    import tempfile

    from lakeshift.plans import jobs
    from lakeshift.sinks.files import write_bronze
    from lakeshift.sinks.publish import publication_bundle, publish
    from lakeshift.testing.fixtures import Fixtures

    fx = Fixtures.of(spark, sf_dir)
    root = tempfile.mkdtemp(prefix="lakeshift-bench-jobs-")
    sources = {"merchants": fx.merchants_raw, "customers": fx.customers_raw, "payments": fx.payments_raw, "settlements": fx.settlements_raw}
    out = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        fn()
        out[name] = round(time.perf_counter() - t0, 3)

    timed("full_migration", lambda: jobs.full_migration(spark, sources, root, "r1"))
    for name in ("merchants", "payments", "settlements"):
        write_bronze(getattr(fx, f"{name}_inc"), f"{root}/bronze/run_id=i1/{name}")
    timed("merge_job", lambda: jobs.merge_job(spark, f"{root}/silver/run_id=r1", f"{root}/bronze/run_id=i1", f"{root}/silver", f"{root}/quarantine", "m1"))
    timed("scd2_job", lambda: jobs.scd2_job(spark, f"{root}/gold/run_id=r1/merchant_scd2", f"{root}/bronze/run_id=i1", f"{root}/gold", "h1"))
    timed("publish", lambda: publish(spark, publication_bundle(f"{root}/silver/run_id=m1", f"{root}/gold/run_id=r1", f"{root}/gold/run_id=h1"), f"{root}/published/publication_id=p1"))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = os.environ.get("BENCH_QUERIES")

    from lakeshift.queries import QUERIES, Context
    from lakeshift.session import build_session

    spark = build_session(
        f"local[{cpus}]",
        app="lakeshift-bench",
        shuffle_partitions=max(4, cpus),
        spark__driver__memory="16g",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="64m",
        spark__sql__files__maxPartitionBytes="128m",
    )
    names = only.split(",") if only else list(QUERIES)

    def run(name: str) -> float:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t0

    run("latest_watermark")  # warm-up: JVM, codegen caches, file listing
    times, shared = {}, Context(spark, sf_dir)
    for name in Context.SHARED:
        t0 = time.perf_counter()
        getattr(shared, name)
        times[f"stage_{name}"] = round(time.perf_counter() - t0, 3)
    times |= {n: round(run(n), 3) for n in names}
    shared.release()
    jobs = run_jobs(spark, sf_dir) if os.environ.get("BENCH_JOBS") == "1" else {}
    headline = {n: times[n] for n in HEADLINE if n in times}
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "headline_seconds": round(sum(headline.values()), 3),
                "staging_seconds": round(sum(t for n, t in times.items() if n.startswith("stage_")), 3),
                "n_queries": len(names),
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
                "cpus": cpus,
                **({"jobs": jobs} if jobs else {}),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
