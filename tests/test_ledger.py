"""The accounting ledger against a brute-force model of the source, and its plan."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.operators.ledger import open_ledger, post_increment
from lakeshift.operators.upsert import upsert_latest_parts
from lakeshift.plans import jobs
from lakeshift.plans.merge import validate_payment_changes
from lakeshift.plans.silver import classify_payments
from lakeshift.sinks.files import write_bronze

T0 = datetime(2024, 1, 1)
MERCHANT = [("m1", "n", "RETAIL", "c", "s", "LOW", T0, T0, "b")]


def payment(source, pay, amount=10, day=0, merchant="m1"):
    when = T0 + timedelta(days=day)
    return (source, pay, "c1", merchant, Decimal(amount), "INR", "CAPTURED", when, when, when, "b")


def frames(spark, rows, inc):
    merchants = spark.createDataFrame(MERCHANT, S.MERCHANTS)
    flagged = classify_payments(spark.createDataFrame(rows, S.PAYMENTS), merchants)
    base = flagged.filter("rejection_reason is null").select(*S.columns(S.PAYMENTS))
    changes = validate_payment_changes(spark.createDataFrame(inc, S.PAYMENTS), merchants)
    current = changes.filter("rejection_reason is null").select(*S.columns(S.PAYMENTS))
    untouched, winners = upsert_latest_parts(base, current, "payment_id")
    ledger = post_increment(open_ledger(flagged), base, changes, winners)
    return base, changes, untouched.unionByName(winners), ledger


def counts(df):
    return Counter({(r[0], r[1]): r[2] for r in df.groupBy("source_record_id", "rejection_reason").agg(F.sum("rows")).collect()})


CASES = {
    "a repeated source id, and a new row": ([payment(1, "p1"), payment(1, "p1"), payment(2, "p2")], [payment(3, "p3", day=1)], {(1, S.DUPLICATE_PAYMENT_ID): 1}, 4),
    "a repeated source id that changes": ([payment(1, "p1"), payment(1, "p1"), payment(2, "p2")], [payment(1, "p1", 12, 1)], {(1, S.DUPLICATE_PAYMENT_ID): 1}, 3),
    "a change in place that is rejected": ([payment(1, "p1")], [payment(1, "p1", 0, 1)], {}, 1),
    "a change in place that loses its id": ([payment(1, "p1")], [payment(1, None, 10, 1)], {}, 1),
    "a rejected row that is mended": ([payment(1, "p1", 0)], [payment(1, "p1", 5, 1)], {}, 1),
    "a rejected row with another reason": ([payment(1, "p1", 0)], [payment(1, None, 5, 1)], {(1, S.MISSING_PAYMENT_ID): 1}, 1),
    "a newer row of another source id": ([payment(1, "p1")], [payment(2, "p1", 5, 1)], {(1, S.DUPLICATE_PAYMENT_ID): 1}, 2),
    "a stale row": ([payment(1, "p1", day=9)], [payment(2, "p1", 5, 1)], {(2, S.DUPLICATE_PAYMENT_ID): 1}, 2),
    "losers within the increment": ([payment(1, "p1")], [payment(2, "p1", 5, 1), payment(3, "p1", 6, 2), payment(3, "p1", 6, 2)], {(1, S.DUPLICATE_PAYMENT_ID): 1, (2, S.DUPLICATE_PAYMENT_ID): 1, (3, S.DUPLICATE_PAYMENT_ID): 1}, 4),
    "rows without a source id": ([payment(None, "p1"), payment(None, None)], [payment(None, "p2"), payment(None, "p1", 3, 1), payment(None, "p9", -1)], {(None, S.DUPLICATE_PAYMENT_ID): 1, (None, S.MISSING_PAYMENT_ID): 1, (None, S.INVALID_PAYMENT_AMOUNT): 1}, 5),
    "one source id under two payment ids": ([payment(1, "p1"), payment(1, "p2")], [payment(2, "p1", 5, 1)], {(1, S.DUPLICATE_PAYMENT_ID): 1}, 3),
    "no rows": ([], [], {}, 0),
}


@pytest.mark.parametrize("name", CASES)
def test_cases(spark, name):
    rows, inc, want, total = CASES[name]
    _, _, merged, ledger = frames(spark, rows, inc)
    assert counts(ledger) == Counter(want)
    assert merged.count() + sum(want.values()) == total


def test_random_sources_stay_accounted_for(spark):
    rng = random.Random(4)
    for _ in range(4):
        rows = [payment(rng.randrange(60), rng.choice([f"p{rng.randrange(40)}", None]), rng.choice([1, 0]), rng.randrange(9), rng.choice(["m1", "m1", "mx"])) for _ in range(60)]
        inc = [payment(rng.randrange(100, 160), rng.choice([f"p{rng.randrange(60)}", None]), rng.choice([1, 0]), rng.randrange(20)) for _ in range(40)]
        _, _, merged, ledger = frames(spark, rows, inc)
        got = counts(ledger)
        held = Counter(r[0] for r in merged.select("source_record_id").collect())
        source = Counter(r[0] for r in rows + inc)
        assert all(held[i] + sum(n for (k, _), n in got.items() if k == i) == source[i] for i in source)  # of each id, as many as the source has


def test_base_is_read_beside_small_keys_and_never_shuffled(spark, tmp_dir):
    rows = [payment(k, f"p{k}") for k in range(500)]
    merchants = spark.createDataFrame(MERCHANT, S.MERCHANTS)
    spark.createDataFrame(rows, S.PAYMENTS).write.parquet(f"{tmp_dir}/base")
    validate_payment_changes(spark.createDataFrame([payment(900, "p7", 5, 1)], S.PAYMENTS), merchants).write.parquet(f"{tmp_dir}/inc")
    base, changes = spark.read.parquet(f"{tmp_dir}/base"), spark.read.parquet(f"{tmp_dir}/inc")
    from lakeshift.operators.ledger import touched_rows

    touched = touched_rows(base, changes.filter("rejection_reason is null"), changes)
    assert [tuple(r) for r in touched.collect()] == [(7, True)]
    plan = touched._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("BroadcastHashJoin") >= 2
    scan = next(line for line in plan.splitlines() if "Scan parquet" in line and f"{tmp_dir}/base" in line)
    assert "ReadSchema: struct<source_record_id:bigint,payment_id:string>" in scan


def test_merge_job_with_a_repeated_source_id_reconciles(spark, tmp_dir):
    """Three rows, two of them alike; then an increment of one row, then one in place."""
    none = spark.createDataFrame([], S.CUSTOMERS), spark.createDataFrame([], S.SETTLEMENTS)
    merchants = spark.createDataFrame(MERCHANT, S.MERCHANTS)
    first = [payment(1, "p1"), payment(1, "p1"), payment(2, "p2")]
    sources = {"merchants": merchants, "customers": none[0], "payments": spark.createDataFrame(first, S.PAYMENTS), "settlements": none[1]}
    assert jobs.full_migration(spark, sources, tmp_dir, "r0")["reconciliation"].first()["status"] == "PASSED"
    steps = [([payment(3, "p3", day=1)], first + [payment(3, "p3", day=1)]), ([payment(2, "p2", 77, 2)], first[:2] + [payment(2, "p2", 77, 2), payment(3, "p3", day=1)])]
    for k, (inc, source) in enumerate(steps, 1):
        write_bronze(spark.createDataFrame(inc, S.PAYMENTS), f"{tmp_dir}/bronze/run_id=i{k}/payments")
        jobs.merge_job(spark, f"{tmp_dir}/silver/run_id=r{k - 1}", f"{tmp_dir}/bronze/run_id=i{k}", f"{tmp_dir}/silver", f"{tmp_dir}/quarantine", f"r{k}")
        jobs.silver_to_gold_job(spark, f"{tmp_dir}/silver/run_id=r{k}", f"{tmp_dir}/gold", f"g{k}")
        row = jobs.reconcile_job(spark, spark.createDataFrame(source, S.PAYMENTS), merchants, f"{tmp_dir}/silver/run_id=r{k}", f"{tmp_dir}/gold/run_id=g{k}", f"{tmp_dir}/audit/{k}").first()
        assert (row["raw_payment_count"], row["target_valid_payment_count"], row["quarantined_payment_rows"], row["status"]) == (4, 3, 1, "PASSED")
