"""End-to-end jobs on sf0.001 fixtures, written to a fresh temp folder."""

from datetime import datetime

import pytest
from conftest import by_month
from pyspark.sql import functions as F

from lakeshift.plans import jobs
from lakeshift.sinks.files import write_bronze
from lakeshift.sinks.publish import publish
from lakeshift.sources.files import read_dataset


@pytest.fixture(scope="module")
def migrated(spark, fx):
    import tempfile

    root = tempfile.mkdtemp(prefix="lakeshift-e2e-")
    sources = {"merchants": fx.merchants_raw, "customers": fx.customers_raw, "payments": by_month(fx.payments_raw), "settlements": by_month(fx.settlements_raw)}
    out = jobs.full_migration(spark, sources, root, "r1", batch_size=500)
    return root, out


def test_full_migration_counts(migrated, spark):
    root, out = migrated
    manifest = {r["source_table"]: r["n"] for r in out["manifest"].groupBy("source_table").agg(F.sum("record_count").alias("n")).collect()}
    assert manifest == {"merchants": 12, "customers": 152, "payments": 1500, "settlements": 1335}
    assert out["manifest"].filter(F.col("record_count") > 500).count() == 0  # batches bounded
    assert {r["status"] for r in jobs.verify_extract(spark, f"{root}/bronze/run_id=r1").collect()} == {"MATCHED"}
    q = {(r["section"], r["name"]): r["value"] for r in out["quality"].collect()}
    assert q[("valid_rows", "payments")] == 1471 and q[("quarantined_rows", "payments_duplicates")] == 6
    assert q[("valid_rows", "settlements")] == 1318
    recon = out["reconciliation"].collect()[0]
    assert recon["status"] == "PASSED" and recon["target_valid_payment_count"] == 1471
    metrics = dict(out["metrics"].select("metric_name", "value").collect())
    assert metrics["PipelineSuccess"] == 1 and metrics["ValidPayments"] == 1471
    gold = spark.read.parquet(f"{root}/gold/run_id=r1/payment_reconciliation")
    assert {r[0]: r[1] for r in gold.groupBy("reconciliation_status").count().collect()} == {
        "MATCHED": 1276, "MISSING_SETTLEMENT": 159, "UNDER_SETTLED": 30, "OVER_SETTLED": 6
    }
    days = spark.read.parquet(f"{root}/silver/run_id=r1/payments").select("merchant_id", "payment_date").distinct().count()
    assert spark.read.parquet(f"{root}/gold/run_id=r1/merchant_daily_metrics").count() == days > 300
    with pytest.raises(FileExistsError):
        jobs.bronze_to_silver_job(spark, f"{root}/bronze/run_id=r1", f"{root}/silver", f"{root}/quarantine", "r1")
    v = jobs.validate_job(spark, f"{root}/silver/run_id=r1", f"{root}/gold/run_id=r1", f"{root}/quality", "v1")
    assert {r["suite_status"] for r in v.collect()} == {"PASSED"}


def test_incremental_merge_scd2_and_publish(migrated, spark, fx):
    root, _ = migrated
    inc = f"{root}/bronze/run_id=inc1"
    write_bronze(fx.merchants_inc, f"{inc}/merchants")
    write_bronze(by_month(fx.payments_inc), f"{inc}/payments")
    write_bronze(by_month(fx.settlements_inc), f"{inc}/settlements")
    report = jobs.merge_job(spark, f"{root}/silver/run_id=r1", inc, f"{root}/silver", f"{root}/quarantine", "m1")
    r = {(x["section"], x["name"]): x["value"] for x in report.collect()}
    assert r[("merged_rows", "payments")] == 1478 and r[("merged_rows", "settlements")] == 1328 and r[("merged_rows", "merchants")] == 11
    merged = read_dataset(spark, f"{root}/silver/run_id=m1", "payments")
    assert merged.filter(F.col("source_record_id") >= 10_000_000).count() == 45
    # Q10: a merged run carries a cumulative quality report, so the same
    # reconciliation runs on it against the combined source and passes.
    jobs.silver_to_gold_job(spark, f"{root}/silver/run_id=m1", f"{root}/gold", "g-m1")
    src_payments = by_month(fx.payments_raw.unionByName(fx.payments_inc))
    src_merchants = fx.merchants_raw.unionByName(fx.merchants_inc)
    rec = jobs.reconcile_job(spark, src_payments, src_merchants, f"{root}/silver/run_id=m1", f"{root}/gold/run_id=g-m1", f"{root}/audit/m1").collect()[0]
    assert (rec["raw_payment_count"], rec["target_valid_payment_count"], rec["status"]) == (1598, 1478, "PASSED"), rec
    s = jobs.scd2_job(spark, f"{root}/gold/run_id=r1/merchant_scd2", inc, f"{root}/gold", "scd1").collect()[0]
    assert (s["changed_merchants"], s["total_scd2_rows"], s["current_scd2_rows"], s["closed_scd2_rows"]) == (2, 12, 10, 2)
    from lakeshift.sinks.publish import publication_bundle

    bundle = publication_bundle(f"{root}/silver/run_id=m1", f"{root}/gold/run_id=r1", f"{root}/gold/run_id=scd1")
    rep = publish(spark, bundle, f"{root}/published/publication_id=p1")
    got = {x["dataset"]: x["records"] for x in rep.collect()}
    assert len(got) == 9
    assert got["silver/payments"] == 1478 and got["gold/payment_reconciliation"] == 1471 and got["gold/merchant_scd2_history"] == 12
    assert got["gold/merchant_daily_metrics"] == spark.read.parquet(f"{root}/gold/run_id=r1/merchant_daily_metrics").count() and got["gold/reconciliation_summary"] == 4 and got["silver/merchants"] == 11
    months = spark.read.parquet(f"{root}/published/publication_id=p1/gold/merchant_daily_metrics").select("partition_year", "partition_month").distinct().count()
    assert months == 80


def test_incremental_extract_state_versions(spark, fx, tmp_dir):
    old = fx.payments_raw.filter(F.col("updated_at") < F.lit(datetime(2001, 1, 1)).cast("timestamp_ntz"))
    state = jobs.initialize_state(spark, {"payments": old}, f"{tmp_dir}/state")
    mark = state.collect()[0]
    m1 = jobs.extract_incremental(spark, {"payments": fx.payments_raw}, f"{tmp_dir}/bronze", "i1", f"{tmp_dir}/state", cutoff=datetime(2001, 3, 31))
    m2 = jobs.extract_incremental(spark, {"payments": fx.payments_raw}, f"{tmp_dir}/bronze", "i2", f"{tmp_dir}/state", cutoff=datetime(2001, 6, 30))
    from lakeshift.sources.incremental import changes_since
    from lakeshift.sources.files import read_bronze

    a = {r[0] for r in read_bronze(spark, f"{tmp_dir}/bronze/run_id=i1", "payments").select("source_record_id").collect()}
    b = {r[0] for r in read_bronze(spark, f"{tmp_dir}/bronze/run_id=i2", "payments").select("source_record_id").collect()}
    expect = changes_since(fx.payments_raw, (mark["updated_at"], int(mark["source_key"])), datetime(2001, 6, 30), "source_record_id")
    assert not (a & b) and a | b == {r[0] for r in expect.select("source_record_id").collect()}
    assert jobs.read_state(spark, f"{tmp_dir}/state").collect()[0]["version"] == 3
