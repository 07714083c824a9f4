"""A merge writes the touched days and refers to the base run for all others."""

import os
from datetime import datetime, timedelta
from decimal import Decimal

from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.plans import jobs
from lakeshift.sinks.files import write_bronze, write_dataset
from lakeshift.sinks.publish import Layout, publish, register_table
from lakeshift.sources.files import read_dataset

T0 = datetime(2024, 1, 1)


def payment(k, day, amount=10, updated=0):
    return (k, f"p{k}", "c1", "m1", Decimal(amount), "INR", "CAPTURED", T0 + timedelta(days=day), T0, T0 + timedelta(days=updated), "b")


def settlement(k, day, amount=10, updated=0):
    return (k, f"s{k}", f"p{k}", "m1", Decimal(amount), "SETTLED", T0 + timedelta(days=day), T0, T0 + timedelta(days=updated), "b")


def files(path):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(path) for f in names}


def days_in(path):
    return sorted(d.partition("=")[2] for d in os.listdir(path) if d.startswith(("payment_date=", "settlement_date=")))


def merge(spark, root, base, run, payments=(), settlements=()):
    inc = f"{root}/bronze/{run}"
    if payments:
        write_bronze(spark.createDataFrame(payments, S.PAYMENTS), f"{inc}/payments")
    if settlements:
        write_bronze(spark.createDataFrame(settlements, S.SETTLEMENTS), f"{inc}/settlements")
    jobs.merge_job(spark, f"{root}/silver/run_id={base}", inc, f"{root}/silver", f"{root}/quarantine", run)
    return read_dataset(spark, f"{root}/silver/run_id={run}", "payments")


def amounts(df):
    return {r[0]: (str(r[1]), int(r[2])) for r in df.select("payment_id", "payment_date", "payment_amount").collect()}


def test_only_touched_days_are_written(spark, tmp_dir):
    base = f"{tmp_dir}/silver/run_id=r0"
    write_dataset(spark.createDataFrame([("m1", "n", "RETAIL", "c", "s", "LOW", T0, T0, "b")], S.MERCHANTS), f"{base}/merchants")
    write_dataset(spark.createDataFrame([], S.CUSTOMERS), f"{base}/customers")
    write_dataset(spark.createDataFrame([payment(k, k % 10) for k in range(100)], S.PAYMENTS).withColumn("payment_date", F.to_date("payment_timestamp")), f"{base}/payments", "payment_date")
    write_dataset(spark.createDataFrame([settlement(k, k % 10) for k in range(100)], S.SETTLEMENTS).withColumn("settlement_date", F.to_date("settlement_timestamp")), f"{base}/settlements", "settlement_date")
    before = files(base)
    want = {f"p{k}": (str((T0 + timedelta(days=k % 10)).date()), 10) for k in range(100)}

    # Two days: an amended row, a new one, and a stale one of a third day that changes nothing but is looked at.
    first = merge(spark, tmp_dir, "r0", "r1", [payment(3, 3, 77, 5), payment(200, 4, 5, 5)], [settlement(3, 3, 77, 5)])
    want |= {"p3": ("2024-01-04", 77), "p200": ("2024-01-05", 5)}
    assert amounts(first) == want and first.count() == 101
    assert days_in(f"{tmp_dir}/silver/run_id=r1/payments") == ["2024-01-04", "2024-01-05"]

    # A row moves to a new day, which empties none; then a chain of three runs is read; a merged base merges settlements by day.
    second = merge(spark, tmp_dir, "r1", "r2", [payment(3, 40, 78, 9), payment(200, 41, 6, 9)], [settlement(5, 5, 50, 9)])
    want |= {"p3": ("2024-02-10", 78), "p200": ("2024-02-11", 6)}
    assert amounts(second) == want and second.count() == 101
    assert days_in(f"{tmp_dir}/silver/run_id=r2/payments") == ["2024-01-04", "2024-01-05", "2024-02-10", "2024-02-11"]
    assert days_in(f"{tmp_dir}/silver/run_id=r2/settlements") == ["2024-01-06"]
    third = merge(spark, tmp_dir, "r2", "r3", [payment(200, 42, 7, 12)])
    want |= {"p200": ("2024-02-12", 7)}
    assert amounts(third) == want  # 2024-02-11 has no row left, and no folder
    assert days_in(f"{tmp_dir}/silver/run_id=r3/payments") == ["2024-02-12"]
    settled = read_dataset(spark, f"{tmp_dir}/silver/run_id=r3", "settlements")
    assert settled.count() == 100 and settled.where("settlement_id = 's5'").first()["settlement_amount"] == 50
    assert files(base) == before  # old runs stay as they are

    # Pruned as one table, published and registered like any other.
    pruned = third.where("payment_date = DATE'2024-01-08'")
    assert pruned.count() == 10 and all("payment_date=2024-01-08" in f for f in pruned.inputFiles() if "payment_date" in f and f.split("payment_date=")[1][:10] == "2024-01-08")
    report = publish(spark, {f"{tmp_dir}/silver/run_id=r3/payments": Layout("silver/payments", month_of="payment_date")}, f"{tmp_dir}/published/publication_id=p").first()
    assert report["records"] == 101 and report["input_parquet_files"] >= 12
    try:
        schema = third.schema
        assert register_table(spark, "merged_days", f"{base}/payments", schema, ["payment_date"])["added"] == 10
        register_table(spark, "merged_days", f"{tmp_dir}/silver/run_id=r3/payments", schema, ["payment_date"])
        assert amounts(spark.table("merged_days")) == want
    finally:
        spark.sql("DROP TABLE IF EXISTS merged_days")


def test_rows_without_a_day_and_an_empty_increment(spark, tmp_dir):
    base = f"{tmp_dir}/silver/run_id=r0"
    write_dataset(spark.createDataFrame([("m1", "n", "RETAIL", "c", "s", "LOW", T0, T0, "b")], S.MERCHANTS), f"{base}/merchants")
    write_dataset(spark.createDataFrame([], S.CUSTOMERS), f"{base}/customers")
    none = (7, "p7", "c1", "m1", Decimal(1), "INR", "CAPTURED", None, T0, T0, "b")
    write_dataset(spark.createDataFrame([payment(1, 1), none], S.PAYMENTS).withColumn("payment_date", F.to_date("payment_timestamp")), f"{base}/payments", "payment_date")
    write_dataset(spark.createDataFrame([], S.SETTLEMENTS).withColumn("settlement_date", F.to_date("settlement_timestamp")), f"{base}/settlements", "settlement_date")
    assert merge(spark, tmp_dir, "r0", "r1").count() == 2
    second = merge(spark, tmp_dir, "r1", "r2", [(7, "p7", "c1", "m1", Decimal(2), "INR", "CAPTURED", T0, T0, T0 + timedelta(days=1), "b")])
    assert {r["payment_id"]: (r["payment_amount"], str(r["payment_date"])) for r in second.collect()} == {"p1": (10, "2024-01-02"), "p7": (2, "2024-01-01")}
