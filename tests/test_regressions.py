"""Cases that once gave wrong results: long numbers, fractions of seconds, repeated ids, damaged files, absent marks."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.functions.columns import padded_id
from lakeshift.operators.dedup import flag_latest, latest_by_key
from lakeshift.operators.reconcile import top_merchants
from lakeshift.operators.scd2 import scd2_changes, scd2_init, scd2_merge
from lakeshift.plans import jobs
from lakeshift.sinks.files import write_bronze
from lakeshift.sinks.manifest import batch_manifest, row_digest
from lakeshift.sinks.publish import plan_publication
from lakeshift.sources.files import header_signatures, read_bronze
from lakeshift.sources.incremental import advance_watermark

T0 = datetime(2024, 1, 2, 3, 4, 5, 123456)


def test_numbers_are_padded_and_never_cut(spark):
    got = spark.createDataFrame([(1,), (99_999,), (100_000,), (1_000_000,)], "n long").select(padded_id("p-", F.col("n"), 5)).collect()
    assert [r[0] for r in got] == ["p-00001", "p-99999", "p-100000", "p-1000000"]
    keys = spark.createDataFrame([(9_998 * 10,), (99_999 * 10,), (999_999 * 10,)], "source_record_id long")
    got = {r["batch_id"]: r["record_count"] for r in batch_manifest(keys, "payments", "source_record_id", 10).collect()}
    assert got == {"payments-09999": 1, "payments-100000": 1, "payments-1000000": 1}


def merchants(spark, rows):
    return spark.createDataFrame([(k, "a, \"b\"\nc", cat, "x", None, "LOW", created, updated, "b") for k, cat, created, updated in rows], S.MERCHANTS)


def test_bronze_keeps_microseconds(spark, tmp_dir):
    df = merchants(spark, [("m1", "FOOD", T0, T0), ("m2", "FOOD", T0, None)])
    write_bronze(df, f"{tmp_dir}/merchants")
    assert sorted(map(tuple, read_bronze(spark, tmp_dir, "merchants").collect())) == sorted(map(tuple, df.collect()))


def test_columns_are_read_by_the_names_in_the_header(spark, tmp_dir):
    """Files of one table, each with its own order of columns, read as one; extra columns are left out."""
    df = merchants(spark, [("m1", "FOOD", T0, T0)])
    other = merchants(spark, [("m2", "RETAIL", T0, None), ("m3", "FOOD", T0, T0)])
    third = merchants(spark, [("m4", "FOOD", T0, T0)])
    write_bronze(df, f"{tmp_dir}/merchants/extract_date=2024-01-01")
    write_bronze(other.select(*reversed(other.columns)), f"{tmp_dir}/merchants/extract_date=2024-01-02")
    write_bronze(third.select("city", F.lit("new").alias("extra"), *[c for c in third.columns if c != "city"]), f"{tmp_dir}/merchants/extract_date=2024-01-03")
    got = read_bronze(spark, tmp_dir, "merchants")
    assert got.columns == [*df.columns, "extract_date"]
    assert sorted(map(tuple, got.drop("extract_date").collect()), key=repr) == sorted(map(tuple, df.union(other).union(third).collect()), key=repr)
    assert {r[0].isoformat(): r[1] for r in got.groupBy("extract_date").count().collect()} == {"2024-01-01": 1, "2024-01-02": 2, "2024-01-03": 1}


def test_one_order_is_one_scan(spark, tmp_dir):
    df = merchants(spark, [(f"m{k}", "FOOD", T0, T0) for k in range(40)])
    write_bronze(df.select(*reversed(df.columns)), f"{tmp_dir}/merchants", 3)
    got = read_bronze(spark, tmp_dir, "merchants")
    assert got._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, df.collect()))


def test_a_header_that_lacks_a_column_names_its_file(spark, tmp_dir):
    df = merchants(spark, [("m1", "FOOD", T0, T0)])
    write_bronze(df, f"{tmp_dir}/merchants/extract_date=2024-01-01")
    write_bronze(df.drop("city"), f"{tmp_dir}/merchants/extract_date=2024-01-02")
    with pytest.raises(ValueError, match=r"extract_date=2024-01-02/part-.*csv: header lacks city"):
        read_bronze(spark, tmp_dir, "merchants")
    write_bronze(df.withColumn("city ", F.lit("x")).toDF(*df.columns, "state"), f"{tmp_dir}/more/merchants")
    with pytest.raises(ValueError, match="header repeats state"):
        read_bronze(spark, f"{tmp_dir}/more", "merchants")


def test_only_first_lines_are_read_for_headers(spark, tmp_dir):
    """A quoted line break in a value, an empty file and a large file change nothing."""
    df = merchants(spark, [(f"m{k}", "FOOD\nx", T0, T0) for k in range(30_000)])
    write_bronze(df.coalesce(1), f"{tmp_dir}/merchants", 30_000)
    open(f"{tmp_dir}/merchants/empty.csv", "w").close()
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "100k")  # so that the file has many parts
    try:
        found = header_signatures(spark, f"{tmp_dir}/merchants")
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert list(found) == [tuple(df.columns)] and [len(f) for f in found.values()] == [1]
    assert read_bronze(spark, tmp_dir, "merchants").count() == 30_000


def test_one_row_survives_where_ids_repeat(spark):
    rows = [("a", 1, 5, "x"), ("a", 1, 5, "x"), ("a", 1, 6, "y"), ("b", 2, 1, "z"), ("b", 2, 1, "z"), ("c", None, 1, "q"), (None, 3, 1, "n")]
    df = spark.createDataFrame(rows, "k string, source_record_id long, updated_at int, v string")
    flagged = flag_latest(df, "k")
    assert flagged.count() == len(rows)
    assert sorted((r.k, r.v) for r in flagged.where("is_latest").collect()) == [("a", "y"), ("b", "z"), ("c", "q")]
    assert sorted(r.k or "" for r in latest_by_key(df, "k").collect()) == ["", "a", "b", "c"]


def test_digest_separates_values_and_nulls(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "x"), ("\\N", "x"), ("-", "x"), ("", "x"), ("1:a", ""), ("1", "a:")], "p string, q string")
    assert df.select(row_digest(df)).distinct().count() == df.count()


def test_watermark_of_new_and_empty_tables(spark, tmp_dir):
    state = spark.createDataFrame([("a", T0, "1"), ("b", T0, "2")], jobs.STATE)
    marks = spark.createDataFrame([("b", None, None), ("c", T0, "9")], jobs.STATE)
    got = {r["source_table"]: (r["updated_at"], r["source_key"]) for r in advance_watermark(state, marks).collect()}
    assert got == {"a": (T0, "1"), "b": (T0, "2"), "c": (T0, "9")}
    empty = merchants(spark, [])
    saved = jobs.initialize_state(spark, {"merchants": empty}, f"{tmp_dir}/state").collect()
    assert [(r["source_table"], r["updated_at"], r["source_key"]) for r in saved] == [("merchants", None, None)]
    jobs.extract_incremental(spark, {"merchants": merchants(spark, [("m1", "FOOD", T0, T0)])}, f"{tmp_dir}/bronze", "i1", f"{tmp_dir}/state", datetime(2025, 1, 1))
    (row,) = jobs.read_state(spark, f"{tmp_dir}/state").collect()
    assert (row["updated_at"], row["source_key"]) == (T0, "m1")  # to the microsecond


def test_verification_finds_damaged_deleted_and_added_files(spark, tmp_dir):
    import glob
    import os

    sources = {"merchants": merchants(spark, [(f"m{i}", "FOOD", T0, T0) for i in range(9)]).repartition(3), "customers": spark.createDataFrame([], S.CUSTOMERS)}
    jobs.extract_full(spark, sources, tmp_dir, "r1", 3)
    run = f"{tmp_dir}/run_id=r1"
    status = lambda: sorted(r["status"] for r in jobs.verify_extract(spark, run).collect())
    assert set(status()) == {"MATCHED"}
    files = sorted(glob.glob(f"{run}/merchants/*/batch=*/*.csv"))
    assert len(files) == 3
    with open(files[0]) as f:
        text = f.read()
    added = f"{os.path.dirname(os.path.dirname(files[0]))}/batch=00009"
    os.makedirs(added)
    for path in (files[0], f"{added}/part-added.csv"):
        with open(path, "w") as f:
            f.write(text.replace("FOOD", "FEUD"))
    for crc in glob.glob(f"{run}/merchants/*/batch=*/.*.crc"):
        os.remove(crc)
    os.remove(files[1])
    got = status()
    assert "DIGEST_MISMATCH" in got and "MISSING_BATCH" in got and "UNEXPECTED_BATCH" in got


def test_failed_chain_writes_the_failure_metric(spark, tmp_dir):
    with pytest.raises(Exception):
        jobs.full_migration(spark, {"merchants": merchants(spark, []).drop("city")}, tmp_dir, "r1")
    assert [(r["metric_name"], r["value"]) for r in spark.read.json(f"{tmp_dir}/metrics/run_id=r1").collect()] == [("PipelineSuccess", 0)]


def test_version_without_a_start_is_superseded(spark):
    history = scd2_init(merchants(spark, [("m1", "FOOD", None, None), ("m2", "FOOD", T0, T0)]))
    later = datetime(2025, 1, 1)
    changes = merchants(spark, [("m1", "LUXURY", later, later), ("m2", "LUXURY", T0, T0)])
    assert [r["merchant_id"] for r in scd2_changes(history, changes, "merchant_id", S.SCD2_TRACKED_COLUMNS).collect()] == ["m1"]
    merged = scd2_merge(history, changes, "merchant_id", S.SCD2_TRACKED_COLUMNS).collect()
    assert sorted((r["merchant_id"], r["scd_version"], r["is_current"], r["effective_to"]) for r in merged if r["merchant_id"] == "m1") == [("m1", 1, False, later), ("m1", 2, True, None)]


def test_publication_keys_stay_apart(spark, tmp_dir):
    for n in (1, 2):
        spark.range(n).coalesce(1).write.parquet(f"{tmp_dir}/published/d{n}")
    keys = [r["object_key"] for r in plan_publication(spark, f"file://{tmp_dir}/published", f"{tmp_dir}/published", "p").collect()]
    assert len(set(keys)) == len(keys) and {k.split("/")[2] for k in keys} == {"d1", "d2"}
    with pytest.raises(ValueError):
        plan_publication(spark, f"{tmp_dir}/published", f"{tmp_dir}/other", "p")


def test_top_merchants_filters_a_range_of_dates(spark):
    daily = spark.createDataFrame([("m1", datetime(1998, 12, 31).date(), 5), ("m1", datetime(1999, 1, 1).date(), 9)], "merchant_id string, business_date date, payment_count long")
    assert [tuple(r) for r in top_merchants(daily, 1998, 12).collect()] == [("m1", 5)]


def test_changes_in_place_are_accounted_for(spark, tmp_dir):
    from decimal import Decimal

    day, later = datetime(2024, 1, 1), datetime(2024, 2, 1)

    def payments(rows):
        data = [{"source_record_id": k, "payment_id": p, "customer_id": "c1", "merchant_id": "m1", "payment_amount": Decimal(a), "currency": "USD", "payment_status": "SUCCESS", "payment_timestamp": day, "created_at": day, "updated_at": u, "source_batch_id": "b"} for k, p, a, u in rows]
        return spark.createDataFrame([tuple(d[c] for c in S.columns(S.PAYMENTS)) for d in data], S.PAYMENTS)

    base = {"merchants": merchants(spark, [("m1", "FOOD", day, day)]), "customers": spark.createDataFrame([], S.CUSTOMERS), "payments": payments([(1, "p1", "5.00", day), (2, "p2", "6.00", day), (3, "p3", "0.00", day), (4, "p1", "5.00", datetime(2023, 1, 1))]), "settlements": spark.createDataFrame([], S.SETTLEMENTS)}
    out = jobs.full_migration(spark, base, tmp_dir, "r1")
    assert out["reconciliation"].first()["status"] == "PASSED"
    write_bronze(payments([(2, "p2", "7.00", later), (3, "p3", "8.00", later), (5, "p5", "0.00", later)]), f"{tmp_dir}/bronze/run_id=i1/payments")
    jobs.merge_job(spark, f"{tmp_dir}/silver/run_id=r1", f"{tmp_dir}/bronze/run_id=i1", f"{tmp_dir}/silver", f"{tmp_dir}/quarantine", "m1")
    jobs.silver_to_gold_job(spark, f"{tmp_dir}/silver/run_id=m1", f"{tmp_dir}/gold", "g1")
    now = payments([(1, "p1", "5.00", day), (2, "p2", "7.00", later), (3, "p3", "8.00", later), (4, "p1", "5.00", datetime(2023, 1, 1)), (5, "p5", "0.00", later)])
    row = jobs.reconcile_job(spark, now, base["merchants"], f"{tmp_dir}/silver/run_id=m1", f"{tmp_dir}/gold/run_id=g1", f"{tmp_dir}/audit/m1").first()
    assert (row["raw_payment_count"], row["target_valid_payment_count"], row["quarantined_payment_rows"], row["status"]) == (5, 3, 2, "PASSED")
