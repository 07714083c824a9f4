"""Ordered, numbered batches, and the claim on the watermark state."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.plans import jobs
from lakeshift.sinks.batches import number_batches, ordered_manifest
from lakeshift.sources.files import read_bronze

T0 = datetime(2024, 1, 1)


def staged(tmp):
    def write(df, name):
        df.write.mode("overwrite").parquet(f"{tmp}/{name}")
        return df.sparkSession.read.parquet(f"{tmp}/{name}")

    return write


def payments(spark, rows):
    """Rows (source_record_id, days)."""
    full = [(k, f"p{k}", "c1", "m1", Decimal(1), "INR", "CAPTURED", T0, T0, None if d is None else T0 + timedelta(days=d), "b") for k, d in rows]
    return spark.createDataFrame(full, S.PAYMENTS)


@pytest.mark.parametrize("size", [1, 7, 10, 1000])
def test_batches_ascend_and_are_full(spark, tmp_dir, size):
    keys = [(k * 37) % 101 for k in range(101)] + [None, None, 50, 50, 50]
    df = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k long, i long").repartition(5)
    out = number_batches(df, ["k"], size, staged(tmp_dir)).select("k", "i", "batch_number").collect()
    assert sorted((r.i, r.k) for r in out) == sorted((i, k) for i, k in enumerate(keys))
    order = sorted((r.k is not None, r.k or 0) for r in out)
    want = {}
    for place, k in enumerate(order):
        want.setdefault(place // size + 1, []).append(k)
    got = {}
    for r in out:
        got.setdefault(r.batch_number, []).append((r.k is not None, r.k or 0))
    assert {b: sorted(k) for b, k in got.items()} == want


def test_a_key_with_most_rows_is_split(spark, tmp_dir):
    df = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(7)).alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # they are small here
    try:
        out = number_batches(df, ["k"], 500, staged(tmp_dir))
        assert {r["count"] for r in out.groupBy("batch_number").count().collect()} == {500}
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows = spark.read.parquet(f"{tmp_dir}/ordered").groupBy(F.shiftright("_at", 33)).count().agg(F.max("count")).first()[0]
    assert rows < 10_000  # of the 13,334 with one key


def test_empty_extract_has_no_batch(spark, tmp_dir):
    out = number_batches(payments(spark, []), ["source_record_id"], 10, staged(tmp_dir))
    assert ordered_manifest(out, "payments", "source_record_id", ["source_record_id"]).collect() == []


def test_full_extract_lands_numbered_files_in_order(spark, tmp_dir):
    df = payments(spark, [((k * 7) % 50, k) for k in range(50)])
    manifest = jobs.extract_full(spark, {"payments": df.repartition(3)}, f"{tmp_dir}/bronze", "r1", 20)
    got = [(r.batch_id, r.batch_number, r.record_count, r.last_source_key, r.watermark_after_batch) for r in manifest.orderBy("batch_number").collect()]
    assert got == [("payments-00001", 1, 20, "19", None), ("payments-00002", 2, 20, "39", None), ("payments-00003", 3, 10, "49", None)]
    back = read_bronze(spark, f"{tmp_dir}/bronze/run_id=r1", "payments")
    assert {(r[0], r[1], r[2]) for r in back.groupBy("batch").agg(F.min("source_record_id"), F.max("source_record_id")).collect()} == {(1, 0, 19), (2, 20, 39), (3, 40, 49)}
    assert {r.status for r in jobs.verify_extract(spark, f"{tmp_dir}/bronze/run_id=r1").collect()} == {"MATCHED"}


def test_incremental_batches_carry_marks_that_a_run_could_stop_at(spark, tmp_dir):
    old, new = [(k, 0) for k in range(5)], [(k, 1 + k % 4) for k in range(10, 40)] + [(99, None)]
    jobs.initialize_state(spark, {"payments": payments(spark, old)}, f"{tmp_dir}/state")
    manifest = jobs.extract_incremental(spark, {"payments": payments(spark, old + new)}, f"{tmp_dir}/bronze", "i1", f"{tmp_dir}/state", T0 + timedelta(days=3), 8)
    rows = sorted((d, k) for k, d in new if d is not None and d <= 3)
    want = [(n + 1, len(rows[a : a + 8]), str(rows[a : a + 8][-1][1]), T0 + timedelta(days=rows[a : a + 8][-1][0])) for n, a in enumerate(range(0, len(rows), 8))]
    assert [(r.batch_number, r.record_count, r.last_source_key, r.watermark_after_batch) for r in manifest.orderBy("batch_number").collect()] == want
    state = jobs.read_state(spark, f"{tmp_dir}/state").first()
    assert (state["updated_at"], state["source_key"], state["version"]) == (want[-1][3], want[-1][2], 2)


def test_of_two_runs_at_a_time_one_fails_before_it_writes(spark, tmp_dir, monkeypatch):
    source = {"payments": payments(spark, [(k, k % 3) for k in range(9)])}
    jobs.initialize_state(spark, {"payments": payments(spark, [(0, 0)])}, f"{tmp_dir}/state")
    real, seen = jobs.write_batches, []

    def interleaved(*args, **kw):
        if not seen:
            seen.append(1)
            with pytest.raises(jobs.StateClaimed):
                jobs.extract_incremental(spark, source, f"{tmp_dir}/bronze", "second", f"{tmp_dir}/state", T0 + timedelta(days=9))
        return real(*args, **kw)

    monkeypatch.setattr(jobs, "write_batches", interleaved)
    jobs.extract_incremental(spark, source, f"{tmp_dir}/bronze", "first", f"{tmp_dir}/state", T0 + timedelta(days=9))
    assert seen and not jobs.path_exists(spark, f"{tmp_dir}/bronze/run_id=second")
    assert jobs.state_versions(spark, f"{tmp_dir}/state") == [1, 2]


def test_a_failed_run_gives_its_claim_up_and_an_unfinished_version_is_not_read(spark, tmp_dir, monkeypatch):
    source = {"payments": payments(spark, [(k, 1) for k in range(9)])}
    jobs.initialize_state(spark, {"payments": payments(spark, [(0, 0)])}, f"{tmp_dir}/state")
    with monkeypatch.context() as m:
        m.setattr(jobs, "write_listing", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            jobs.extract_incremental(spark, source, f"{tmp_dir}/bronze", "i1", f"{tmp_dir}/state", T0 + timedelta(days=9))
    spark.range(1).select(F.lit("payments").alias("source_table"), F.lit("9").alias("source_key")).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").json(f"{tmp_dir}/state/version=7")
    assert jobs.state_versions(spark, f"{tmp_dir}/state") == [1]
    jobs.extract_incremental(spark, source, f"{tmp_dir}/bronze", "i2", f"{tmp_dir}/state", T0 + timedelta(days=9))
    assert jobs.read_state(spark, f"{tmp_dir}/state").first()["version"] == 2
