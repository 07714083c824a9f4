import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.sinks.files import write_bronze, write_dataset
from lakeshift.sinks.manifest import bronze_manifest, content_checksum, verify_manifest
from lakeshift.sinks.publish import Layout, catalog_partitions, compact, plan_publication, publish, register_table
from lakeshift.sources.files import read_bronze
from lakeshift.sources.jdbc import key_borders, range_predicates
from conftest import rows

T0 = datetime(2024, 1, 1)


def test_bronze_csv_round_trip_keeps_awkward_text(spark, tmp_dir):
    data = [("m1", 'quote " and, comma', "FOOD", "line\nbreak", "X", "LOW", T0, T0, "b"), ("m2", None, "FOOD", "  ", "X", "LOW", T0, None, "b")]
    df = spark.createDataFrame(data, S.MERCHANTS)
    write_bronze(df, f"{tmp_dir}/run/merchants/extract_date=2024-01-01", batch_size=1)
    back = read_bronze(spark, f"{tmp_dir}/run", "merchants")
    assert "extract_date" in back.columns  # layout directory surfaces as lineage
    assert rows(back.select(*S.columns(S.MERCHANTS))) == rows(df)
    man = bronze_manifest(spark, f"{tmp_dir}/run/merchants/extract_date=2024-01-01", "merchants", "merchant_id").collect()
    assert len(man) == 2 and sum(r["record_count"] for r in man) == 2 and all(len(r["sha256"]) == 64 for r in man)
    with pytest.raises(Exception):
        write_bronze(df, f"{tmp_dir}/run/merchants/extract_date=2024-01-01")  # immutable run
    assert read_bronze(spark, f"{tmp_dir}/run", "payments", missing_ok=True).count() == 0


def test_content_checksum_is_layout_independent(fx):
    a = content_checksum(fx.payments_raw).collect()[0]
    b = content_checksum(fx.payments_raw.repartition(7)).collect()[0]
    assert a == b and a["record_count"] == 1500


def test_verify_manifest_statuses(spark):
    rec = spark.createDataFrame([("t", "b1", 3), ("t", "b2", 2), ("t", "b3", 1)], "source_table string, batch_id string, record_count long")
    got = spark.createDataFrame([("t", "b1", 3), ("t", "b2", 1), ("t", "b4", 5)], "source_table string, batch_id string, record_count long")
    status = dict(verify_manifest(rec, got).select("batch_id", "status").collect())
    assert status == {"b1": "MATCHED", "b2": "COUNT_MISMATCH", "b3": "MISSING_BATCH", "b4": "UNEXPECTED_BATCH"}


def test_partitioned_write_null_partition_and_rerun_refused(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, part string")
    write_dataset(df, f"{tmp_dir}/ds", "part")
    assert rows(spark.read.parquet(f"{tmp_dir}/ds"), "id", "part") == [(1, "a"), (2, None)]
    with pytest.raises(Exception):
        write_dataset(df, f"{tmp_dir}/ds", "part")


def test_compaction_preserves_rows_and_prunes_partitions(spark, fx, tmp_dir):
    from lakeshift.plans.silver import bronze_to_silver

    silver = bronze_to_silver(fx.merchants_raw, fx.customers_raw, fx.payments_raw, fx.settlements_raw)
    monthly = silver.payments_silver.withColumn("payment_date", F.trunc("payment_date", "month"))  # 80 partitions, not 1,400
    write_dataset(monthly, f"{tmp_dir}/silver/payments", "payment_date")
    src = spark.read.parquet(f"{tmp_dir}/silver/payments")
    n = compact(src, f"{tmp_dir}/pub/payments", date_column="payment_date")
    assert n == 1471 == spark.read.parquet(f"{tmp_dir}/pub/payments").count()
    months = [d for d in os.listdir(f"{tmp_dir}/pub/payments") if d.startswith("partition_year=")]
    assert len(months) == 7  # 1995..2001
    register_table(spark, "pub_payments", f"{tmp_dir}/pub/payments", spark.read.parquet(f"{tmp_dir}/pub/payments").schema, ["partition_year", "partition_month"])
    q = spark.table("pub_payments").filter("partition_year = 1998 AND partition_month = 6")
    assert "PartitionFilters: [isnotnull(partition_year" in q._jdf.queryExecution().executedPlan().toString()
    assert q.count() == src.filter(F.year("payment_date") == 1998).filter(F.month("payment_date") == 6).count()
    spark.sql("DROP TABLE pub_payments")


def test_registration_follows_the_publication(spark, tmp_dir):
    """A second publication under the same name: other rows, a vanished month, a new one, and one without a value."""

    def write(name, rows):
        df = spark.createDataFrame(rows, "id long, partition_year int, partition_month int")
        df.write.partitionBy("partition_year", "partition_month").parquet(f"{tmp_dir}/{name}")
        return register_table(spark, "moved_table", f"{tmp_dir}/{name}", df.schema, ["partition_year", "partition_month"])

    try:
        assert write("p1", [(1, 2024, 1), (2, 2024, 2), (3, 2024, 2)]) == {"added": 2, "dropped": 0, "kept": 0}
        assert spark.table("moved_table").count() == 3
        assert write("p2", [(k, 2024, 2) for k in range(4)] + [(9, None, 3)]) == {"added": 2, "dropped": 2, "kept": 0}
        assert spark.table("moved_table").count() == 5 and spark.table("moved_table").where("partition_month = 1").count() == 0
        assert [r.id for r in spark.table("moved_table").where("partition_year is null").collect()] == [9]
        # In place: only the difference is touched.
        spark.createDataFrame([(7,)], "id long").write.parquet(f"{tmp_dir}/p2/partition_year=2024/partition_month=5")
        import shutil

        shutil.rmtree(f"{tmp_dir}/p2/partition_year=2024/partition_month=2")
        schema = spark.table("moved_table").schema
        assert register_table(spark, "moved_table", f"{tmp_dir}/p2", schema, ["partition_year", "partition_month"]) == {"added": 1, "dropped": 1, "kept": 1}
        assert sorted(r.id for r in spark.table("moved_table").collect()) == [7, 9]
        assert register_table(spark, "moved_table", f"{tmp_dir}/p2", schema, ["partition_year", "partition_month"]) == {"added": 0, "dropped": 0, "kept": 2}
        assert catalog_partitions(spark, "moved_table") == {("2024", "5"), (None, "3")}
        with pytest.raises(ValueError, match="has the columns"):
            register_table(spark, "moved_table", f"{tmp_dir}/p2", spark.range(1).schema)
    finally:
        spark.sql("DROP TABLE IF EXISTS moved_table")


def test_an_unpartitioned_table_moves(spark, tmp_dir):
    try:
        for name, n in (("a", 3), ("b it's", 5)):
            spark.range(n).write.parquet(f"{tmp_dir}/{name}")
            register_table(spark, "plain_table", f"{tmp_dir}/{name}", spark.range(1).schema)
            assert spark.table("plain_table").count() == n
    finally:
        spark.sql("DROP TABLE IF EXISTS plain_table")


def test_publish_refuses_missing_source_and_existing_target(spark, tmp_dir):
    spark.range(10).write.parquet(f"{tmp_dir}/src")
    report = publish(spark, {f"{tmp_dir}/src": Layout("gold/small")}, f"{tmp_dir}/published/publication_id=t")
    assert rows(report, "dataset", "records") == [("gold/small", 10)]
    assert report.collect()[0]["output_parquet_files"] == 1
    assert spark.read.json(f"{tmp_dir}/published/publication_id=t/_publication_report").count() == 1
    with pytest.raises(FileExistsError):
        publish(spark, {f"{tmp_dir}/src": Layout("gold/small")}, f"{tmp_dir}/published/publication_id=t")
    with pytest.raises(FileNotFoundError):
        publish(spark, {f"{tmp_dir}/nope": Layout("x")}, f"{tmp_dir}/published/publication_id=u")


def test_planned_upload_keys_keep_published_prefix(spark, tmp_dir):
    """Reference unit case: the object key keeps the ``published/`` prefix."""
    root = f"{tmp_dir}/published"
    src = f"{root}/publication_id=test/silver/payments"
    os.makedirs(src)
    with open(f"{src}/part-00000.parquet", "wb") as f:
        f.write(b"parquet-test")
    got = plan_publication(spark, src, root, "project-prefix").select("object_key", "length").collect()
    assert [tuple(r) for r in got] == [("project-prefix/published/publication_id=test/silver/payments/part-00000.parquet", 12)]


def ranges(df, key, parts, **kw):
    """Rows of each range of ``key_borders``; together all rows, each once."""
    preds = range_predicates(key, key_borders(df, key, parts, **kw))
    out = [df.where(F.expr(p)) for p in preds]
    assert sum(d.count() for d in out) == df.count() and len(preds) <= parts
    return [d.count() for d in out]


def test_key_ranges_hold_about_as_many_rows_each(spark, fx, tmp_dir):
    fx.payments_raw.select("payment_id", "merchant_id", "source_record_id").write.parquet(f"{tmp_dir}/p")
    df = spark.read.parquet(f"{tmp_dir}/p")
    for key in ("payment_id", "source_record_id"):
        sizes = ranges(df, key, 8)
        assert len(sizes) == 8 and max(sizes) <= 1.2 * 1500 / 8 + 1
    sizes = ranges(df, "source_record_id", 8, sample=200)  # a bounded sample of the keys
    assert len(sizes) == 8 and max(sizes) < 2 * 1500 / 8
    sparse = df.selectExpr("CASE WHEN source_record_id < 1000 THEN source_record_id ELSE source_record_id * 1000000000 END AS k")
    assert max(ranges(sparse, "k", 5)) <= 1.2 * 1500 / 5


def test_a_key_with_a_third_of_the_rows_is_a_range_of_its_own(spark):
    df = spark.range(3000).selectExpr("CASE WHEN id % 3 = 0 THEN 'hot''s' WHEN id % 100 = 1 THEN NULL ELSE concat('k', id) END AS k")
    preds = range_predicates("k", key_borders(df, "k", 6))
    own = [p for p in preds if df.where(F.expr(p)).where("k = 'hot''s'").count()]
    assert len(own) == 1 and df.where(F.expr(own[0])).where("k IS NOT NULL").count() == 1000
    ranges(df, "k", 6)


def test_key_ranges_of_few_or_no_keys(spark):
    df = spark.range(10).selectExpr("id % 2 AS k")
    assert sorted(ranges(df, "k", 8)) == [5, 5]
    assert ranges(df.where("k > 5"), "k", 8) == [0] and ranges(df.selectExpr("CAST(NULL AS long) AS k"), "k", 8) == [10]
    assert range_predicates("k", ["a'b", "c"], '{key} COLLATE "C"') == ["k COLLATE \"C\" < 'a''b' OR k IS NULL", "k COLLATE \"C\" >= 'a''b' AND k COLLATE \"C\" < 'c'", "k COLLATE \"C\" >= 'c'"]


def test_reads_bronze_written_by_python_csv(spark, tmp_dir):
    """Batches landed by a Python ``csv.writer`` extractor (records.csv per batch)."""
    import csv

    p = f"{tmp_dir}/run/payments/extract_date=2024-01-02/batch_id=payments-00001"
    os.makedirs(p)
    with open(f"{p}/records.csv", "w", newline="") as f:
        w = csv.writer(f)
        w.writerow(S.columns(S.PAYMENTS))
        w.writerow([1, "pay_1", "c", "m", Decimal("10.50"), "INR", "CAPTURED", T0, datetime(2024, 1, 1, 0, 0, 0, 123456), T0, "seed"])
        w.writerow([2, 'odd "quoted", id', "c", "m", None, "INR", "FAILED", T0, T0, None, "line\nbreak"])
    got = {r["source_record_id"]: r for r in read_bronze(spark, f"{tmp_dir}/run", "payments").collect()}
    assert got[1]["payment_amount"] == Decimal("10.50") and got[1]["created_at"].microsecond == 123456
    assert got[2]["payment_id"] == 'odd "quoted", id' and got[2]["payment_amount"] is None and got[2]["source_batch_id"] == "line\nbreak"
    assert got[1]["batch_id"] == "payments-00001" and str(got[1]["extract_date"]) == "2024-01-02"


def test_file_checksums_equal_sha256_of_bytes(spark, tmp_dir):
    import hashlib

    from lakeshift.sinks.manifest import file_checksums

    os.makedirs(f"{tmp_dir}/f/sub")
    blobs = {f"{tmp_dir}/f/a.csv": b"x,y\n1,2\n", f"{tmp_dir}/f/sub/b.csv": b"x,y\n3,4\n" * 1000}
    for path, data in blobs.items():
        with open(path, "wb") as fh:
            fh.write(data)
    got = {r["path"].split("/")[-1]: r["sha256"] for r in file_checksums(spark, f"{tmp_dir}/f", "*.csv").collect()}
    assert got == {p.split("/")[-1]: hashlib.sha256(d).hexdigest() for p, d in blobs.items()}


def test_unified_quarantine_partitions_by_table_and_reason(spark, fx, tmp_dir):
    from lakeshift.plans.silver import bronze_to_silver
    from lakeshift.sinks.files import write_quarantine

    silver = bronze_to_silver(fx.merchants_raw, fx.customers_raw, fx.payments_raw, fx.settlements_raw)
    write_quarantine(silver.quarantine_union(), f"{tmp_dir}/q", as_of=datetime(2024, 1, 1))
    back = spark.read.parquet(f"{tmp_dir}/q")
    counts = {(r[0], r[1]): r[2] for r in back.groupBy("source_table", "rejection_reason").count().collect()}
    assert counts[("payments", S.DUPLICATE_PAYMENT_ID)] == 6 and counts[("merchants", S.MISSING_MERCHANT_ID)] == 2
    assert sum(counts.values()) == silver.quarantine_union().count()
