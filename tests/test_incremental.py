from datetime import datetime


from lakeshift.sources.incremental import advance_watermark, changes_since, latest_watermark
from conftest import rows


def test_watermark_predicate_is_composite(spark):
    t1, t2 = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = spark.createDataFrame([(1, t1), (2, t1), (3, t2), (4, None), (5, datetime(2024, 2, 1))], "k long, updated_at timestamp_ntz")
    got = rows(changes_since(df, (t1, 1), datetime(2024, 1, 31), "k"), "k")
    assert got == [(2,), (3,)]  # same ts, higher key; newer ts; not beyond cutoff; NULL ts never
    assert rows(changes_since(df, None, datetime(2024, 1, 31), "k"), "k") == [(1,), (2,), (3,)]


def test_successive_extracts_are_disjoint_and_complete(fx):
    p = fx.payments_raw
    mark0 = ("2000-01-01 00:00:00", 0)
    first = changes_since(p, mark0, "2000-06-30 00:00:00", "source_record_id")
    m = latest_watermark(first, "source_record_id", "payments").collect()[0]
    second = changes_since(p, (m["updated_at"], int(m["source_key"])), "2001-06-30 00:00:00", "source_record_id")
    once = changes_since(p, mark0, "2001-06-30 00:00:00", "source_record_id")
    a, b = {r[0] for r in first.select("source_record_id").collect()}, {r[0] for r in second.select("source_record_id").collect()}
    assert not (a & b)
    assert a | b == {r[0] for r in once.select("source_record_id").collect()}


def test_latest_watermark_empty_is_null_and_advance_keeps_old(spark):
    empty = spark.createDataFrame([], "k long, updated_at timestamp_ntz")
    mark = latest_watermark(empty, "k", "t").collect()[0]
    assert mark["updated_at"] is None and mark["source_key"] is None
    old = spark.createDataFrame([("t", datetime(2024, 1, 1), "7"), ("u", datetime(2024, 1, 1), "1")], "source_table string, updated_at timestamp_ntz, source_key string")
    new = latest_watermark(empty, "k", "t").unionByName(
        latest_watermark(spark.createDataFrame([(9, datetime(2024, 3, 1))], "k long, updated_at timestamp_ntz"), "k", "u")
    )
    assert rows(advance_watermark(old, new)) == [("t", datetime(2024, 1, 1), "7"), ("u", datetime(2024, 3, 1), "9")]


def test_anchor_counts_sf0001(fx):
    got = changes_since(fx.payments_raw, ("2001-01-01 00:00:00", 500), "2001-06-30 00:00:00", "source_record_id").count()
    assert got == 90
    m = latest_watermark(fx.payments_raw, "source_record_id", "payments").collect()[0]
    assert (m["updated_at"], m["source_key"]) == (datetime(2001, 8, 10), "516")
