"""Fixture derivation pinned to the anchor counts of FIXTURES.md (sf0.001)."""

from decimal import Decimal

from pyspark.sql import functions as F

from lakeshift.plans.merge import merge_increment
from lakeshift.plans.silver import bronze_to_silver


def test_entity_counts(fx):
    got = {n: getattr(fx, n).count() for n in ["merchants_raw", "customers_raw", "payments_raw", "settlements_raw", "payments_inc", "merchants_inc", "settlements_inc"]}
    assert got == {
        "merchants_raw": 12,
        "customers_raw": 152,
        "payments_raw": 1500,
        "settlements_raw": 1335,
        "payments_inc": 98,
        "merchants_inc": 6,
        "settlements_inc": 75,
    }


def test_silver_and_merge_anchors(fx):
    s = bronze_to_silver(fx.merchants_raw, fx.customers_raw, fx.payments_raw, fx.settlements_raw)
    reasons = {r[0]: r[1] for r in s.payments_flagged.groupBy("rejection_reason").count().collect()}
    assert reasons == {None: 1471, "MISSING_PAYMENT_ID": 8, "INVALID_PAYMENT_AMOUNT": 9, "MISSING_MERCHANT_REFERENCE": 6, "DUPLICATE_PAYMENT_ID": 6}
    assert s.payments_valid.agg(F.sum("payment_amount")).collect()[0][0] == Decimal("368207244.53")
    sreasons = {r[0]: r[1] for r in s.settlements_checked.groupBy("rejection_reason").count().collect()}
    assert sreasons == {None: 1318, "MISSING_SETTLEMENT_ID": 3, "INVALID_SETTLEMENT_AMOUNT": 3, "MISSING_PAYMENT_REFERENCE": 11}
    m = merge_increment(s.merchants_valid, s.customers_valid, s.payments_valid, s.settlements_valid, fx.merchants_inc, fx.payments_inc, fx.settlements_inc)
    assert m.payments_merged.count() == 1478 and m.settlements_merged.count() == 1328 and m.merchants_merged.count() == 11
    assert m.payments_merged.agg(F.sum("payment_amount")).collect()[0][0] == Decimal("370310325.13")
    assert m.settlements_merged.agg(F.sum("settlement_amount")).collect()[0][0] == Decimal("333033163.55")


def test_ids_of_the_increment_never_meet_those_of_the_base(spark):
    from lakeshift.testing.fixtures import Fixtures

    large = Fixtures.__new__(Fixtures)
    large.spark = spark
    for top, step in ((5, 10_000_000), (9_999_999, 10_000_000), (10_000_000, 100_000_000), (123_456_789, 1_000_000_000)):
        large.__dict__.pop("id_step", None)
        large.__dict__["payments_raw"] = spark.createDataFrame([(1,), (top,)], "source_record_id long")
        assert spark.range(1).select(large.id_step.alias("s")).first()["s"] == step > top
