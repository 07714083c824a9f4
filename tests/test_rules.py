from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.functions.rules import Rule, classify, present, required, positive
from lakeshift.plans.silver import bronze_to_silver, split_required
from conftest import rows

T0 = datetime(2024, 1, 1)


def payment(srid, pid, mid="m1", amount="10.00", updated=T0):
    return (srid, pid, "c1", mid, Decimal(amount) if amount is not None else None, "INR", "CAPTURED", T0, T0, updated, "b")


def merchant(mid, name="n"):
    return (mid, name, "FOOD", "X", "X", "LOW", T0, T0, "b")


def test_required_is_null_or_blank(spark):
    df = spark.createDataFrame([(None,), ("",), ("  ",), (" x ",), ("x",)], "v string")
    got = rows(df.select("v", required("v").alias("r"), present("v").alias("p")))
    assert got == sorted([(None, True, False), ("", True, False), ("  ", True, False), (" x ", False, True), ("x", False, True)], key=repr)


def test_positive_rejects_null_zero_negative(spark):
    df = spark.createDataFrame([(None,), (Decimal("0.00"),), (Decimal("-1.00"),), (Decimal("0.01"),)], "a decimal(18,2)")
    assert [r[0] for r in df.select(positive("a")).collect()] == [True, True, True, False]


def test_first_matching_rule_wins(spark):
    df = spark.createDataFrame([(None, None), ("x", None), ("x", 5)], "id string, amount int")
    rules = [Rule("A", required("id")), Rule("B", F.col("amount").isNull()), Rule("C", F.col("amount") > 1)]
    assert [r[0] for r in classify(df, rules).select("rejection_reason").collect()] == ["A", "B", "C"]


def test_null_key_is_never_both_valid_and_invalid(spark):
    """Q1: a NULL key ends up only in quarantine (an anti join would keep it)."""
    df = spark.createDataFrame([merchant(None), merchant("  "), merchant("m1"), merchant("m2")], S.MERCHANTS)
    valid, invalid = split_required(df, "merchant_id", "merchants", S.MISSING_MERCHANT_ID)
    assert valid.count() == 2 and invalid.count() == 2
    assert set(invalid.select("rejection_reason", "source_table").distinct().collect()[0]) == {S.MISSING_MERCHANT_ID, "merchants"}


def test_payment_precedence_and_duplicates(spark):
    merchants = spark.createDataFrame([merchant("m1"), merchant("m1", "dup-row")], S.MERCHANTS)  # duplicated key: no fan-out (Q2)
    customers = spark.createDataFrame([("c1", "n", "e", "X", "X", T0, T0, "b")], S.CUSTOMERS)
    later = datetime(2024, 2, 1)
    payments = spark.createDataFrame(
        [
            payment(1, None, "nope", None),  # id rule first
            payment(2, "p2", "nope", "-1.00"),  # amount before merchant
            payment(3, "p3", "nope"),  # unknown merchant
            payment(4, "p4"),  # older duplicate
            payment(5, "p4", updated=later),  # newest wins
            payment(6, "p6", updated=None),  # NULL updated_at loses (nulls last) ...
            payment(7, "p6", updated=T0),
            payment(8, "p8"),  # tie on updated_at: higher id wins
            payment(9, "p8"),
        ],
        S.PAYMENTS,
    )
    settlements = spark.createDataFrame([], S.SETTLEMENTS)
    silver = bronze_to_silver(merchants, customers, payments, settlements)
    got = dict(silver.payments_flagged.select("source_record_id", "rejection_reason").collect())
    assert got == {
        1: S.MISSING_PAYMENT_ID,
        2: S.INVALID_PAYMENT_AMOUNT,
        3: S.MISSING_MERCHANT_REFERENCE,
        4: S.DUPLICATE_PAYMENT_ID,
        5: None,
        6: S.DUPLICATE_PAYMENT_ID,
        7: None,
        8: S.DUPLICATE_PAYMENT_ID,
        9: None,
    }
    assert silver.payments_valid.count() == 3


def test_settlement_precedence(spark):
    merchants = spark.createDataFrame([merchant("m1")], S.MERCHANTS)
    customers = spark.createDataFrame([], S.CUSTOMERS)
    payments = spark.createDataFrame([payment(1, "p1")], S.PAYMENTS)

    def stl(srid, sid, pid, amount="5.00"):
        return (srid, sid, pid, "m1", Decimal(amount) if amount is not None else None, "SETTLED", T0, T0, T0, "b")

    settlements = spark.createDataFrame(
        [stl(1, None, "nope", None), stl(2, "s2", "nope", "0.00"), stl(3, "s3", "nope"), stl(4, "s4", None), stl(5, "s5", "p1")], S.SETTLEMENTS
    )
    silver = bronze_to_silver(merchants, customers, payments, settlements)
    got = dict(silver.settlements_checked.select("source_record_id", "rejection_reason").collect())
    assert got == {
        1: S.MISSING_SETTLEMENT_ID,
        2: S.INVALID_SETTLEMENT_AMOUNT,
        3: S.MISSING_PAYMENT_REFERENCE,
        4: S.MISSING_PAYMENT_REFERENCE,
        5: None,
    }


def test_conservation_on_fixtures(fx):
    """R2: every raw payment is valid, invalid or a duplicate — exactly once."""
    silver = bronze_to_silver(fx.merchants_raw, fx.customers_raw, fx.payments_raw, fx.settlements_raw)
    raw = fx.payments_raw.count()
    valid, invalid, dup = silver.payments_valid.count(), silver.payments_invalid.count(), silver.payments_duplicates.count()
    assert (raw, valid, invalid, dup) == (1500, 1471, 23, 6)
    assert silver.settlements_valid.count() == 1318
