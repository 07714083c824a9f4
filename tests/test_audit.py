from datetime import datetime
from decimal import Decimal


from lakeshift import schema as S
from lakeshift.operators import expectations as E
from lakeshift.operators import reconcile as R
from lakeshift.plans.audit import failure_metrics, pipeline_metrics
from conftest import rows

T0 = datetime(2024, 1, 1)


def test_reconciliation_status_precedence(spark):
    pay = spark.createDataFrame(
        [(i, f"p{i}", "c", "m", Decimal("10.00"), "INR", "CAPTURED", T0, T0, T0, "b") for i in range(5)],
        S.PAYMENTS,
    )
    stl = spark.createDataFrame(
        [
            (1, "s1", "p1", "m", Decimal("9.99"), "SETTLED", T0, T0, T0, "b"),  # within tolerance
            (2, "s2", "p2", "m", Decimal("9.00"), "SETTLED", T0, T0, T0, "b"),  # under
            (3, "s3", "p3", "m", Decimal("6.00"), "SETTLED", T0, T0, T0, "b"),  # two settlements -> over
            (4, "s4", "p3", "m", Decimal("6.00"), "SETTLED", T0, T0, T0, "b"),
            (5, "s5", "p4", "m", Decimal("10.00"), "SETTLED", T0, T0, T0, "b"),
        ],
        S.SETTLEMENTS,
    )
    got = dict(R.reconcile(pay, stl).select("payment_id", "reconciliation_status").collect())
    assert got == {"p0": "MISSING_SETTLEMENT", "p1": "MATCHED", "p2": "UNDER_SETTLED", "p3": "OVER_SETTLED", "p4": "MATCHED"}
    rec = R.reconcile(pay, stl)
    daily = R.merchant_daily_metrics(rec).collect()[0]
    assert daily["payment_count"] == 5 and daily["gross_payment_amount"] == Decimal("50.00")
    assert daily["settled_amount"] == Decimal("40.99") and daily["unsettled_amount"] == Decimal("9.01")
    assert daily["missing_settlement_count"] == 1 and daily["under_settled_count"] == 1


def test_expectation_semantics(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None), (None, 3), (None, 4)], "k string, v int")
    res = {r["expectation"]: r for r in E.run_expectations(df, "d", [E.not_null("k"), E.unique("k"), E.between("v", 2, 3), E.in_set("k", ["a"])]).collect()}
    assert res["expect_column_values_to_not_be_null"]["unexpected_count"] == 2
    assert res["expect_column_values_to_be_unique"]["unexpected_count"] == 2  # both 'a'; NULLs ignored
    assert res["expect_column_values_to_be_between"]["unexpected_count"] == 2  # 1 and 4; NULL ignored
    assert res["expect_column_values_to_be_in_set"]["unexpected_count"] == 1  # 'b'; NULL ignored
    verdict = E.suite_verdict(E.run_expectations(df, "d", [E.in_set("k", ["a", "b"])])).collect()
    assert {r["suite_status"] for r in verdict} == {"PASSED"}


def _quality(spark, valid, quarantined):
    data = [("valid_rows", k, v) for k, v in valid.items()] + [("quarantined_rows", k, v) for k, v in quarantined.items()]
    return spark.createDataFrame(data, "section string, name string, value long")


def test_metrics_from_aggregate_reports(spark):
    """Reference unit case 1: two datasets valid {2, 8}, quarantine {1, 2}."""
    quality = _quality(spark, {"merchants": 2, "payments": 8}, {"payments_invalid": 1, "payments_duplicates": 2})
    recon = spark.createDataFrame([("PASSED", 8)], "status string, valid_payment_count long")
    got = dict(pipeline_metrics(quality, recon).select("metric_name", "value").collect())
    assert got == {
        "PipelineSuccess": 1,
        "RecordsProcessed": 10,
        "ValidPayments": 8,
        "QuarantinedRecords": 3,
        "ReconciliationPassed": 1,
        "QualityChecksCompleted": 1,
    }


def test_metrics_mark_failed_reconciliation(spark):
    """Reference unit case 2: FAILED reconciliation, empty quarantine map."""
    quality = _quality(spark, {"payments": 1}, {})
    recon = spark.createDataFrame([("FAILED", 1)], "status string, valid_payment_count long")
    got = dict(pipeline_metrics(quality, recon).select("metric_name", "value").collect())
    assert got["PipelineSuccess"] == 0 and got["ReconciliationPassed"] == 0 and got["QuarantinedRecords"] == 0
    assert rows(failure_metrics(spark), "metric_name", "value") == [("PipelineSuccess", 0)]
