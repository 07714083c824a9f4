"""Payment-to-settlement reconciliation and its aggregates."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift import schema as S


def settlement_totals(settlements: DataFrame) -> DataFrame:
    """Per payment: settled amount, settlement count, latest settlement (A1).

    Pre-aggregating before the join keeps the join 1:1 (no fan-out) and lets
    the partial aggregate absorb hot payment ids map-side.
    """
    return settlements.groupBy("payment_id").agg(
        F.sum("settlement_amount").alias("settled_amount"),
        F.count("settlement_id").alias("settlement_record_count"),
        F.max("settlement_timestamp").alias("latest_settlement_timestamp"),
    )


def recon_status(difference: Column, count: Column, tolerance: str = S.MATCH_TOLERANCE) -> Column:
    """Status by precedence (P11): no settlement -> MISSING; within tolerance ->
    MATCHED; positive difference -> UNDER; otherwise OVER."""
    return (
        F.when(count == 0, "MISSING_SETTLEMENT")
        .when(F.abs(difference) <= F.lit(Decimal(tolerance)), "MATCHED")
        .when(difference > 0, "UNDER_SETTLED")
        .otherwise("OVER_SETTLED")
    )


def reconcile(payments: DataFrame, settlements: DataFrame, tolerance: str = S.MATCH_TOLERANCE) -> DataFrame:
    """Payment reconciliation (R1): every payment with its settled totals,
    difference (exact decimal) and status."""
    totals = settlement_totals(settlements)
    joined = payments.join(totals, "payment_id", "left")
    settled = F.coalesce(F.col("settled_amount"), F.lit(0).cast(S.MONEY))
    count = F.coalesce(F.col("settlement_record_count"), F.lit(0).cast("long"))
    out = joined.withColumn("settled_amount", settled).withColumn("settlement_record_count", count)
    out = out.withColumn("reconciliation_difference", F.col("payment_amount") - F.col("settled_amount"))
    return out.withColumn(
        "reconciliation_status",
        recon_status(F.col("reconciliation_difference"), F.col("settlement_record_count"), tolerance),
    )


def merchant_daily_metrics(recon: DataFrame) -> DataFrame:
    """Per (business_date, merchant, currency) payment and settlement health (A2).

    No status filter: failed/refunded payments are in gross; over-settled is
    not counted; unsettled may be negative.
    """
    status = F.col("reconciliation_status")
    return (
        recon.groupBy(F.to_date("payment_timestamp").alias("business_date"), "merchant_id", "currency")
        .agg(
            F.count("payment_id").alias("payment_count"),
            F.sum("payment_amount").alias("gross_payment_amount"),
            F.sum("settled_amount").alias("settled_amount"),
            F.count_if(status == "MISSING_SETTLEMENT").alias("missing_settlement_count"),
            F.count_if(status == "UNDER_SETTLED").alias("under_settled_count"),
        )
        .withColumn("unsettled_amount", F.col("gross_payment_amount") - F.col("settled_amount"))
    )


def reconciliation_summary(recon: DataFrame, run_id: str | None = None, as_of=None) -> DataFrame:
    """Per status: payments, amount, settled, net difference (A3)."""
    out = recon.groupBy("reconciliation_status").agg(
        F.count("payment_id").alias("payment_count"),
        F.sum("payment_amount").alias("payment_amount"),
        F.sum("settled_amount").alias("settled_amount"),
        F.sum("reconciliation_difference").alias("net_difference"),
    )
    if run_id is not None:
        out = out.withColumn("run_id", F.lit(run_id))
    if as_of is not None:
        out = out.withColumn("generated_at", F.lit(as_of).cast("timestamp"))
    return out


def target_totals(recon: DataFrame) -> DataFrame:
    """Global target totals (A4): one row."""
    return recon.agg(
        F.count("payment_id").alias("valid_payment_count"),
        F.coalesce(F.sum("payment_amount"), F.lit(0).cast(S.MONEY)).alias("valid_payment_amount"),
        F.coalesce(F.sum("settled_amount"), F.lit(0).cast(S.MONEY)).alias("settled_amount"),
    )


def month_partitions(df: DataFrame, date_column: str) -> DataFrame:
    """``partition_year`` / ``partition_month`` publication columns."""
    return df.withColumn("partition_year", F.year(date_column)).withColumn("partition_month", F.month(date_column))


def top_merchants(daily: DataFrame, year: int, month: int, n: int = 10) -> DataFrame:
    """Top merchants by payments in one month (A12/L4); merchant id breaks ties.

    On a published table the filter is on the partition columns, so the scan
    prunes to a single year/month directory; elsewhere it is a range of dates,
    which reaches the scan that the dates come from.
    """
    if "partition_year" in daily.columns:
        wanted = (F.col("partition_year") == year) & (F.col("partition_month") == month)
    else:
        first, after = F.make_date(F.lit(year), F.lit(month), F.lit(1)), F.make_date(F.lit(year + month // 12), F.lit(month % 12 + 1), F.lit(1))
        wanted = (F.col("business_date") >= first) & (F.col("business_date") < after)
    return (
        daily.filter(wanted)
        .groupBy("merchant_id")
        .agg(F.sum("payment_count").alias("payment_count"))
        .orderBy(F.col("payment_count").desc(), F.col("merchant_id"))
        .limit(n)
    )
