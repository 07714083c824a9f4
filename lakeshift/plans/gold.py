"""Silver -> Gold (X3): reconciliation, merchant daily metrics, summary, SCD2 seed."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.operators import reconcile as R
from lakeshift.operators.scd2 import scd2_init


@dataclass
class Gold:
    payment_reconciliation: DataFrame
    merchant_daily_metrics: DataFrame
    merchant_scd2: DataFrame
    reconciliation_summary: DataFrame

    def report(self) -> DataFrame:
        """Row counts and status counts in long form (A10)."""

        def rows(df: DataFrame, name: str) -> DataFrame:
            return df.agg(F.count(F.lit(1)).alias("value")).select(F.lit("gold_rows").alias("section"), F.lit(name).alias("name"), "value")

        status = self.reconciliation_summary.select(
            F.lit("reconciliation_status_counts").alias("section"), F.col("reconciliation_status").alias("name"), F.col("payment_count").alias("value")
        )
        return (
            rows(self.payment_reconciliation, "payment_reconciliation")
            .unionByName(rows(self.merchant_daily_metrics, "merchant_daily_metrics"))
            .unionByName(rows(self.merchant_scd2, "merchant_scd2"))
            .unionByName(status)
        )


def silver_to_gold(merchants: DataFrame, payments: DataFrame, settlements: DataFrame, run_id: str | None = None, as_of=None) -> Gold:
    recon = R.reconcile(payments, settlements)
    if as_of is not None:
        recon = recon.withColumn("reconciled_at", F.lit(as_of).cast("timestamp"))
    return Gold(
        payment_reconciliation=recon,
        merchant_daily_metrics=R.merchant_daily_metrics(recon),
        merchant_scd2=scd2_init(merchants),
        reconciliation_summary=R.reconciliation_summary(recon, run_id, as_of),
    )
