"""Incremental merge of a Bronze change batch into a new Silver snapshot.

Dependency order matters: merchants are merged first, so a payment for a
brand-new merchant is valid; payments next, so a settlement for a brand-new
payment is valid (J3). Absent change tables are empty frames with the schema
(Q7), never ``None``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.functions.rules import classify, present, quarantine, required
from lakeshift.operators.dedup import flag_latest, latest_by_key
from lakeshift.operators.joins import flag_exists
from lakeshift.operators.upsert import upsert_latest, upsert_replace
from lakeshift.plans.silver import _counts, payment_rules, settlement_rules


@dataclass
class Merge:
    merchants_changes: DataFrame
    payments_changes: DataFrame
    settlements_changes: DataFrame
    merchants_merged: DataFrame
    customers_merged: DataFrame
    payments_flagged: DataFrame  # increment rows + rejection_reason (incl. in-batch superseded)
    payments_merged: DataFrame
    settlements_checked: DataFrame
    settlements_merged: DataFrame
    merchants_rejected: DataFrame

    @property
    def payments_rejected(self) -> DataFrame:
        return quarantine(self.payments_flagged.filter(F.col("rejection_reason").isNotNull()), "payments")

    @property
    def settlements_rejected(self) -> DataFrame:
        return quarantine(self.settlements_checked.filter(F.col("rejection_reason").isNotNull()), "settlements")

    def report(self) -> DataFrame:
        """Incremental / merged / quarantined row counts, long form."""
        reason = F.col("rejection_reason")

        def rows(df: DataFrame, section: str, name: str, cond=None) -> DataFrame:
            v = F.count(F.lit(1)) if cond is None else F.count_if(cond)
            return df.agg(v.alias("value")).select(F.lit(section).alias("section"), F.lit(name).alias("name"), "value")

        parts = [
            rows(self.merchants_changes, "incremental_rows", "merchants"),
            rows(self.payments_changes, "incremental_rows", "payments"),
            rows(self.settlements_changes, "incremental_rows", "settlements"),
            rows(self.merchants_merged, "merged_rows", "merchants"),
            rows(self.customers_merged, "merged_rows", "customers"),
            rows(self.payments_merged, "merged_rows", "payments"),
            rows(self.settlements_merged, "merged_rows", "settlements"),
            rows(self.merchants_rejected, "quarantined_rows", "merchants"),
            _counts(
                self.payments_flagged,
                [
                    ("quarantined_rows", "payments", reason.isNotNull() & (reason != S.DUPLICATE_PAYMENT_ID)),
                    ("quarantined_rows", "payments_superseded", reason == S.DUPLICATE_PAYMENT_ID),
                ],
            ).withColumnRenamed("v", "value"),
            rows(self.settlements_checked, "quarantined_rows", "settlements", reason.isNotNull()),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out


def merge_merchants(base: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged merchants, rejected changes): change always wins."""
    rejected = quarantine(changes.filter(required("merchant_id")), "merchants", S.MISSING_MERCHANT_ID)
    return upsert_replace(base, changes.filter(present("merchant_id")), "merchant_id", ("updated_at",)), rejected


def validate_payment_changes(changes: DataFrame, merchants: DataFrame) -> DataFrame:
    """Increment rows + rejection reason against the merged merchants; in-batch
    losers are flagged as duplicates (Q8)."""
    checked = classify(flag_exists(changes, "merchant_id", merchants, "merchant_id", "merchant_exists"), payment_rules()).drop("merchant_exists")
    return flag_latest(checked, "payment_id", eligible=F.col("rejection_reason").isNull()).withColumn(
        "rejection_reason",
        F.when(F.col("rejection_reason").isNull() & ~F.col("is_latest"), F.lit(S.DUPLICATE_PAYMENT_ID)).otherwise(F.col("rejection_reason")),
    )


def validate_settlement_changes(changes: DataFrame, payments: DataFrame) -> DataFrame:
    """Increment rows + rejection reason against the merged payments."""
    return classify(
        flag_exists(changes, "payment_id", payments, "payment_id", "payment_exists", unique=True), settlement_rules()
    ).drop("payment_exists")


def merge_payments(base: DataFrame, changes: DataFrame, merchants: DataFrame, stored_base: bool = False) -> tuple[DataFrame, DataFrame]:
    """(merged payments, flagged changes): validated against the *merged*
    merchants; newest wins (U2); in-batch losers are flagged as duplicates (Q8).

    ``stored_base``: the base is a stored Silver snapshot (unique per
    payment_id by construction), so only the changed keys are re-ranked; see
    ``upsert_latest(base_unique=True)``. Leave it off when the base is itself
    a lazy plan, which the key-scoped form would evaluate twice.
    """
    flagged = validate_payment_changes(changes, merchants)
    current = flagged.filter(F.col("rejection_reason").isNull()).select(*base.columns)
    return upsert_latest(base, current, "payment_id", base_unique=stored_base), flagged


def merge_settlements(base: DataFrame, changes: DataFrame, payments: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(merged settlements, checked changes): validated against the merged
    payments; newest wins (U3)."""
    checked = validate_settlement_changes(changes, payments)
    candidates = checked.filter(F.col("rejection_reason").isNull()).select(*base.columns)
    return latest_by_key(base.unionByName(candidates), "settlement_id"), checked


def merge_increment(
    base_merchants: DataFrame,
    base_customers: DataFrame,
    base_payments: DataFrame,
    base_settlements: DataFrame,
    merchant_changes: DataFrame,
    payment_changes: DataFrame,
    settlement_changes: DataFrame,
    customer_changes: DataFrame | None = None,
) -> Merge:
    """Base Silver tables (without date columns) + change batches -> merged Silver."""
    merchants_merged, merchants_rejected = merge_merchants(base_merchants, merchant_changes)
    # Customers: pass-through for parity (Q6); newest-wins when changes are given.
    customers_merged = base_customers
    if customer_changes is not None:
        customers_merged = latest_by_key(base_customers.unionByName(customer_changes.filter(present("customer_id"))), "customer_id", ("updated_at",))
    payments_merged, payments_flagged = merge_payments(base_payments, payment_changes, merchants_merged)
    settlements_merged, settlements_checked = merge_settlements(base_settlements, settlement_changes, payments_merged)
    return Merge(
        merchants_changes=merchant_changes,
        payments_changes=payment_changes,
        settlements_changes=settlement_changes,
        merchants_merged=merchants_merged,
        customers_merged=customers_merged,
        payments_flagged=payments_flagged,
        payments_merged=payments_merged,
        settlements_checked=settlements_checked,
        settlements_merged=settlements_merged,
        merchants_rejected=merchants_rejected,
    )
