"""Bronze -> Silver (X1): validate, deduplicate, quarantine.

``bronze_to_silver`` is lazy and returns every output as a DataFrame. The
payment flags (rejection reason + survivor flag) are the one intermediate that
feeds several outputs; ``plans.jobs.bronze_to_silver_job`` writes it once to a staged table under
the shared checkpoint folder and derives every payment output from that table,
so the source is scanned once and the lineage is cut on shared storage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.functions.rules import Rule, classify, positive, present, quarantine, required
from lakeshift.operators.dedup import flag_latest, flag_latest_sparse
from lakeshift.operators.joins import flag_exists, orphans


def payment_rules(merchant_flag: str = "merchant_exists") -> list[Rule]:
    return [
        Rule(S.MISSING_PAYMENT_ID, required("payment_id")),
        Rule(S.INVALID_PAYMENT_AMOUNT, positive("payment_amount")),
        Rule(S.MISSING_MERCHANT_REFERENCE, ~F.col(merchant_flag)),
    ]


def settlement_rules(payment_flag: str = "payment_exists") -> list[Rule]:
    return [
        Rule(S.MISSING_SETTLEMENT_ID, required("settlement_id")),
        Rule(S.INVALID_SETTLEMENT_AMOUNT, positive("settlement_amount")),
        Rule(S.MISSING_PAYMENT_REFERENCE, ~F.col(payment_flag)),
    ]


def split_required(df: DataFrame, key: str, table: str, reason: str) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) by the required-key rule. A filter, not an anti join,
    so a NULL key can never end up in both outputs (Q1)."""
    return df.filter(present(key)), quarantine(df.filter(required(key)), table, reason)


def check_payments(payments: DataFrame, merchants_valid: DataFrame) -> DataFrame:
    """Payments + first-match ``rejection_reason`` (before duplicate ranking)."""
    return classify(flag_exists(payments, "merchant_id", merchants_valid, "merchant_id", "merchant_exists"), payment_rules()).drop("merchant_exists")


def accepted() -> Column:
    """Rows that passed every rule (no rejection reason yet)."""
    return F.col("rejection_reason").isNull()


def classify_payments(payments: DataFrame, merchants_valid: DataFrame, dup_keys: DataFrame | None = None) -> DataFrame:
    """Payments + ``rejection_reason`` (first match) + ``is_latest`` survivor flag.

    Only accepted rows are ranked, so NULL/blank ids never share a window key.
    ``dup_keys``: the (size-checked) ids that repeat among accepted rows; when
    given, only their rows are ranked and shuffled (``flag_latest_sparse``).
    """
    checked = check_payments(payments, merchants_valid)
    if dup_keys is None:
        flagged = flag_latest(checked, "payment_id", eligible=accepted())
    else:
        flagged = flag_latest_sparse(checked, "payment_id", dup_keys, eligible=accepted())
    return flagged.withColumn(
        "rejection_reason",
        F.when(F.col("rejection_reason").isNull() & ~F.col("is_latest"), F.lit(S.DUPLICATE_PAYMENT_ID)).otherwise(F.col("rejection_reason")),
    )


def orphan_keys(settlements: DataFrame, payments_valid: DataFrame) -> DataFrame:
    """The distinct payment ids of settlements that no valid payment has; only ids are shuffled."""
    return orphans(settlements.select("payment_id").where(F.col("payment_id").isNotNull()).distinct(), "payment_id", payments_valid, "payment_id")


def classify_settlements(settlements: DataFrame, payments_valid: DataFrame, unknown: DataFrame | None = None) -> DataFrame:
    """Settlements + first-match ``rejection_reason``.

    ``unknown``: the (size-checked) ``orphan_keys``, which are few as a rule; when
    given, they are broadcast and the settlements are not shuffled.
    """
    if unknown is None:
        flagged = flag_exists(settlements, "payment_id", payments_valid, "payment_id", "payment_exists", unique=True)
    else:
        flagged = flag_exists(settlements, "payment_id", unknown, "payment_id", "payment_unknown", unique=True)
        flagged = flagged.withColumn("payment_exists", F.col("payment_id").isNotNull() & ~F.col("payment_unknown")).drop("payment_unknown")
    return classify(flagged, settlement_rules()).drop("payment_exists")


@dataclass
class Silver:
    merchants_valid: DataFrame
    merchants_invalid: DataFrame
    customers_valid: DataFrame
    customers_invalid: DataFrame
    payments_flagged: DataFrame
    settlements_checked: DataFrame

    @property
    def payments_valid(self) -> DataFrame:
        return self.payments_flagged.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.PAYMENTS))

    @property
    def payments_invalid(self) -> DataFrame:
        return quarantine(
            self.payments_flagged.filter(F.col("rejection_reason").isNotNull() & (F.col("rejection_reason") != S.DUPLICATE_PAYMENT_ID)).select(
                *S.columns(S.PAYMENTS), "rejection_reason"
            ),
            "payments",
        )

    @property
    def payments_duplicates(self) -> DataFrame:
        return quarantine(
            self.payments_flagged.filter(F.col("rejection_reason") == S.DUPLICATE_PAYMENT_ID).select(*S.columns(S.PAYMENTS), "rejection_reason"),
            "payments",
        )

    @property
    def payments_silver(self) -> DataFrame:
        return self.payments_valid.withColumn("payment_date", F.to_date("payment_timestamp"))

    @property
    def settlements_valid(self) -> DataFrame:
        return self.settlements_checked.filter(F.col("rejection_reason").isNull()).drop("rejection_reason")

    @property
    def settlements_silver(self) -> DataFrame:
        return self.settlements_valid.withColumn("settlement_date", F.to_date("settlement_timestamp"))

    @property
    def settlements_invalid(self) -> DataFrame:
        return quarantine(self.settlements_checked.filter(F.col("rejection_reason").isNotNull()), "settlements")

    def quarantine_union(self) -> DataFrame:
        """All rejected rows in one schema (Q9): table, reason, key, lineage."""

        def view(df: DataFrame, key: str) -> DataFrame:
            srid = F.col("source_record_id") if "source_record_id" in df.columns else F.lit(None).cast("long")
            return df.select(
                "source_table", "rejection_reason", F.col(key).alias("record_key"), srid.alias("source_record_id"), "source_batch_id"
            )

        parts = [
            view(self.merchants_invalid, "merchant_id"),
            view(self.customers_invalid, "customer_id"),
            view(quarantine(self.payments_flagged.filter(F.col("rejection_reason").isNotNull()), "payments"), "payment_id"),
            view(self.settlements_invalid, "settlement_id"),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    def quality_report(self) -> DataFrame:
        """Row counts per output in long form ``(section, name, value)``.

        One aggregation pass per source table instead of one job per count.
        """
        reason = F.col("rejection_reason")
        parts = [
            self.merchants_valid.agg(F.count(F.lit(1)).alias("v")).select(F.lit("valid_rows").alias("section"), F.lit("merchants").alias("name"), "v"),
            self.customers_valid.agg(F.count(F.lit(1)).alias("v")).select(F.lit("valid_rows").alias("section"), F.lit("customers").alias("name"), "v"),
            self.merchants_invalid.agg(F.count(F.lit(1)).alias("v")).select(F.lit("quarantined_rows").alias("section"), F.lit("merchants").alias("name"), "v"),
            self.customers_invalid.agg(F.count(F.lit(1)).alias("v")).select(F.lit("quarantined_rows").alias("section"), F.lit("customers").alias("name"), "v"),
            _counts(
                self.payments_flagged,
                [
                    ("valid_rows", "payments", reason.isNull()),
                    ("quarantined_rows", "payments_invalid", reason.isNotNull() & (reason != S.DUPLICATE_PAYMENT_ID)),
                    ("quarantined_rows", "payments_duplicates", reason == S.DUPLICATE_PAYMENT_ID),
                ],
            ),
            _counts(
                self.settlements_checked,
                [("valid_rows", "settlements", reason.isNull()), ("quarantined_rows", "settlements", reason.isNotNull())],
            ),
        ]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out.withColumnRenamed("v", "value")


def _counts(df: DataFrame, entries: list[tuple[str, str, object]]) -> DataFrame:
    """Several conditional counts in one pass, unpivoted to (section, name, v)."""
    wide = df.agg(*[F.count_if(cond).alias(f"_c{i}") for i, (_, _, cond) in enumerate(entries)])
    rows = [F.struct(F.lit(s).alias("section"), F.lit(n).alias("name"), F.col(f"_c{i}").alias("v")) for i, (s, n, _) in enumerate(entries)]
    return wide.select(F.explode(F.array(*rows)).alias("_r")).select("_r.section", "_r.name", "_r.v")


def bronze_to_silver(merchants: DataFrame, customers: DataFrame, payments: DataFrame, settlements: DataFrame) -> Silver:
    merchants_valid, merchants_invalid = split_required(merchants, "merchant_id", "merchants", S.MISSING_MERCHANT_ID)
    customers_valid, customers_invalid = split_required(customers, "customer_id", "customers", S.MISSING_CUSTOMER_ID)
    flagged = classify_payments(payments, merchants_valid)
    payments_valid = flagged.filter(F.col("rejection_reason").isNull()).select(*S.columns(S.PAYMENTS))
    return Silver(
        merchants_valid=merchants_valid,
        merchants_invalid=merchants_invalid,
        customers_valid=customers_valid,
        customers_invalid=customers_invalid,
        payments_flagged=flagged,
        settlements_checked=classify_settlements(settlements, payments_valid),
    )
