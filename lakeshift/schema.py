"""Entity schemas, keys and the fixed domain values of the migrated tables.

Money is ``DECIMAL(18,2)`` end to end; it is only cast to double at the edge of
a report so that sums stay exact at any scale.
"""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)

# ---------------------------------------------------------------------------
# These strings must equal the source system's domain values
# exactly, because rules, reports and downstream dashboards match on them.
# ---------------------------------------------------------------------------
MERCHANT_CATEGORIES = ["GROCERY", "TRAVEL", "RETAIL", "FOOD", "HEALTH", "ELECTRONICS"]
PAYMENT_STATUSES = ["CAPTURED", "AUTHORIZED", "FAILED", "REFUNDED"]
RECONCILIATION_STATUSES = ["MATCHED", "MISSING_SETTLEMENT", "UNDER_SETTLED", "OVER_SETTLED"]
SCD2_TRACKED_COLUMNS = ["merchant_name", "merchant_category", "city", "state", "risk_tier"]

MISSING_MERCHANT_ID = "MISSING_MERCHANT_ID"
MISSING_CUSTOMER_ID = "MISSING_CUSTOMER_ID"
MISSING_PAYMENT_ID = "MISSING_PAYMENT_ID"
INVALID_PAYMENT_AMOUNT = "INVALID_PAYMENT_AMOUNT"
MISSING_MERCHANT_REFERENCE = "MISSING_MERCHANT_REFERENCE"
DUPLICATE_PAYMENT_ID = "DUPLICATE_PAYMENT_ID"
MISSING_SETTLEMENT_ID = "MISSING_SETTLEMENT_ID"
INVALID_SETTLEMENT_AMOUNT = "INVALID_SETTLEMENT_AMOUNT"
MISSING_PAYMENT_REFERENCE = "MISSING_PAYMENT_REFERENCE"

MATCH_TOLERANCE = "0.01"
# ---------------------------------------------------------------------------

MERCHANTS = T.StructType(
    [
        T.StructField("merchant_id", T.StringType()),
        T.StructField("merchant_name", T.StringType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("risk_tier", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("source_batch_id", T.StringType()),
    ]
)

CUSTOMERS = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("city", T.StringType()),
        T.StructField("state", T.StringType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("source_batch_id", T.StringType()),
    ]
)

PAYMENTS = T.StructType(
    [
        T.StructField("source_record_id", T.LongType()),
        T.StructField("payment_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("payment_amount", MONEY),
        T.StructField("currency", T.StringType()),
        T.StructField("payment_status", T.StringType()),
        T.StructField("payment_timestamp", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("source_batch_id", T.StringType()),
    ]
)

SETTLEMENTS = T.StructType(
    [
        T.StructField("source_record_id", T.LongType()),
        T.StructField("settlement_id", T.StringType()),
        T.StructField("payment_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("settlement_amount", MONEY),
        T.StructField("settlement_status", T.StringType()),
        T.StructField("settlement_timestamp", T.TimestampNTZType()),
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
        T.StructField("source_batch_id", T.StringType()),
    ]
)

# Business key and extraction (high-water) key of every source table.
ENTITIES = {
    "merchants": {"schema": MERCHANTS, "key": "merchant_id", "extract_key": "merchant_id"},
    "customers": {"schema": CUSTOMERS, "key": "customer_id", "extract_key": "customer_id"},
    "payments": {"schema": PAYMENTS, "key": "payment_id", "extract_key": "source_record_id"},
    "settlements": {"schema": SETTLEMENTS, "key": "settlement_id", "extract_key": "source_record_id"},
}


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
