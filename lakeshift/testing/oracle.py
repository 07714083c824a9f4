"""DuckDB SQL oracle: the fixture derivation and every registered query, in SQL.

``FIXTURES`` mirrors ``lakeshift.testing.fixtures``; ``SILVER``..``HISTORY``
chain the reference semantics as plain CTEs. Each oracle query is
``WITH <all CTEs> <final select>``; DuckDB inlines only what the final select
references. Money leaves every query as DOUBLE (exact decimal inside).
"""

from __future__ import annotations

PAY_COLS = (
    "source_record_id, payment_id, customer_id, merchant_id, payment_amount, currency, payment_status, "
    "payment_timestamp, created_at, updated_at, source_batch_id"
)
STL_COLS = (
    "source_record_id, settlement_id, payment_id, merchant_id, settlement_amount, settlement_status, "
    "settlement_timestamp, created_at, updated_at, source_batch_id"
)
MRC_COLS = "merchant_id, merchant_name, merchant_category, city, state, risk_tier, created_at, updated_at, source_batch_id"
CUS_COLS = "customer_id, customer_name, email, city, state, created_at, updated_at, source_batch_id"


def _pad(prefix: str, expr: str, width: int) -> str:
    return f"'{prefix}' || lpad(CAST({expr} AS VARCHAR), CAST(greatest(length(CAST({expr} AS VARCHAR)), {width}) AS INTEGER), '0')"


def _days(expr: str) -> str:
    return f"to_days(CAST({expr} AS INTEGER))"


M = "CAST({} AS DECIMAL(18,2))"

FIXTURES = f"""
geo AS (
  SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey
),
merchants_raw AS (
  SELECT {_pad('mrc_', 's_suppkey + 1', 6)} AS merchant_id,
         s_name AS merchant_name,
         ['GROCERY','TRAVEL','RETAIL','FOOD','HEALTH','ELECTRONICS'][CAST(s_suppkey % 6 AS INTEGER) + 1] AS merchant_category,
         n_name AS city, r_name AS state,
         CASE WHEN s_suppkey % 20 = 0 THEN 'HIGH' WHEN s_suppkey % 20 < 5 THEN 'MEDIUM' ELSE 'LOW' END AS risk_tier,
         TIMESTAMP '1993-01-01' + {_days('s_suppkey % 365')} AS created_at,
         TIMESTAMP '1994-01-01' + {_days('s_suppkey % 90')} AS updated_at,
         'seed_001' AS source_batch_id
  FROM supplier JOIN geo ON s_nationkey = n_nationkey
  UNION ALL SELECT NULL, 'bad', 'FOOD', 'X', 'X', 'LOW', TIMESTAMP '1993-01-01', TIMESTAMP '1994-01-01', 'seed_001'
  UNION ALL SELECT '  ', 'bad', 'FOOD', 'X', 'X', 'LOW', TIMESTAMP '1993-01-01', TIMESTAMP '1994-01-01', 'seed_001'
),
customers_raw AS (
  SELECT {_pad('cus_', 'c_custkey + 1', 8)} AS customer_id,
         c_name AS customer_name,
         {_pad('customer', 'c_custkey + 1', 8)} || '@example.test' AS email,
         n_name AS city, r_name AS state,
         TIMESTAMP '1993-01-01' + {_days('c_custkey % 365')} AS created_at,
         TIMESTAMP '1994-01-01' + {_days('c_custkey % 90')} AS updated_at,
         'seed_001' AS source_batch_id
  FROM customer JOIN geo ON c_nationkey = n_nationkey
  UNION ALL SELECT NULL, 'bad', 'x', 'X', 'X', TIMESTAMP '1993-01-01', TIMESTAMP '1994-01-01', 'seed_001'
  UNION ALL SELECT '  ', 'bad', 'x', 'X', 'X', TIMESTAMP '1993-01-01', TIMESTAMP '1994-01-01', 'seed_001'
),
payments_raw AS (
  SELECT o_orderkey AS source_record_id,
         CASE WHEN o_orderkey % 400 = 11 THEN NULL
              WHEN o_orderkey % 400 = 12 THEN '  '
              WHEN o_orderkey > 0 AND o_orderkey % 100 = 0 THEN {_pad('pay_', 'o_orderkey - 1', 10)}
              ELSE {_pad('pay_', 'o_orderkey', 10)} END AS payment_id,
         {_pad('cus_', 'o_custkey + 1', 8)} AS customer_id,
         CASE WHEN o_orderkey % 200 = 0 THEN 'mrc_missing'
              ELSE {_pad('mrc_', 'o_custkey % (SELECT count(*) FROM supplier) + 1', 6)} END AS merchant_id,
         CASE WHEN o_orderkey % 250 = 0 THEN -{M.format('o_totalprice')}
              WHEN o_orderkey % 500 = 31 THEN NULL
              ELSE {M.format('o_totalprice')} END AS payment_amount,
         'INR' AS currency,
         CASE WHEN o_orderkey % 100 < 80 THEN 'CAPTURED' WHEN o_orderkey % 100 < 90 THEN 'AUTHORIZED'
              WHEN o_orderkey % 100 < 97 THEN 'FAILED' ELSE 'REFUNDED' END AS payment_status,
         o_orderdate AS payment_timestamp,
         o_orderdate AS created_at,
         o_orderdate + {_days('o_orderkey % 11')} AS updated_at,
         'seed_001' AS source_batch_id
  FROM orders
),
settlements_raw AS (
  SELECT source_record_id,
         CASE WHEN source_record_id % 500 = 21 THEN NULL ELSE {_pad('stl_', 'source_record_id', 10)} END AS settlement_id,
         CASE WHEN source_record_id % 500 = 24 THEN 'pay_unknown' ELSE payment_id END AS payment_id,
         merchant_id,
         CASE WHEN source_record_id % 500 = 22 THEN {M.format('0')}
              WHEN source_record_id % 50 = 7 THEN {M.format('ROUND(payment_amount * CAST(0.95 AS DECIMAL(3,2)), 2)')}
              ELSE payment_amount END AS settlement_amount,
         'SETTLED' AS settlement_status,
         payment_timestamp + {_days('1 + source_record_id % 14 + CASE WHEN source_record_id % 50 = 9 THEN 45 ELSE 0 END')} AS settlement_timestamp,
         payment_timestamp AS created_at,
         payment_timestamp + {_days('2 + source_record_id % 14')} AS updated_at,
         'seed_001' AS source_batch_id
  FROM payments_raw
  WHERE payment_amount > 0 AND merchant_id <> 'mrc_missing' AND source_record_id % 10 <> 3
),
id_step AS (
  SELECT GREATEST(10000000, CAST(rpad('1', CAST(length(CAST(max(source_record_id) AS VARCHAR)) + 1 AS INTEGER), '0') AS BIGINT)) AS step FROM payments_raw
),
payments_inc AS (
  SELECT source_record_id + (SELECT step FROM id_step) AS source_record_id, payment_id, customer_id, merchant_id,
         {M.format('payment_amount + 10')} AS payment_amount, currency, payment_status, payment_timestamp, created_at,
         updated_at + {_days('CASE WHEN source_record_id % 40 = 25 THEN -30 ELSE 30 END')} AS updated_at,
         'inc_001' AS source_batch_id
  FROM payments_raw WHERE source_record_id % 20 = 5
  UNION ALL
  SELECT source_record_id + 2 * (SELECT step FROM id_step),
         CASE WHEN source_record_id % 1000 = 350 THEN NULL ELSE {_pad('pay_', 'source_record_id + 2 * (SELECT step FROM id_step)', 10)} END,
         customer_id,
         CASE WHEN source_record_id % 200 = 150 THEN 'mrc_new' WHEN source_record_id % 400 = 250 THEN 'mrc_missing' ELSE merchant_id END,
         payment_amount, currency, payment_status, payment_timestamp, created_at, updated_at, 'inc_001'
  FROM payments_raw WHERE source_record_id % 100 = 50
  UNION ALL
  SELECT source_record_id + 3 * (SELECT step FROM id_step), payment_id, customer_id, merchant_id, {M.format('payment_amount + 20')},
         currency, payment_status, payment_timestamp, created_at, updated_at + {_days('60')}, 'inc_001'
  FROM payments_raw WHERE source_record_id % 200 = 45
),
merchants_src_valid AS (
  SELECT * FROM merchants_raw WHERE merchant_id IS NOT NULL AND trim(merchant_id) <> ''
),
merchants_inc AS (
  SELECT merchant_id, merchant_name,
         CASE WHEN right(merchant_id, 1) IN ('1', '4') THEN 'LUXURY' ELSE merchant_category END AS merchant_category,
         city, state, risk_tier, created_at, updated_at + {_days('200')} AS updated_at, 'inc_001' AS source_batch_id
  FROM merchants_src_valid WHERE right(merchant_id, 1) IN ('1', '2', '4')
  UNION ALL
  SELECT merchant_id, merchant_name, 'OLDER_DUP', city, state, risk_tier, created_at, updated_at + {_days('100')}, 'inc_001'
  FROM merchants_src_valid WHERE right(merchant_id, 1) = '1'
  UNION ALL SELECT 'mrc_new', 'Merchant new', 'RETAIL', 'X', 'X', 'LOW', TIMESTAMP '1996-01-01', TIMESTAMP '1996-01-01', 'inc_001'
  UNION ALL SELECT NULL, 'bad', 'RETAIL', 'X', 'X', 'LOW', TIMESTAMP '1996-01-01', TIMESTAMP '1996-01-01', 'inc_001'
),
settlements_inc AS (
  SELECT source_record_id + (SELECT step FROM id_step) AS source_record_id, settlement_id, payment_id, merchant_id,
         {M.format('settlement_amount + 5')} AS settlement_amount, settlement_status, settlement_timestamp, created_at,
         updated_at + {_days('CASE WHEN source_record_id % 50 = 45 THEN -30 ELSE 30 END')} AS updated_at,
         'inc_001' AS source_batch_id
  FROM settlements_raw WHERE source_record_id % 25 = 20
  UNION ALL
  SELECT source_record_id + 2 * (SELECT step FROM id_step),
         CASE WHEN source_record_id % 1000 = 213 THEN NULL ELSE {_pad('stl_', 'source_record_id + 2 * (SELECT step FROM id_step)', 10)} END,
         CASE WHEN source_record_id % 1000 = 613 THEN 'pay_unknown' ELSE payment_id END,
         merchant_id,
         CASE WHEN source_record_id % 1000 = 413 THEN {M.format('0')} ELSE payment_amount END,
         'SETTLED', payment_timestamp + {_days('20')}, payment_timestamp, payment_timestamp + {_days('20')}, 'inc_001'
  FROM payments_raw WHERE source_record_id % 100 = 13
)"""

SILVER = f"""
merchants_valid AS (
  SELECT {MRC_COLS} FROM merchants_raw WHERE merchant_id IS NOT NULL AND trim(merchant_id) <> ''
),
merchants_invalid AS (
  SELECT {MRC_COLS}, 'MISSING_MERCHANT_ID' AS rejection_reason, 'merchants' AS source_table
  FROM merchants_raw WHERE merchant_id IS NULL OR trim(merchant_id) = ''
),
customers_valid AS (
  SELECT {CUS_COLS} FROM customers_raw WHERE customer_id IS NOT NULL AND trim(customer_id) <> ''
),
customers_invalid AS (
  SELECT {CUS_COLS}, 'MISSING_CUSTOMER_ID' AS rejection_reason, 'customers' AS source_table
  FROM customers_raw WHERE customer_id IS NULL OR trim(customer_id) = ''
),
payments_checked AS (
  SELECT p.*,
         CASE WHEN p.payment_id IS NULL OR trim(p.payment_id) = '' THEN 'MISSING_PAYMENT_ID'
              WHEN p.payment_amount IS NULL OR p.payment_amount <= 0 THEN 'INVALID_PAYMENT_AMOUNT'
              WHEN NOT EXISTS (SELECT 1 FROM merchants_valid m WHERE m.merchant_id = p.merchant_id) THEN 'MISSING_MERCHANT_REFERENCE'
         END AS rejection_reason
  FROM payments_raw p
),
payments_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY updated_at DESC NULLS LAST, source_record_id DESC NULLS LAST) AS dup_rank
  FROM payments_checked WHERE rejection_reason IS NULL
),
payments_valid AS (SELECT {PAY_COLS} FROM payments_ranked WHERE dup_rank = 1),
payments_invalid AS (
  SELECT {PAY_COLS}, rejection_reason, 'payments' AS source_table FROM payments_checked WHERE rejection_reason IS NOT NULL
),
payment_duplicates AS (
  SELECT {PAY_COLS}, 'DUPLICATE_PAYMENT_ID' AS rejection_reason, 'payments' AS source_table FROM payments_ranked WHERE dup_rank > 1
),
payments_silver AS (SELECT *, CAST(payment_timestamp AS DATE) AS payment_date FROM payments_valid),
settlements_checked AS (
  SELECT s.*,
         CASE WHEN s.settlement_id IS NULL OR trim(s.settlement_id) = '' THEN 'MISSING_SETTLEMENT_ID'
              WHEN s.settlement_amount IS NULL OR s.settlement_amount <= 0 THEN 'INVALID_SETTLEMENT_AMOUNT'
              WHEN NOT EXISTS (SELECT 1 FROM payments_valid v WHERE v.payment_id = s.payment_id) THEN 'MISSING_PAYMENT_REFERENCE'
         END AS rejection_reason
  FROM settlements_raw s
),
settlements_valid AS (SELECT {STL_COLS} FROM settlements_checked WHERE rejection_reason IS NULL),
settlements_invalid AS (
  SELECT {STL_COLS}, rejection_reason, 'settlements' AS source_table FROM settlements_checked WHERE rejection_reason IS NOT NULL
)"""

GOLD = """
settlement_totals AS (
  SELECT payment_id, SUM(settlement_amount) AS settled_amount, COUNT(settlement_id) AS settlement_record_count,
         MAX(settlement_timestamp) AS latest_settlement_timestamp
  FROM settlements_valid GROUP BY payment_id
),
payment_reconciliation AS (
  SELECT p.*, COALESCE(t.settled_amount, 0) AS settled_amount,
         COALESCE(t.settlement_record_count, 0) AS settlement_record_count,
         t.latest_settlement_timestamp,
         p.payment_amount - COALESCE(t.settled_amount, 0) AS reconciliation_difference,
         CASE WHEN COALESCE(t.settlement_record_count, 0) = 0 THEN 'MISSING_SETTLEMENT'
              WHEN abs(p.payment_amount - COALESCE(t.settled_amount, 0)) <= 0.01 THEN 'MATCHED'
              WHEN p.payment_amount - COALESCE(t.settled_amount, 0) > 0 THEN 'UNDER_SETTLED'
              ELSE 'OVER_SETTLED' END AS reconciliation_status
  FROM payments_silver p LEFT JOIN settlement_totals t ON p.payment_id = t.payment_id
),
merchant_daily_metrics AS (
  SELECT CAST(payment_timestamp AS DATE) AS business_date, merchant_id, currency,
         COUNT(payment_id) AS payment_count,
         SUM(payment_amount) AS gross_payment_amount,
         SUM(settled_amount) AS settled_amount,
         CAST(count_if(reconciliation_status = 'MISSING_SETTLEMENT') AS BIGINT) AS missing_settlement_count,
         CAST(count_if(reconciliation_status = 'UNDER_SETTLED') AS BIGINT) AS under_settled_count,
         SUM(payment_amount) - SUM(settled_amount) AS unsettled_amount
  FROM payment_reconciliation GROUP BY 1, 2, 3
),
reconciliation_summary AS (
  SELECT reconciliation_status, COUNT(payment_id) AS payment_count, SUM(payment_amount) AS payment_amount,
         SUM(settled_amount) AS settled_amount, SUM(reconciliation_difference) AS net_difference
  FROM payment_reconciliation GROUP BY 1
)"""

CTE_BLOCKS = [FIXTURES, SILVER, GOLD]


def with_ctes(body: str, blocks: list[str] | None = None) -> str:
    blocks = CTE_BLOCKS if blocks is None else blocks
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n" + body.strip() + "\n"


def _d(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {alias or c.split('.')[-1]}"


QUERIES: dict[str, str] = {}


def register(name: str, body: str, blocks: list[str] | None = None) -> None:
    QUERIES[name] = with_ctes(body, blocks)


PAY_OUT = PAY_COLS.replace("payment_amount", _d("payment_amount"))
STL_OUT = STL_COLS.replace("settlement_amount", _d("settlement_amount"))

register("merchants_valid", "SELECT * FROM merchants_valid")
register("merchants_invalid", "SELECT * FROM merchants_invalid")
register("customers_valid", "SELECT * FROM customers_valid")
register("customers_invalid", "SELECT * FROM customers_invalid")
register(
    "payment_rejections",
    "SELECT source_record_id, payment_id, merchant_id, COALESCE(c.rejection_reason, "
    "CASE WHEN r.dup_rank > 1 THEN 'DUPLICATE_PAYMENT_ID' END) AS rejection_reason "
    "FROM payments_checked c LEFT JOIN (SELECT source_record_id AS rid, dup_rank FROM payments_ranked) r ON c.source_record_id = r.rid",
)
register("payments_invalid", f"SELECT {PAY_OUT}, rejection_reason, source_table FROM payments_invalid")
register("payment_duplicates", f"SELECT {PAY_OUT}, rejection_reason, source_table FROM payment_duplicates")
register("payments_valid", f"SELECT {PAY_OUT} FROM payments_valid")
register("payments_silver", f"SELECT {PAY_OUT}, payment_date FROM payments_silver")
register(
    "settlement_rejections",
    "SELECT source_record_id, settlement_id, payment_id, rejection_reason FROM settlements_checked",
)
register("settlements_valid", f"SELECT {STL_OUT}, CAST(settlement_timestamp AS DATE) AS settlement_date FROM settlements_valid")
register(
    "settlement_totals",
    "SELECT payment_id, CAST(settled_amount AS DOUBLE) AS settled_amount, settlement_record_count, latest_settlement_timestamp FROM settlement_totals",
)
register(
    "payment_reconciliation",
    f"SELECT {PAY_OUT}, payment_date, {_d('settled_amount')}, settlement_record_count, latest_settlement_timestamp, "
    f"{_d('reconciliation_difference')}, reconciliation_status FROM payment_reconciliation",
)
register(
    "merchant_daily_metrics",
    f"SELECT business_date, merchant_id, currency, payment_count, {_d('gross_payment_amount')}, {_d('settled_amount')}, "
    f"missing_settlement_count, under_settled_count, {_d('unsettled_amount')} FROM merchant_daily_metrics",
)
register(
    "reconciliation_summary",
    f"SELECT reconciliation_status, payment_count, {_d('payment_amount')}, {_d('settled_amount')}, {_d('net_difference')} "
    "FROM reconciliation_summary",
)

MERGE = f"""
merchants_inc_invalid AS (
  SELECT {MRC_COLS}, 'MISSING_MERCHANT_ID' AS rejection_reason, 'merchants' AS source_table
  FROM merchants_inc WHERE merchant_id IS NULL OR trim(merchant_id) = ''
),
merchants_inc_latest AS (
  SELECT {MRC_COLS} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY merchant_id ORDER BY updated_at DESC NULLS LAST) AS rn
    FROM merchants_inc WHERE merchant_id IS NOT NULL AND trim(merchant_id) <> ''
  ) WHERE rn = 1
),
merchants_merged AS (
  SELECT {MRC_COLS} FROM merchants_valid b
  WHERE NOT EXISTS (SELECT 1 FROM merchants_inc_latest c WHERE c.merchant_id = b.merchant_id)
  UNION ALL SELECT {MRC_COLS} FROM merchants_inc_latest
),
payments_inc_checked AS (
  SELECT p.*,
         CASE WHEN p.payment_id IS NULL OR trim(p.payment_id) = '' THEN 'MISSING_PAYMENT_ID'
              WHEN p.payment_amount IS NULL OR p.payment_amount <= 0 THEN 'INVALID_PAYMENT_AMOUNT'
              WHEN NOT EXISTS (SELECT 1 FROM merchants_merged m WHERE m.merchant_id = p.merchant_id) THEN 'MISSING_MERCHANT_REFERENCE'
         END AS rejection_reason
  FROM payments_inc p
),
payments_inc_ranked AS (
  SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY updated_at DESC NULLS LAST, source_record_id DESC NULLS LAST) AS inc_rank
  FROM payments_inc_checked WHERE rejection_reason IS NULL
),
payments_merged AS (
  SELECT {PAY_COLS}, CAST(payment_timestamp AS DATE) AS payment_date FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY updated_at DESC NULLS LAST, source_record_id DESC NULLS LAST) AS rn
    FROM (SELECT {PAY_COLS} FROM payments_valid UNION ALL SELECT {PAY_COLS} FROM payments_inc_ranked WHERE inc_rank = 1)
  ) WHERE rn = 1
),
settlements_inc_checked AS (
  SELECT s.*,
         CASE WHEN s.settlement_id IS NULL OR trim(s.settlement_id) = '' THEN 'MISSING_SETTLEMENT_ID'
              WHEN s.settlement_amount IS NULL OR s.settlement_amount <= 0 THEN 'INVALID_SETTLEMENT_AMOUNT'
              WHEN NOT EXISTS (SELECT 1 FROM payments_merged v WHERE v.payment_id = s.payment_id) THEN 'MISSING_PAYMENT_REFERENCE'
         END AS rejection_reason
  FROM settlements_inc s
),
settlements_merged AS (
  SELECT {STL_COLS}, CAST(settlement_timestamp AS DATE) AS settlement_date FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY settlement_id ORDER BY updated_at DESC NULLS LAST, source_record_id DESC NULLS LAST) AS rn
    FROM (SELECT {STL_COLS} FROM settlements_valid
          UNION ALL SELECT {STL_COLS} FROM settlements_inc_checked WHERE rejection_reason IS NULL)
  ) WHERE rn = 1
)"""

_TRACKED = ["merchant_name", "merchant_category", "city", "state", "risk_tier"]
HIST_COLS = f"{MRC_COLS}, effective_from, effective_to, is_current, scd_version"

HISTORY = f"""
scd2_base AS (
  SELECT {MRC_COLS}, COALESCE(updated_at, created_at) AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
         TRUE AS is_current, CAST(1 AS INTEGER) AS scd_version
  FROM merchants_valid
),
scd2_latest_changes AS (
  SELECT {MRC_COLS} FROM (
    SELECT *, ROW_NUMBER() OVER (PARTITION BY merchant_id ORDER BY updated_at DESC NULLS LAST, created_at DESC NULLS LAST) AS rn
    FROM merchants_inc WHERE merchant_id IS NOT NULL AND trim(merchant_id) <> ''
  ) WHERE rn = 1
),
scd2_changed AS (
  SELECT c.merchant_id, c.scd_version AS superseded_version, c.effective_from AS valid_since, COALESCE(n.updated_at, n.created_at) AS superseded_at,
         concat_ws(',', {", ".join(f"CASE WHEN c.{t} IS DISTINCT FROM n.{t} THEN '{t}' END" for t in _TRACKED)}) AS changed_columns
  FROM scd2_base c JOIN scd2_latest_changes n ON c.merchant_id = n.merchant_id
  WHERE c.is_current AND ({" OR ".join(f"c.{t} IS DISTINCT FROM n.{t}" for t in _TRACKED)})
    AND COALESCE(n.updated_at, n.created_at) > c.effective_from
),
scd2_closed_all AS (
  SELECT {", ".join("b." + c.strip() for c in MRC_COLS.split(","))}, b.effective_from,
         CASE WHEN b.is_current AND x.superseded_at IS NOT NULL THEN x.superseded_at ELSE b.effective_to END AS effective_to,
         CASE WHEN b.is_current AND x.superseded_at IS NOT NULL THEN FALSE ELSE b.is_current END AS is_current,
         b.scd_version
  FROM scd2_base b LEFT JOIN scd2_changed x ON b.merchant_id = x.merchant_id
),
scd2_opened AS (
  SELECT {", ".join("n." + c.strip() for c in MRC_COLS.split(","))}, x.superseded_at AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to, TRUE AS is_current,
         CAST(x.superseded_version + 1 AS INTEGER) AS scd_version
  FROM scd2_changed x JOIN scd2_latest_changes n ON n.merchant_id = x.merchant_id
),
scd2_merged AS (SELECT {HIST_COLS} FROM scd2_closed_all UNION ALL SELECT {HIST_COLS} FROM scd2_opened),
scd2_inserts AS (
  SELECT {MRC_COLS}, COALESCE(updated_at, created_at) AS effective_from, CAST(NULL AS TIMESTAMP) AS effective_to,
         TRUE AS is_current, CAST(1 AS INTEGER) AS scd_version
  FROM scd2_latest_changes n WHERE NOT EXISTS (SELECT 1 FROM scd2_base b WHERE b.merchant_id = n.merchant_id)
),
scd2_merged_inserts AS (SELECT {HIST_COLS} FROM scd2_merged UNION ALL SELECT {HIST_COLS} FROM scd2_inserts)"""

AUDIT = """
quarantine_all AS (
  SELECT source_table, rejection_reason, merchant_id AS record_key, CAST(NULL AS BIGINT) AS source_record_id, source_batch_id FROM merchants_invalid
  UNION ALL SELECT source_table, rejection_reason, customer_id, CAST(NULL AS BIGINT), source_batch_id FROM customers_invalid
  UNION ALL SELECT source_table, rejection_reason, payment_id, source_record_id, source_batch_id FROM payments_invalid
  UNION ALL SELECT source_table, rejection_reason, payment_id, source_record_id, source_batch_id FROM payment_duplicates
  UNION ALL SELECT source_table, rejection_reason, settlement_id, source_record_id, source_batch_id FROM settlements_invalid
),
quality_report AS (
  SELECT 'valid_rows' AS section, 'merchants' AS name, (SELECT count(*) FROM merchants_valid) AS value
  UNION ALL SELECT 'valid_rows', 'customers', (SELECT count(*) FROM customers_valid)
  UNION ALL SELECT 'valid_rows', 'payments', (SELECT count(*) FROM payments_valid)
  UNION ALL SELECT 'valid_rows', 'settlements', (SELECT count(*) FROM settlements_valid)
  UNION ALL SELECT 'quarantined_rows', 'merchants', (SELECT count(*) FROM merchants_invalid)
  UNION ALL SELECT 'quarantined_rows', 'customers', (SELECT count(*) FROM customers_invalid)
  UNION ALL SELECT 'quarantined_rows', 'payments_invalid', (SELECT count(*) FROM payments_invalid)
  UNION ALL SELECT 'quarantined_rows', 'payments_duplicates', (SELECT count(*) FROM payment_duplicates)
  UNION ALL SELECT 'quarantined_rows', 'settlements', (SELECT count(*) FROM settlements_invalid)
),
source_totals AS (
  SELECT (SELECT count(*) FROM payments_raw) AS raw_payment_count,
         count(*) AS expected_valid_payment_count,
         COALESCE(SUM(payment_amount), 0) AS expected_valid_payment_amount
  FROM (
    SELECT p.*, ROW_NUMBER() OVER (PARTITION BY p.payment_id ORDER BY p.updated_at DESC NULLS LAST, p.source_record_id DESC) AS rn
    FROM payments_raw p
    WHERE p.payment_id IS NOT NULL AND trim(p.payment_id) <> '' AND p.payment_amount > 0
      AND EXISTS (SELECT 1 FROM merchants_raw m WHERE m.merchant_id = p.merchant_id)
  ) WHERE rn = 1
),
target_totals AS (
  SELECT count(payment_id) AS valid_payment_count, COALESCE(SUM(payment_amount), 0) AS valid_payment_amount,
         COALESCE(SUM(settled_amount), 0) AS settled_amount
  FROM payment_reconciliation
),
migration AS (
  SELECT (SELECT raw_payment_count FROM source_totals) AS raw_payment_count,
         (SELECT expected_valid_payment_count FROM source_totals) AS expected_valid_payment_count,
         (SELECT expected_valid_payment_amount FROM source_totals) AS expected_valid_payment_amount,
         t.valid_payment_count AS target_valid_payment_count, t.valid_payment_amount AS target_valid_payment_amount,
         t.settled_amount AS target_settled_amount,
         (SELECT SUM(value) FROM quality_report WHERE section = 'quarantined_rows' AND name IN ('payments_invalid', 'payments_duplicates')) AS quarantined_payment_rows
  FROM target_totals t
),
migration_checks AS (
  SELECT *, raw_payment_count = target_valid_payment_count + quarantined_payment_rows AS raw_records_accounted_for,
         expected_valid_payment_count = target_valid_payment_count AS valid_payment_count_matches,
         expected_valid_payment_amount = target_valid_payment_amount AS valid_payment_amount_matches
  FROM migration
),
migration_verdict AS (
  SELECT *, CASE WHEN raw_records_accounted_for AND valid_payment_count_matches AND valid_payment_amount_matches
                 THEN 'PASSED' ELSE 'FAILED' END AS status
  FROM migration_checks
)"""

ALL = [FIXTURES, SILVER, GOLD, MERGE, HISTORY, AUDIT]
CUTOFF = "TIMESTAMP '2001-06-30 00:00:00'"
WM_TS = "TIMESTAMP '2001-01-01 00:00:00'"


def reg(name: str, body: str) -> None:
    register(name, body, ALL)


def _batch(col: str = "source_record_id") -> str:
    return f"'payments-' || lpad(CAST({col} // 1000 + 1 AS VARCHAR), CAST(greatest(length(CAST({col} // 1000 + 1 AS VARCHAR)), 5) AS INTEGER), '0')"


def _changes(table: str, key: str, ts: str, k: str) -> str:
    return (
        f"SELECT * FROM {table} WHERE updated_at <= {CUTOFF} AND (updated_at > TIMESTAMP '{ts}' "
        f"OR (updated_at = TIMESTAMP '{ts}' AND {key} > {k}))"
    )


reg("full_extract", f"SELECT {PAY_OUT}, {_batch()} AS batch_id FROM payments_raw")
reg("incremental_extract", f"SELECT {PAY_OUT} FROM ({_changes('payments_raw', 'source_record_id', '2001-01-01 00:00:00', '500')})")

_WM_TABLES = [
    ("merchants", "merchants_raw", "merchant_id"),
    ("customers", "customers_raw", "customer_id"),
    ("payments", "payments_raw", "source_record_id"),
    ("settlements", "settlements_raw", "source_record_id"),
]
reg(
    "latest_watermark",
    " UNION ALL ".join(
        f"SELECT * FROM (SELECT '{t}' AS source_table, m.updated_at, CAST(m.{k} AS VARCHAR) AS source_key "
        f"FROM (SELECT 1 AS one) d LEFT JOIN (SELECT updated_at, {k} FROM {src} WHERE updated_at IS NOT NULL "
        f"ORDER BY updated_at DESC, {k} DESC NULLS LAST LIMIT 1) m ON TRUE)"
        for t, src, k in _WM_TABLES
    ),
)

_OLD = [
    ("merchants", "merchants_raw", "merchant_id", "1994-02-01 00:00:00", "'mrc_000010'"),
    ("customers", "customers_raw", "customer_id", "1994-06-01 00:00:00", "'cus_00000010'"),
    ("payments", "payments_raw", "source_record_id", "2001-01-01 00:00:00", "500"),
    ("settlements", "settlements_raw", "source_record_id", "2001-01-01 00:00:00", "500"),
]
reg(
    "advance_watermark",
    " UNION ALL ".join(
        f"SELECT '{t}' AS source_table, COALESCE(m.updated_at, TIMESTAMP '{ts}') AS updated_at, "
        f"CASE WHEN m.updated_at IS NULL THEN '{str(k).strip(chr(39))}' ELSE CAST(m.{key} AS VARCHAR) END AS source_key, "
        f"(SELECT count(*) FROM ({_changes(src, key, ts, k)})) AS extracted_rows "
        f"FROM (SELECT 1 AS one) d LEFT JOIN (SELECT updated_at, {key} FROM ({_changes(src, key, ts, k)}) "
        f"ORDER BY updated_at DESC, {key} DESC LIMIT 1) m ON TRUE"
        for t, src, key, ts, k in _OLD
    ),
)
reg(
    "batch_manifest",
    f"SELECT 'payments' AS source_table, {_batch()} AS batch_id, count(*) AS record_count, "
    "CAST(max(source_record_id) AS VARCHAR) AS last_source_key, 'COMPLETED' AS status FROM payments_raw GROUP BY 2",
)
_canon = " || ".join(f"COALESCE(length(CAST({c.strip()} AS VARCHAR)) || ':' || CAST({c.strip()} AS VARCHAR), '-')" for c in PAY_COLS.split(","))
reg("row_digest", f"SELECT source_record_id, sha256({_canon}) AS row_digest FROM payments_raw")
reg(
    "verify_manifest",
    f"""SELECT COALESCE(r.source_table, l.source_table) AS source_table, COALESCE(r.batch_id, l.batch_id) AS batch_id,
           r.record_count AS recorded_count, l.record_count AS landed_count,
           CASE WHEN l.record_count IS NULL THEN 'MISSING_BATCH' WHEN r.record_count IS NULL THEN 'UNEXPECTED_BATCH'
                WHEN r.record_count = l.record_count THEN 'MATCHED' ELSE 'COUNT_MISMATCH' END AS status
    FROM (SELECT 'payments' AS source_table, {_batch()} AS batch_id, count(*) AS record_count FROM payments_raw GROUP BY 2) r
    FULL OUTER JOIN (
      SELECT 'payments' AS source_table, {_batch()} AS batch_id, count(*) AS record_count FROM (
        SELECT source_record_id FROM payments_valid UNION ALL SELECT source_record_id FROM payments_invalid
        UNION ALL SELECT source_record_id FROM payment_duplicates) GROUP BY 2
    ) l ON r.source_table = l.source_table AND r.batch_id = l.batch_id""",
)

reg("quarantine_union", "SELECT * FROM quarantine_all")
reg("rejection_counts", "SELECT source_table, rejection_reason, count(*) AS rejected_rows FROM quarantine_all GROUP BY 1, 2")
reg("quality_report", "SELECT * FROM quality_report")

reg(
    "latest_by_key",
    f"""SELECT {PAY_OUT} FROM (
      SELECT *, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY updated_at DESC NULLS LAST, source_record_id DESC NULLS LAST) AS rn
      FROM (SELECT * FROM payments_raw UNION ALL SELECT * FROM payments_inc)
      WHERE payment_id IS NOT NULL AND trim(payment_id) <> '') WHERE rn = 1""",
)
reg("merchants_merged", "SELECT * FROM merchants_merged")
reg("customers_merged", "SELECT * FROM customers_valid")
reg("payments_merged", f"SELECT {PAY_OUT}, payment_date FROM payments_merged")
reg("settlements_merged", f"SELECT {STL_OUT}, settlement_date FROM settlements_merged")
reg(
    "incremental_payment_rejections",
    "SELECT c.source_record_id, c.payment_id, c.merchant_id, COALESCE(c.rejection_reason, "
    "CASE WHEN r.inc_rank > 1 THEN 'DUPLICATE_PAYMENT_ID' END) AS rejection_reason "
    "FROM payments_inc_checked c LEFT JOIN (SELECT source_record_id AS rid, inc_rank FROM payments_inc_ranked) r ON c.source_record_id = r.rid",
)
reg("incremental_settlement_rejections", "SELECT source_record_id, settlement_id, payment_id, rejection_reason FROM settlements_inc_checked")
reg(
    "merge_report",
    """SELECT 'incremental_rows' AS section, 'merchants' AS name, (SELECT count(*) FROM merchants_inc) AS value
    UNION ALL SELECT 'incremental_rows', 'payments', (SELECT count(*) FROM payments_inc)
    UNION ALL SELECT 'incremental_rows', 'settlements', (SELECT count(*) FROM settlements_inc)
    UNION ALL SELECT 'merged_rows', 'merchants', (SELECT count(*) FROM merchants_merged)
    UNION ALL SELECT 'merged_rows', 'customers', (SELECT count(*) FROM customers_valid)
    UNION ALL SELECT 'merged_rows', 'payments', (SELECT count(*) FROM payments_merged)
    UNION ALL SELECT 'merged_rows', 'settlements', (SELECT count(*) FROM settlements_merged)
    UNION ALL SELECT 'quarantined_rows', 'merchants', (SELECT count(*) FROM merchants_inc_invalid)
    UNION ALL SELECT 'quarantined_rows', 'payments', (SELECT count(*) FROM payments_inc_checked WHERE rejection_reason IS NOT NULL)
    UNION ALL SELECT 'quarantined_rows', 'payments_superseded', (SELECT count(*) FROM payments_inc_ranked WHERE inc_rank > 1)
    UNION ALL SELECT 'quarantined_rows', 'settlements', (SELECT count(*) FROM settlements_inc_checked WHERE rejection_reason IS NOT NULL)""",
)

reg(
    "gold_report",
    """SELECT 'gold_rows' AS section, 'payment_reconciliation' AS name, (SELECT count(*) FROM payment_reconciliation) AS value
    UNION ALL SELECT 'gold_rows', 'merchant_daily_metrics', (SELECT count(*) FROM merchant_daily_metrics)
    UNION ALL SELECT 'gold_rows', 'merchant_scd2', (SELECT count(*) FROM merchants_valid)
    UNION ALL SELECT 'reconciliation_status_counts', reconciliation_status, payment_count FROM reconciliation_summary""",
)
reg(
    "top_merchants",
    """SELECT merchant_id, CAST(SUM(payment_count) AS BIGINT) AS payment_count FROM merchant_daily_metrics
    WHERE year(business_date) = 1998 AND month(business_date) = 6
    GROUP BY merchant_id ORDER BY payment_count DESC, merchant_id LIMIT 10""",
)
reg(
    "compact_by_month",
    """SELECT CAST(year(payment_date) AS INTEGER) AS partition_year, CAST(month(payment_date) AS INTEGER) AS partition_month,
           count(*) AS row_count FROM payments_silver GROUP BY 1, 2""",
)

reg("scd2_init", "SELECT * FROM scd2_base")
reg("scd2_changed", "SELECT * FROM scd2_changed")
reg("scd2_merge", "SELECT * FROM scd2_merged")
reg("scd2_merge_with_inserts", "SELECT * FROM scd2_merged_inserts")
reg("scd2_closed", "SELECT * FROM scd2_merged WHERE NOT is_current")
reg("scd2_opened", "SELECT * FROM scd2_opened")
reg("scd2_current", "SELECT * FROM scd2_merged WHERE is_current")
reg(
    "scd2_as_of",
    "SELECT * FROM scd2_merged_inserts WHERE effective_from <= TIMESTAMP '1994-08-15 00:00:00' "
    "AND (effective_to IS NULL OR TIMESTAMP '1994-08-15 00:00:00' < effective_to)",
)
reg(
    "scd2_report",
    """SELECT (SELECT count(*) FROM scd2_changed) AS changed_merchants, count(*) AS total_scd2_rows,
           CAST(count_if(is_current) AS BIGINT) AS current_scd2_rows, CAST(count_if(NOT is_current) AS BIGINT) AS closed_scd2_rows FROM scd2_merged""",
)

_NN, _UQ, _BT, _IS = (
    "expect_column_values_to_not_be_null",
    "expect_column_values_to_be_unique",
    "expect_column_values_to_be_between",
    "expect_column_values_to_be_in_set",
)


def _check(dataset: str, source: str, name: str, column: str, bad: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{name}' AS expectation, '{column}' AS column_name, count(*) AS element_count, "
        f"CAST(count_if({bad}) AS BIGINT) AS unexpected_count, count_if({bad}) = 0 AS success FROM {source}"
    )


def _unique(dataset: str, source: str, column: str) -> str:
    return (
        f"SELECT '{dataset}' AS dataset, '{_UQ}' AS expectation, '{column}' AS column_name, "
        f"CAST(COALESCE(SUM(n), 0) AS BIGINT) AS element_count, "
        f"CAST(COALESCE(SUM(CASE WHEN {column} IS NOT NULL AND n > 1 THEN n END), 0) AS BIGINT) AS unexpected_count, "
        f"COALESCE(SUM(CASE WHEN {column} IS NOT NULL AND n > 1 THEN n END), 0) = 0 AS success "
        f"FROM (SELECT {column}, count(*) AS n FROM {source} GROUP BY {column})"
    )


_PAY_SET = "('CAPTURED', 'AUTHORIZED', 'FAILED', 'REFUNDED')"
_REC_SET = "('MATCHED', 'MISSING_SETTLEMENT', 'UNDER_SETTLED', 'OVER_SETTLED')"
reg(
    "expect_not_null",
    " UNION ALL ".join(
        [
            _check("payments_raw", "payments_raw", _NN, "payment_id", "payment_id IS NULL"),
            _check("merchants_raw", "merchants_raw", _NN, "merchant_id", "merchant_id IS NULL"),
            _check("payments", "payments_valid", _NN, "payment_id", "payment_id IS NULL"),
        ]
    ),
)
reg(
    "expect_unique",
    " UNION ALL ".join(
        [
            _unique("payments_raw", "payments_raw", "payment_id"),
            _unique("merchants_raw", "merchants_raw", "merchant_id"),
            _unique("payments", "payments_valid", "payment_id"),
        ]
    ),
)
reg(
    "expect_between",
    " UNION ALL ".join(
        [
            _check("payments_raw", "payments_raw", _BT, "payment_amount", "payment_amount IS NOT NULL AND payment_amount < 0.01"),
            _check("payments", "payments_valid", _BT, "payment_amount", "payment_amount IS NOT NULL AND payment_amount < 0.01"),
        ]
    ),
)
reg(
    "expect_in_set",
    " UNION ALL ".join(
        [
            _check("payments_raw", "payments_raw", _IS, "payment_status", f"payment_status IS NOT NULL AND payment_status NOT IN {_PAY_SET}"),
            _check(
                "reconciliation",
                "payment_reconciliation",
                _IS,
                "reconciliation_status",
                f"reconciliation_status IS NOT NULL AND reconciliation_status NOT IN {_REC_SET}",
            ),
        ]
    ),
)
reg(
    "orphan_payments",
    """SELECT 'payments_raw' AS dataset, count(*) AS orphan_payment_count FROM payments_raw p
       WHERE NOT EXISTS (SELECT 1 FROM merchants_valid m WHERE m.merchant_id = p.merchant_id)
    UNION ALL
    SELECT 'payments', count(*) FROM payments_valid p
       WHERE NOT EXISTS (SELECT 1 FROM merchants_valid m WHERE m.merchant_id = p.merchant_id)""",
)
reg(
    "expectation_suite",
    "SELECT *, CASE WHEN bool_and(success) OVER () THEN 'PASSED' ELSE 'FAILED' END AS suite_status FROM ("
    + " UNION ALL ".join(
        [
            _check("merchants", "merchants_valid", _NN, "merchant_id", "merchant_id IS NULL"),
            _unique("merchants", "merchants_valid", "merchant_id"),
            _check("payments", "payments_valid", _NN, "payment_id", "payment_id IS NULL"),
            _unique("payments", "payments_valid", "payment_id"),
            _check("payments", "payments_valid", _BT, "payment_amount", "payment_amount IS NOT NULL AND payment_amount < 0.01"),
            _check("payments", "payments_valid", _IS, "payment_status", f"payment_status IS NOT NULL AND payment_status NOT IN {_PAY_SET}"),
            _check("reconciliation", "payment_reconciliation", _NN, "payment_id", "payment_id IS NULL"),
            _check(
                "reconciliation",
                "payment_reconciliation",
                _IS,
                "reconciliation_status",
                f"reconciliation_status IS NOT NULL AND reconciliation_status NOT IN {_REC_SET}",
            ),
            "SELECT 'referential_integrity', 'payments.merchant_id_exists_in_merchants', 'merchant_id', CAST(NULL AS BIGINT), "
            "count(*), count(*) = 0 FROM payments_valid p WHERE NOT EXISTS (SELECT 1 FROM merchants_valid m WHERE m.merchant_id = p.merchant_id)",
        ]
    )
    + ")",
)

reg(
    "source_expected_totals",
    f"SELECT raw_payment_count, expected_valid_payment_count, {_d('expected_valid_payment_amount')} FROM source_totals",
)
reg(
    "target_totals",
    f"SELECT valid_payment_count, {_d('valid_payment_amount')}, {_d('settled_amount')} FROM target_totals",
)
reg(
    "migration_reconciliation",
    f"""SELECT raw_payment_count, expected_valid_payment_count, {_d('expected_valid_payment_amount')}, target_valid_payment_count,
           {_d('target_valid_payment_amount')}, {_d('target_settled_amount')}, CAST(quarantined_payment_rows AS BIGINT) AS quarantined_payment_rows,
           raw_records_accounted_for, valid_payment_count_matches, valid_payment_amount_matches, status FROM migration_verdict""",
)
# Every source row, raw or of the increment, is in the merged Silver or in the ledger once.
MERGED_LEDGER = """
merged_ledger AS (
  SELECT s.source_record_id, CASE WHEN c.rejection_reason IS NOT NULL THEN c.rejection_reason
           WHEN i.rejection_reason IS NOT NULL THEN i.rejection_reason ELSE 'DUPLICATE_PAYMENT_ID' END AS rejection_reason, count(*) AS rows
  FROM (SELECT source_record_id FROM payments_raw UNION ALL SELECT source_record_id FROM payments_inc) s
  LEFT JOIN payments_checked c ON c.source_record_id = s.source_record_id
  LEFT JOIN payments_inc_checked i ON i.source_record_id = s.source_record_id
  WHERE s.source_record_id NOT IN (SELECT source_record_id FROM payments_merged) GROUP BY ALL
),
merged_source AS (
  SELECT (SELECT count(*) FROM payments_raw) + (SELECT count(*) FROM payments_inc) AS raw_payment_count, count(*) AS expected_valid_payment_count,
         sum(payment_amount) AS expected_valid_payment_amount
  FROM (SELECT payment_amount, ROW_NUMBER() OVER (PARTITION BY payment_id ORDER BY updated_at DESC NULLS LAST, source_record_id DESC NULLS LAST) AS rn
        FROM (SELECT * FROM payments_raw UNION ALL SELECT * FROM payments_inc)
        WHERE payment_id IS NOT NULL AND trim(payment_id) <> '' AND payment_amount > 0 AND merchant_id IN (SELECT merchant_id FROM merchants_merged)) WHERE rn = 1
),
merged_target AS (
  SELECT count(*) AS target_valid_payment_count, sum(payment_amount) AS target_valid_payment_amount,
         sum((SELECT coalesce(sum(t.settlement_amount), 0) FROM settlements_merged t WHERE t.payment_id = p.payment_id)) AS target_settled_amount
  FROM payments_merged p
),
merged_verdict AS (
  SELECT *, raw_payment_count = target_valid_payment_count + quarantined_payment_rows AS raw_records_accounted_for,
         expected_valid_payment_count = target_valid_payment_count AS valid_payment_count_matches, expected_valid_payment_amount = target_valid_payment_amount AS valid_payment_amount_matches
  FROM merged_source, merged_target, (SELECT CAST(coalesce(sum(rows), 0) AS BIGINT) AS quarantined_payment_rows FROM merged_ledger)
)"""
reg(
    "pipeline_metrics",
    """SELECT 'PipelineSuccess' AS metric_name, CAST(CASE WHEN status = 'PASSED' THEN 1 ELSE 0 END AS BIGINT) AS value, 'Count' AS unit FROM migration_verdict
    UNION ALL SELECT 'RecordsProcessed', CAST((SELECT SUM(value) FROM quality_report WHERE section = 'valid_rows') AS BIGINT), 'Count'
    UNION ALL SELECT 'ValidPayments', target_valid_payment_count, 'Count' FROM migration_verdict
    UNION ALL SELECT 'QuarantinedRecords', CAST((SELECT SUM(value) FROM quality_report WHERE section = 'quarantined_rows') AS BIGINT), 'Count'
    UNION ALL SELECT 'ReconciliationPassed', CAST(CASE WHEN status = 'PASSED' THEN 1 ELSE 0 END AS BIGINT), 'Count' FROM migration_verdict
    UNION ALL SELECT 'QualityChecksCompleted', CAST(1 AS BIGINT), 'Count'""",
)
register("merged_ledger", "SELECT source_record_id, rejection_reason, rows FROM merged_ledger", [FIXTURES, SILVER, MERGE, MERGED_LEDGER])
register(
    "merged_reconciliation",
    f"""SELECT raw_payment_count, expected_valid_payment_count, {_d('expected_valid_payment_amount')}, target_valid_payment_count,
           {_d('target_valid_payment_amount')}, {_d('target_settled_amount')}, quarantined_payment_rows, raw_records_accounted_for,
           valid_payment_count_matches, valid_payment_amount_matches,
           CASE WHEN raw_records_accounted_for AND valid_payment_count_matches AND valid_payment_amount_matches THEN 'PASSED' ELSE 'FAILED' END AS status
    FROM merged_verdict""",
    [FIXTURES, SILVER, MERGE, MERGED_LEDGER],
)

register(
    "ordered_batches",
    f"""SELECT 'payments' AS source_table, 'payments-' || lpad(CAST(batch_number AS VARCHAR), 5, '0') AS batch_id, batch_number, count(*) AS record_count,
           CAST(arg_max(source_record_id, place) AS VARCHAR) AS last_source_key, arg_max(updated_at, place) AS watermark_after_batch
    FROM (SELECT source_record_id, updated_at, place, CAST((place - 1) // 1000 + 1 AS BIGINT) AS batch_number
          FROM (SELECT source_record_id, updated_at, ROW_NUMBER() OVER (ORDER BY updated_at, source_record_id) AS place FROM payments_raw WHERE updated_at <= {CUTOFF}))
    GROUP BY batch_number""",
    [FIXTURES],
)

_HASH = f"CAST('0x' || substr(sha256({_canon}), 1, 15) AS BIGINT)"
register(
    "content_checksum",
    f"""SELECT payment_status, count(*) AS record_count, bit_xor(h) AS digest_xor, CAST(sum(h) AS DOUBLE) AS digest_sum
    FROM (SELECT payment_status, {_HASH} AS h FROM payments_raw) GROUP BY payment_status""",
    [FIXTURES],
)
register(
    "differing_key_ranges",
    f"""SELECT 16 * coalesce(a.leaf, b.leaf) AS low_key, 16 * coalesce(a.leaf, b.leaf) + 15 AS high_key, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
    FROM (SELECT source_record_id // 16 AS leaf, count(*) AS n, list_sort(list({_HASH})) AS rows FROM payments_raw GROUP BY 1) a
    FULL JOIN (SELECT source_record_id // 16 AS leaf, count(*) AS n, list_sort(list({_HASH})) AS rows FROM payments_valid GROUP BY 1) b ON a.leaf = b.leaf
    WHERE a.rows IS DISTINCT FROM b.rows""",
    [FIXTURES, SILVER],
)
