"""lakeshift: Spark-native migration and lakehouse analytics.

Operators are plain functions from DataFrames to DataFrames; jobs in
``lakeshift.plans.jobs`` compose them into runs that read and write
immutable run directories.
"""

from lakeshift.functions.rules import Rule, classify, positive, present, required, split
from lakeshift.operators.dedup import flag_latest, latest_by_key, split_duplicates
from lakeshift.operators.joins import flag_exists, orphans, semi, without_keys
from lakeshift.operators.reconcile import merchant_daily_metrics, reconcile, reconciliation_summary, settlement_totals, target_totals, top_merchants
from lakeshift.operators.scd2 import scd2_as_of, scd2_changes, scd2_init, scd2_merge
from lakeshift.operators.upsert import upsert_latest, upsert_latest_parts, upsert_replace
from lakeshift.sources.incremental import advance_watermark, changes_since, latest_watermark

__version__ = "0.1.0"

__all__ = [
    "Rule", "classify", "positive", "present", "required", "split",
    "flag_latest", "latest_by_key", "split_duplicates",
    "flag_exists", "orphans", "semi", "without_keys",
    "merchant_daily_metrics", "reconcile", "reconciliation_summary", "settlement_totals", "target_totals", "top_merchants",
    "scd2_as_of", "scd2_changes", "scd2_init", "scd2_merge",
    "upsert_latest", "upsert_latest_parts", "upsert_replace",
    "advance_watermark", "changes_since", "latest_watermark",
]
