"""Upserts of a change set into a current-state snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from lakeshift.operators.dedup import DEFAULT_ORDER, latest_by_key
from lakeshift.operators.joins import without_keys


def upsert_replace(base: DataFrame, changes: DataFrame, key: str, order: Sequence[str] = ("updated_at",)) -> DataFrame:
    """Change always wins (U1): the latest change per key replaces the base row,
    regardless of how its timestamp compares with the base row."""
    latest = latest_by_key(changes, key, order)
    return without_keys(base, latest, key).unionByName(latest.select(*base.columns))


def upsert_latest(base: DataFrame, changes: DataFrame, key: str, order: Sequence[str] = DEFAULT_ORDER, base_unique: bool = False) -> DataFrame:
    """Newest wins (U2/U3): a stale late arrival does not overwrite a newer row.

    With ``base_unique`` (the base is a snapshot with one row per key) only
    the keys present in the change set are re-ranked: untouched base rows pass
    through an anti join and the touched ones (semi join) compete with the
    changes. When the change set is small AQE broadcasts its keys, so the
    base is streamed once and never shuffled; otherwise both joins share one
    exchange of the base. Without it, the whole union is re-ranked, which also
    deduplicates a base that is not unique.
    """
    if not base_unique:
        latest = latest_by_key(changes, key, order).select(*base.columns)
        return latest_by_key(base.unionByName(latest), key, order)
    untouched, resolved = upsert_latest_parts(base, changes, key, order)
    return untouched.unionByName(resolved)


def upsert_latest_parts(base: DataFrame, changes: DataFrame, key: str, order: Sequence[str] = DEFAULT_ORDER) -> tuple[DataFrame, DataFrame]:
    """Key-scoped newest-wins upsert of a unique-per-key base, in two parts:
    (base rows whose key has no change, re-ranked rows of the changed keys).

    The parts keep different layouts: the first streams straight from the
    base scan (its file/partition layout intact), the second is small and
    shuffled by key, so a writer can rebalance just that part.
    """
    latest = latest_by_key(changes, key, order).select(*base.columns)
    keys = latest.select(key)
    # A USING-style join lists the key first; keep the base's column order.
    untouched = base.join(keys, key, "left_anti").select(*base.columns)
    touched = base.join(keys, key, "left_semi").select(*base.columns)
    return untouched, latest_by_key(touched.unionByName(latest), key, order)
