"""Row-validation rules as Column predicates.

A rule set is an ordered list of ``Rule(reason, predicate)``; ``classify``
compiles it into a single CASE expression, so the first true predicate wins
and evaluation stays inside whole-stage codegen.
"""

from __future__ import annotations

import functools
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.functions.columns import col


@dataclass(frozen=True)
class Rule:
    reason: str
    predicate: Column


def required(c: str | Column) -> Column:
    """True when the field is missing: NULL, or blank after trimming spaces."""
    return col(c).isNull() | (F.trim(col(c)) == "")


def present(c: str | Column) -> Column:
    """Negation of ``required`` that is never NULL."""
    return col(c).isNotNull() & (F.trim(col(c)) != "")


def positive(c: str | Column) -> Column:
    """True when an amount is rejected: NULL or not strictly positive."""
    return col(c).isNull() | (col(c) <= 0)


def missing(c: str | Column) -> Column:
    return col(c).isNull()


def reason_of(rules: list[Rule]) -> Column:
    """First-match rejection reason; NULL when the row passes every rule."""
    expr = None
    for rule in rules:
        expr = F.when(rule.predicate, F.lit(rule.reason)) if expr is None else expr.when(rule.predicate, F.lit(rule.reason))
    return expr if expr is not None else F.lit(None).cast("string")


def classify(df: DataFrame, rules: list[Rule], name: str = "rejection_reason") -> DataFrame:
    """Attach the first-match rejection reason."""
    return df.withColumn(name, reason_of(rules))


def split(classified: DataFrame, name: str = "rejection_reason") -> tuple[DataFrame, DataFrame]:
    """(accepted rows without the reason column, rejected rows with it)."""
    accepted = classified.filter(F.col(name).isNull()).drop(name)
    rejected = classified.filter(F.col(name).isNotNull())
    return accepted, rejected


def changed(columns: list[str], left: str, right: str) -> Column:
    """Null-safe 'any tracked column differs' predicate."""
    parts = [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns]
    return functools.reduce(lambda a, b: a | b, parts)


def quarantine(df: DataFrame, table: str, reason: str | None = None, as_of=None) -> DataFrame:
    """Quarantine metadata (P7). ``reason=None`` keeps an existing reason column."""
    out = df
    if reason is not None:
        out = out.withColumn("rejection_reason", F.lit(reason))
    out = out.withColumn("source_table", F.lit(table))
    if as_of is not None:
        out = out.withColumn("quarantined_at", F.lit(as_of).cast("timestamp"))
    return out
