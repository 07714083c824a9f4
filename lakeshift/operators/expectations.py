"""Data-quality expectations as Spark aggregates.

All scalar expectations of a dataset are evaluated in ONE aggregation pass
(``count_if`` per expectation), then unpivoted to one row per expectation.
Uniqueness needs a grouping of its own; it is a partial/final hash
aggregate, so a heavily duplicated value is collapsed map-side.

Result schema: ``dataset, expectation, column_name, element_count,
unexpected_count, success``.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeshift.operators.joins import orphans


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    min_value: object = None
    max_value: object = None
    values: tuple = field(default_factory=tuple)

    @property
    def name(self) -> str:
        # Expectation names as they appear in quality reports.
        return {
            "not_null": "expect_column_values_to_not_be_null",
            "unique": "expect_column_values_to_be_unique",
            "between": "expect_column_values_to_be_between",
            "in_set": "expect_column_values_to_be_in_set",
        }[self.kind]


def not_null(column: str) -> Expectation:
    return Expectation("not_null", column)


def unique(column: str) -> Expectation:
    """NULLs are ignored; every member of a duplicated value is unexpected."""
    return Expectation("unique", column)


def between(column: str, min_value=None, max_value=None) -> Expectation:
    """Inclusive bounds, NULLs ignored; a missing bound is open."""
    return Expectation("between", column, min_value=min_value, max_value=max_value)


def in_set(column: str, values) -> Expectation:
    """NULLs ignored."""
    return Expectation("in_set", column, values=tuple(values))


def _lit(v) -> Column:
    if isinstance(v, float):
        v = Decimal(str(v))
    return F.lit(v)


def unexpected(e: Expectation) -> Column:
    c = F.col(e.column)
    if e.kind == "not_null":
        return c.isNull()
    if e.kind == "between":
        bad = F.lit(False)
        if e.min_value is not None:
            bad = bad | (c < _lit(e.min_value))
        if e.max_value is not None:
            bad = bad | (c > _lit(e.max_value))
        return c.isNotNull() & bad
    if e.kind == "in_set":
        return c.isNotNull() & ~c.isin(list(e.values))
    raise ValueError(f"not a row-level expectation: {e.kind}")


def _scalar_results(df: DataFrame, dataset: str, checks: list[Expectation]) -> DataFrame:
    aggs = [F.count(F.lit(1)).alias("_n")] + [F.count_if(unexpected(e)).alias(f"_u{i}") for i, e in enumerate(checks)]
    wide = df.agg(*aggs)
    entries = [F.struct(F.lit(e.name).alias("expectation"), F.lit(e.column).alias("column_name"), F.col(f"_u{i}").alias("unexpected_count")) for i, e in enumerate(checks)]
    return wide.select(F.col("_n").alias("element_count"), F.explode(F.array(*entries)).alias("_e")).select(
        F.lit(dataset).alias("dataset"), "_e.expectation", "_e.column_name", "element_count", "_e.unexpected_count"
    )


def _unique_result(df: DataFrame, dataset: str, e: Expectation) -> DataFrame:
    counts = df.groupBy(e.column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("element_count"),
        F.coalesce(F.sum(F.when(F.col(e.column).isNotNull() & (F.col("_n") > 1), F.col("_n"))), F.lit(0)).alias("unexpected_count"),
    ).select(F.lit(dataset).alias("dataset"), F.lit(e.name).alias("expectation"), F.lit(e.column).alias("column_name"), "element_count", "unexpected_count")


def run_expectations(df: DataFrame, dataset: str, expectations: list[Expectation]) -> DataFrame:
    """Evaluate expectations on one dataset; one result row per expectation."""
    scalar = [e for e in expectations if e.kind != "unique"]
    parts = [_scalar_results(df, dataset, scalar)] if scalar else []
    parts += [_unique_result(df, dataset, e) for e in expectations if e.kind == "unique"]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("unexpected_count", F.col("unexpected_count").cast("long")).withColumn(
        "element_count", F.col("element_count").cast("long")
    ).withColumn("success", F.col("unexpected_count") == 0)


def references(child: DataFrame, fk: str, parent: DataFrame, pk: str, dataset: str, name: str | None = None) -> DataFrame:
    """Referential integrity (E5): orphan count must be zero."""
    return orphans(child, fk, parent, pk).agg(F.count(F.lit(1)).alias("unexpected_count")).select(
        F.lit(dataset).alias("dataset"),
        F.lit(name or f"{dataset}.{fk}_exists").alias("expectation"),
        F.lit(fk).alias("column_name"),
        F.lit(None).cast("long").alias("element_count"),
        F.col("unexpected_count").cast("long").alias("unexpected_count"),
        (F.col("unexpected_count") == 0).alias("success"),
    )


def suite_verdict(results: DataFrame) -> DataFrame:
    """Add the overall PASSED/FAILED verdict to every result row.

    The result set holds one row per expectation (bounded by the suite, not by
    the data), so an unpartitioned window over it is a single tiny task and
    avoids evaluating the expectations a second time.
    """
    everything = Window.partitionBy()
    return results.withColumn(
        "suite_status", F.when(F.bool_and("success").over(everything), F.lit("PASSED")).otherwise(F.lit("FAILED"))
    )
