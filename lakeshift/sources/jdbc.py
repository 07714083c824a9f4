"""Relational sources over JDBC (S1, S2 pushdown).

A full snapshot is one partitioned scan instead of keyset paging: dense numeric
keys use Spark's range partitioning (``column``/``lowerBound``/``upperBound``/
``numPartitions``); text and sparse keys are cut into key ranges of about as many
rows each, by borders from a bounded sample, so that each partition reads its
own range of the key's index and nothing else. Filters applied to
the result (e.g. ``changes_since``) are pushed into each partition's ``WHERE``.
"""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Distinct keys, with their numbers of rows, that borders are computed from at most.
KEY_SAMPLE = 100_000


def key_borders(df: DataFrame, key: str, parts: int, sample: int = KEY_SAMPLE) -> list:
    """At most ``parts`` - 1 ascending keys that cut the rows into ranges of about as many each.

    The sample is those ``sample`` distinct keys whose hashes are smallest, with
    their counts, so a key of many rows weighs as much as it has and takes no
    more room than any other. Such a key is a range of its own.
    """
    counts = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    chosen = sorted(tuple(r) for r in counts.orderBy(F.xxhash64("key"), "key").limit(sample).collect())
    step = sum(n for _, n in chosen) / max(parts, 1)
    borders, filled, hot = [], 0, False
    for k, n in chosen:
        full = filled >= step or (n >= step and filled > 0) or hot
        if full and len(borders) < parts - 1:
            borders.append(k)
            filled = 0
        filled += n
        hot = n >= step
    return borders


def _literal(value) -> str:
    if isinstance(value, (int, Decimal)):
        return str(value)
    if isinstance(value, (str, datetime, date)):
        return "'" + str(value).replace("'", "''") + "'"
    raise TypeError(f"no border can be a {type(value).__name__}")


def range_predicates(key: str, borders: list, ordered: str = "{key}") -> list[str]:
    """Disjoint predicates that cover every row: one for each range between ascending borders.

    NULL keys go to the first. ``ordered`` is the key as the database compares it in the
    borders' order, such as ``{key} COLLATE "C"`` for text.
    """
    if not borders:
        return ["1 = 1"]
    k, cuts = ordered.format(key=key), [_literal(b) for b in borders]
    inner = [f"{k} >= {low} AND {k} < {high}" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [f"{k} < {cuts[0]} OR {key} IS NULL", *inner, f"{k} >= {cuts[-1]}"]


def key_bounds(spark: SparkSession, url: str, table: str, key: str, properties: dict | None = None) -> tuple:
    """(min, max) of a numeric key, computed by the database (one tiny row)."""
    q = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {table}) bounds"
    row = spark.read.jdbc(url, q, properties=properties or {}).first()
    return row["lo"], row["hi"]


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str | None = None,
    num_partitions: int = 8,
    properties: dict | None = None,
    dense_key: bool = True,
    fetch_size: int = 50_000,
    ordered: str = "{key}",
) -> DataFrame:
    """Snapshot of a source table as a partitioned DataFrame.

    ``dense_key``: the key is numeric and without large gaps; else the partitions
    are key ranges of equal depth (one more scan, of the key alone).
    """
    props = {"fetchsize": str(fetch_size), **(properties or {})}
    if key is None or num_partitions <= 1:
        return spark.read.jdbc(url, table, properties=props)
    if dense_key:
        lo, hi = key_bounds(spark, url, table, key, props)
        if lo is None:
            return spark.read.jdbc(url, table, properties=props)
        return spark.read.jdbc(url, table, column=key, lowerBound=int(lo), upperBound=int(hi) + 1, numPartitions=num_partitions, properties=props)
    borders = key_borders(spark.read.jdbc(url, f"(SELECT {key} FROM {table}) keys", properties=props), key, num_partitions)
    return spark.read.jdbc(url, table, predicates=range_predicates(key, borders, ordered), properties=props)
