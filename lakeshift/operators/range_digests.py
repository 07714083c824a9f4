"""Comparing two tables by a tree of range digests.

A leaf is a range of ``leaf`` consecutive keys; its digest is the number of its
rows with the XOR and the sum of their digests, which depend on no order and
combine, so that a range of ``fanout`` ranges needs no row again. Each table is
read once, by a partial aggregate; its leaves are written. The comparison then
starts with the widest ranges and goes on only below those that differ, so equal
tables end after one step and a few changed rows cost a few paths of the tree.
The rows themselves are looked at in differing leaves alone.

Rows without a key are a range of their own, without bounds.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeshift.operators.joins import fits_broadcast
from lakeshift.sinks.manifest import digest_folds, row_digest

FOLDS = ["record_count", "digest_xor", "digest_sum"]


def _range_of(key: Column, size: int) -> Column:
    """Number of the range of ``size`` keys that holds a key, also for negative keys."""
    # Whole-number division: the remainder is taken off first.
    return F.floor((key - F.pmod(key, F.lit(size).cast("long"))).cast("decimal(38,0)") / F.lit(size).cast("decimal(20,0)")).cast("long")


def leaf_digests(df: DataFrame, key: str, leaf: int, columns: Sequence[str] | None = None) -> DataFrame:
    """(node, record_count, digest_xor, digest_sum) of each range of ``leaf`` keys."""
    numbered = df.withColumn("_node", _range_of(F.col(key).cast("long"), leaf))
    return numbered.groupBy(F.col("_node").alias("node")).agg(*digest_folds(df, list(columns) if columns else None))


def _wider(leaves: DataFrame, size: int) -> DataFrame:
    folds = [F.sum("record_count").alias("record_count"), F.bit_xor("digest_xor").alias("digest_xor"), F.sum("digest_sum").cast("decimal(38,0)").alias("digest_sum")]
    return leaves.groupBy(_range_of(F.col("node"), size).alias("node")).agg(*folds)


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """(node, left_rows, right_rows) of the nodes whose digests differ; a node that one side lacks has no rows there."""
    r = right.select(F.col("node").alias("_node"), *[F.col(c).alias(f"_{c}") for c in FOLDS], F.lit(True).alias("_there"))
    both = left.withColumn("there", F.lit(True)).join(r, F.col("node").eqNullSafe(F.col("_node")), "full_outer")
    same = F.col("there") & F.col("_there")
    for c in FOLDS:
        same = same & (F.col(c) == F.col(f"_{c}"))
    rows = [F.coalesce(c, F.lit(0).cast("long")) for c in ("record_count", "_record_count")]
    return both.where(~F.coalesce(same, F.lit(False))).select(F.coalesce("node", "_node").alias("node"), rows[0].alias("left_rows"), rows[1].alias("right_rows"))


def differing_leaves(left: DataFrame, right: DataFrame, staged: Callable[[DataFrame, str], DataFrame], fanout: int = 64) -> DataFrame:
    """The leaves (node, left_rows, right_rows) in which two written tables of leaf digests differ."""
    ends = left.select("node").union(right.select("node")).agg(F.min("node"), F.max("node")).first()
    span = 0 if ends[0] is None else max(abs(ends[0]), abs(ends[1])) + 1
    size = 1
    while size < span:
        size *= fanout
    found = None
    while True:
        pair = []
        for side in (left, right):
            if found is not None:  # only what is below the ranges found so far
                above = found.select(F.col("node").alias("_above"))
                above = F.broadcast(above) if fits_broadcast(above) else above
                side = side.join(above, _range_of(F.col("node"), size * fanout).eqNullSafe(F.col("_above")), "left_semi")
            pair.append(_wider(side, size))
        found = staged(_differing(*pair), f"differing_{size}")
        if size == 1 or found.isEmpty():
            return found
        size //= fanout


def differing_ranges(left: DataFrame, right: DataFrame, key: str, leaf: int, staged: Callable[[DataFrame, str], DataFrame], columns: Sequence[str] | None = None, fanout: int = 64) -> DataFrame:
    """(low_key, high_key, left_rows, right_rows) of the key ranges in which two tables differ.

    ``columns``: what is compared (all of the left table's, by default); ``staged`` writes a table and reads it back.
    """
    names = list(columns or left.columns)
    a, b = (staged(leaf_digests(df.select(*dict.fromkeys([key, *names])), key, leaf, names), f"leaves_{side}") for df, side in ((left, "left"), (right, "right")))
    found = differing_leaves(a, b, staged, fanout)
    low = F.col("node") * F.lit(leaf).cast("long")
    return found.select(low.alias("low_key"), (low + F.lit(leaf - 1).cast("long")).alias("high_key"), "left_rows", "right_rows")


def differing_rows(left: DataFrame, right: DataFrame, key: str, leaf: int, staged: Callable[[DataFrame, str], DataFrame], columns: Sequence[str] | None = None) -> DataFrame:
    """(key, row_digest, left_rows, right_rows) of the rows that one table has more often than the other, read in differing ranges alone."""
    names = list(columns or left.columns)
    ranges = differing_ranges(left, right, key, leaf, staged, names).select(_range_of(F.col("low_key"), leaf).alias("_node"))
    ranges = F.broadcast(ranges) if fits_broadcast(ranges) else ranges
    parts = []
    for df, counts in ((left, (1, 0)), (right, (0, 1))):
        inside = df.join(ranges, _range_of(F.col(key).cast("long"), leaf).eqNullSafe(F.col("_node")), "left_semi")
        parts.append(inside.select(F.col(key).alias(key), row_digest(df, names).alias("row_digest"), *[F.lit(n).alias(c) for n, c in zip(counts, ("l", "r"), strict=True)]))
    rows = parts[0].union(parts[1]).groupBy(key, "row_digest").agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows"))
    return rows.where("left_rows <> right_rows")
