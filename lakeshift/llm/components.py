"""Connected components of a link table, by alternating large and small stars.

Every task first thins its own links to a forest of stars. Then each round
replaces every node's links by links to the smallest neighbour, in joins whose
inputs are written tables, so that a hub's many links can be split over tasks;
the number of rounds grows with the logarithm of the size.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift.llm.common import Stage

#: Links that one task thins at once.
LINKS_AT_ONCE = 500_000


def _thinned(links: DataFrame) -> DataFrame:
    """Links (u, v), u > v, that connect what each run of links does, with a star for each component."""

    def stars(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        parent: dict[int, int] = {}

        def top(x: int) -> int:
            parent.setdefault(x, x)
            while parent[x] != x:
                parent[x] = x = parent[parent[x]]
            return x

        for a, b in pairs:
            x, y = top(a), top(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
        out = [(x, top(x)) for x in parent if parent[x] != x]
        return pa.record_batch([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int]] = []
        for batch in batches:
            held += zip(batch.column("a").to_pylist(), batch.column("b").to_pylist(), strict=True)
            if len(held) >= LINKS_AT_ONCE:
                yield stars(held)
                held = []
        yield stars(held)

    return links.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b")).mapInArrow(run, "u long, v long")


def _star(links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(u, v) with each u's smallest neighbour or itself as ``least``."""
    least = stage.write(links.groupBy("u").agg(F.min("v").alias("least")), f"{name}_least")
    return links.join(least, "u").withColumn("least", F.least("u", "least"))


def _all_stars(edges: DataFrame) -> bool:
    """Whether every u has one link, to a v that has none of its own."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    ends = ends.union(edges.select(F.col("v").alias("node"), F.lit(0), F.lit(1)))
    counts = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return counts.where("up > 1 or (up > 0 and down > 0)").isEmpty()


def components(links: DataFrame, stage: Stage, name: str = "components") -> DataFrame:
    """(node, root) of every node that the links (a, b) of whole numbers join to another; root is the smallest of its component.

    Thinned links that one task may hold at once are joined there, without rounds.
    """
    edges, step = stage.write(_thinned(links).distinct(), f"{name}_0"), 0
    few = edges.limit(LINKS_AT_ONCE).count() < LINKS_AT_ONCE
    if few:
        edges = stage.write(_thinned(edges.toDF("a", "b").coalesce(1)), f"{name}_all")
    while not few and not _all_stars(edges):
        step += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both, stage, f"{name}_{step}_large").where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("least").alias("v")).where("u <> v").distinct()
        large = stage.write(large, f"{name}_{step}_mid")
        small = _star(large, stage, f"{name}_{step}_small")
        small = small.select("u", F.col("least").alias("v")).union(small.select(F.col("v").alias("u"), F.col("least").alias("v"))).where("u <> v").distinct()
        edges = stage.write(small, f"{name}_{step}")
        for used in (f"{step}_large_least", f"{step}_mid", f"{step}_small_least", f"{step - 1}"):
            stage.drop(f"{name}_{used}")
    roots = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return roots.union(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def joined_roots(roots: DataFrame, links: DataFrame, stage: Stage, name: str) -> DataFrame:
    """(node, root) after more links (a, b): only the components that they touch are joined anew."""
    ends = links
    for end in ("a", "b"):
        ends = ends.join(roots.withColumnsRenamed({"node": end, "root": f"{end}_root"}), end, "left")
    ends = ends.select(F.coalesce("a_root", "a").alias("a"), F.coalesce("b_root", "b").alias("b"))
    above = stage.write(components(ends, stage, name), f"{name}_above")
    known = roots.join(above.toDF("root", "new"), "root", "left").select("node", F.coalesce("new", "root").alias("root"))
    return known.union(above.join(roots.select("node"), "node", "left_anti"))
