"""Approximate nearest neighbours by inner product on shifted space-filling curves (operator 1).

Vectors get one more component that makes all norms equal, so that the largest
inner product is the smallest distance. Each ordering projects them onto a few
rotated directions, shifts the grid by an offset of its own, and numbers the
cells along a Hilbert curve. Every ordering is cut by its key into blocks of
equally many vectors, range-partitioned by Spark; a query meets its own block
and the two beside it, ends shifted inward. Scores are exact inner products of
the original vectors; the orderings' best merge, and the best of all remain.

The number of orderings and blocks is calibrated on a bounded sample (4,096
vectors, chosen by a hash of their id): the cheapest setting whose windows find
``target`` of the sample's nearest. Vectors without any structure thus get wide
windows, clustered ones narrow ones. Every vector is indexed; of equal vectors
only the ``limit`` + 1 smallest ids can ever be among a query's best, and only
those enter, so that one very common vector costs no more than any other.

A task streams over a block's vectors and holds a bounded number of queries
with their best so far; blocks with more queries are dealt to several tasks.

Defined results: vectors that are null, zero, not of the most common length, or
hold null or non-finite components take no part, nor do rows without an id;
rows that repeat an id are one vector (the smallest); ties go to the smaller
id; fewer candidates than ``limit`` are all returned; no vectors, no rows; other
columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeshift.llm.common import Stage, table

DIRECTIONS, BITS, TIE_BITS = 6, 8, 15
WINDOW = 3
QUERIES_AT_ONCE = 8192


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of cell numbers below 2 ** bits."""
    x = cells.astype(np.int64).T.copy()
    n = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:  # undo the turns and reflections, from the coarsest level down
        low = q - 1
        for i in range(n):
            flip = (x[i] & q) != 0
            swap = np.where(flip, 0, (x[0] ^ x[i]) & low)
            x[0] = np.where(flip, x[0] ^ low, x[0]) ^ swap
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    turned = np.zeros_like(x[0])
    q = top
    while q > 1:
        turned ^= np.where(x[n - 1] & q, q - 1, 0)
        q >>= 1
    x ^= turned
    out = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            out = (out << 1) | ((x[i] >> b) & 1)
    return out


@dataclass
class Curves:
    """Fitted orderings: rotated directions, ranges and shifts."""

    norm: float
    directions: np.ndarray  # ordering, component, direction
    low: np.ndarray
    span: np.ndarray
    shift: np.ndarray

    def keys(self, vectors: np.ndarray, ids: np.ndarray, ordering: int) -> np.ndarray:
        extra = np.sqrt(np.maximum(self.norm**2 - (vectors**2).sum(axis=1), 0))
        at = (np.column_stack([vectors, extra]) @ self.directions[ordering] - self.low[ordering]) / self.span[ordering]
        cells = np.floor((np.clip(at, 0, 1) * 0.5 + self.shift[ordering]) * (1 << BITS)).clip(0, (1 << BITS) - 1)
        tie = (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - TIE_BITS)  # equal cells can be cut too
        return (hilbert(cells, BITS) << TIE_BITS) | tie.astype(np.int64)


def fit(sample: np.ndarray, norm: float, orderings: int, seed: int = 11) -> Curves:
    """Directions: random rotations of the sample's main axes."""
    rng = np.random.default_rng(seed)
    full = np.column_stack([sample, np.sqrt(np.maximum(norm**2 - (sample**2).sum(axis=1), 0))])
    _, _, axes = np.linalg.svd(full - full.mean(axis=0), full_matrices=True)
    directions, low, span = [], [], []
    for k in range(orderings):
        wide = axes[: min(len(axes), DIRECTIONS * (k + 1))]
        turn, _ = np.linalg.qr(rng.standard_normal((max(len(wide), DIRECTIONS), DIRECTIONS)))
        own = wide.T @ turn[: len(wide)]
        at = full @ own
        a, b = np.quantile(at, [0.001, 0.999], axis=0)
        directions.append(own)
        low.append(a)
        span.append(np.maximum(b - a, 1e-9))
    return Curves(norm, np.array(directions), np.array(low), np.array(span), rng.uniform(0, 0.5, (orderings, DIRECTIONS)))


def calibrate(curves: Curves, ids: np.ndarray, sample: np.ndarray, total: int, limit: int, target: float) -> tuple[int, int]:
    """(orderings, blocks): the least work that finds ``target`` of the nearest in the sample.

    A sample of s out of N vectors stands for their density: the nearest
    ``limit`` of all correspond to about limit * s / N of the sample.
    """
    s = len(sample)
    if s < 2 * WINDOW:
        return len(curves.shift), 1
    near = min(max(1, -(-limit * s // max(total, 1))), s - 1)
    asked = np.linspace(0, s - 1, min(s, 512)).astype(int)
    scores = sample[asked] @ sample.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1, kind="stable")[:, :near]
    ranks = np.array([np.argsort(np.argsort(curves.keys(sample, ids, k), kind="stable"), kind="stable") for k in range(len(curves.shift))])
    choices = []
    for blocks in (1, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 48, 64, 96, 128, 192, 256, 384, 512, 768, 1024):
        if blocks * WINDOW > s:
            break
        block = ranks * blocks // s
        first = np.clip(block - WINDOW // 2, 0, max(0, blocks - WINDOW))
        found = np.zeros(best.shape, dtype=bool)
        for k in range(len(ranks)):
            there = block[k][best]
            found |= (there >= first[k][asked][:, None]) & (there < first[k][asked][:, None] + WINDOW)
            if found.mean() >= target and k:
                choices.append((blocks <= WINDOW, (k + 1) * min(1.0, WINDOW / blocks), k + 1, blocks))
                break
    # Windows that hold everything are the last resort, of tables too small to cut.
    _, _, orderings, blocks = min(choices, default=(True, 0, len(curves.shift), 1))
    return orderings, blocks


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def arrays(batch: pa.RecordBatch, name: str, size: int) -> np.ndarray:
    return batch.column(name).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


class Best:
    """The best candidates so far of some queries."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, limit: int):
        self.ids, self.vectors, self.limit = ids, vectors, limit
        self.floor = np.full(len(ids), -np.inf)
        self.query, self.found, self.score = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        fast = self.vectors @ vectors.T
        slack = 1e-9 * (1 + np.abs(self.floor, where=np.isfinite(self.floor), out=np.zeros(len(self.floor))))
        q, v = np.nonzero(fast >= (self.floor - slack)[:, None])
        own = ids[v] != self.ids[q]
        q, v = q[own], v[own]
        if len(q) > 4 * self.limit * len(self.ids):  # the first batches: take each query's best only
            cut = -np.partition(-fast, min(self.limit + 1, fast.shape[1] - 1), axis=1)[:, min(self.limit + 1, fast.shape[1] - 1)]
            near = fast[q, v] >= cut[q] - 1e-9 * (1 + np.abs(cut[q]))
            q, v = q[near], v[near]
        exact = np.empty(len(q))
        for k in range(0, len(q), 1 << 16):  # one order of summing for every pair, so that equal vectors tie
            s = slice(k, k + (1 << 16))
            exact[s] = (self.vectors[q[s]] * vectors[v[s]]).sum(axis=1)
        query, found, score = np.concatenate([self.query, q]), np.concatenate([self.found, ids[v]]), np.concatenate([self.score, exact])
        order = np.lexsort((found, -score, query))
        query, found, score = query[order], found[order], score[order]
        starts = np.searchsorted(query, np.arange(len(self.ids)))
        keep = np.arange(len(query)) - starts[query] < self.limit
        self.query, self.found, self.score = query[keep], found[keep], score[keep]
        counts = np.bincount(self.query, minlength=len(self.ids))
        full = counts == self.limit
        last = np.cumsum(counts) - 1
        self.floor[full] = self.score[last[full]]

    def batch(self) -> pa.RecordBatch:
        return pa.record_batch([pa.array(self.ids[self.query]), pa.array(self.found), pa.array(self.score)], names=["query_id", "vec_id", "score"])


def search(vectors: DataFrame, queries: Column, limit: int = 20, sample: int = 4096, orderings: int = 4, target: float = 0.97) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``limit`` nearest found of every vector (vec_id, embedding) that ``queries`` holds for."""
    spark = vectors.sparkSession
    stage = Stage(spark, "hilbert")
    good = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(F.col("vec_id").cast("long"), F.transform("embedding", lambda x: x.cast("double")).alias("embedding"))
    common = good.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "size").limit(1).collect()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    if not common:
        return empty
    size = common[0]["size"]
    base = stage.write(good.where(F.size("embedding") == size).groupBy("vec_id").agg(F.min("embedding").alias("embedding")), "base")
    same = W.partitionBy("embedding").orderBy("vec_id")
    able = base.withColumn("nth", F.row_number().over(same)).where(F.col("nth") <= limit + 1).drop("nth")
    able = stage.write(able, "able")
    norm2 = F.aggregate("embedding", F.lit(0.0), lambda total, x: total + x * x)
    facts = able.agg(F.count("*").alias("n"), F.max(norm2).alias("norm2")).collect()[0]
    total, norm = facts["n"], float(np.sqrt(facts["norm2"]))
    place = F.pmod(F.xxhash64("vec_id"), F.lit(1_000_003))
    chosen = able.where(place < F.lit(int(1_000_003 * min(1.0, sample / total)) + 1)).toPandas().sort_values("vec_id")  # about `sample` rows
    if chosen.empty:
        chosen = able.limit(1).toPandas()
    points = np.array(chosen["embedding"].tolist(), dtype=np.float64)
    curves = fit(points, norm, orderings)
    used, blocks = calibrate(curves, chosen["vec_id"].to_numpy(), points, total, limit, target)

    def keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, own = batch.column("vec_id").to_numpy(), arrays(batch, "embedding", size)
            for k in range(used):
                yield pa.record_batch([pa.array(np.full(len(ids), k, np.int32)), pa.array(curves.keys(own, ids, k)), batch.column("vec_id")], names=["ordering", "key", "vec_id"])

    schema = "ordering int, key long, vec_id long"
    parts = [i / blocks for i in range(1, blocks)]
    cuts = np.zeros((used, len(parts)), dtype=np.int64)
    if parts:  # a few borders for each ordering
        for row in able.mapInArrow(keyed, schema).groupBy("ordering").agg(F.percentile_approx("key", parts, 20_000).alias("at")).collect():
            cuts[row["ordering"]] = row["at"]
    asking = base.where(queries)
    n_queries = asking.count()
    chunks = max(1, -(-int(n_queries * min(1.0, WINDOW / blocks)) // QUERIES_AT_ONCE))

    def placed(asked: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids, own = batch.column("vec_id").to_numpy(), arrays(batch, "embedding", size)
                for k in range(used):
                    block = np.searchsorted(cuts[k], curves.keys(own, ids, k), side="left")
                    first = np.clip(block - WINDOW // 2, 0, max(0, blocks - WINDOW)) if asked else block
                    for step in range(min(WINDOW, blocks) if asked else 1):
                        for chunk in [None] if asked else range(chunks):
                            dealt = (ids % chunks if chunk is None else np.full(len(ids), chunk)).astype(np.int32)
                            yield pa.record_batch([pa.array((k * blocks + first + step).astype(np.int32)), pa.array(dealt), pa.array(np.full(len(ids), 0 if asked else 1, np.int32)), *batch.columns], names=["cell", "chunk", "kind", "vec_id", "embedding"])

        return run

    placing = "cell int, chunk int, kind int, vec_id long, embedding array<double>"
    dealt = asking.select("vec_id", "embedding").mapInArrow(placed(True), placing).union(able.select("vec_id", "embedding").mapInArrow(placed(False), placing))
    dealt = dealt.repartitionByRange(used * blocks * chunks, "cell", "chunk").sortWithinPartitions("cell", "chunk", "kind", "vec_id")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, best = None, [], None
        for batch in batches:
            cell, kind = (batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "kind"))
            group = (cell * chunks + batch.column("chunk").to_numpy()) * 2 + kind
            edges = np.flatnonzero(np.diff(group)) + 1
            for a, b in zip([0, *edges], [*edges, len(group)], strict=True):
                part = batch.slice(a, b - a)
                if not len(part):
                    continue
                if now != group[a] // 2:
                    if best is not None:
                        yield best.batch()
                    now, held, best = group[a] // 2, [], None
                ids, own = part.column("vec_id").to_numpy(), arrays(part, "embedding", size)
                if kind[a] == 0:
                    held.append((ids, own))
                elif held or best:
                    if best is None:
                        best = Best(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), limit)
                        held = []
                    for k in range(0, len(ids), 1024):
                        best.meet(ids[k : k + 1024], own[k : k + 1024])
        if best is not None:
            yield best.batch()

    found = dealt.mapInArrow(scan, "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    nth = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return merged.withColumn("rank", nth).where(F.col("rank") <= limit).select("query_id", "rank", "vec_id", "score")


def op1_hilbert_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), F.col("vec_id") % 20 == 0)
