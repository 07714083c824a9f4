"""Hard negatives by exact scores from subset-sum tables (operator 12).

Every component becomes a whole number, floor(scale * x). A candidate is stored
as bit planes: for each bit of its two's complement numbers, one byte for each
eight dimensions. For an anchor, a table holds the sums of all 256 subsets of
each eight of its components; a plane's byte picks the sum of the components
whose bit is set, and the planes' sums, shifted and added, are the exact inner
product. Tables of a batch of anchors lie side by side, so that one lookup
serves them all.

Spark deals candidates into cells of bounded size, and anchors to the cells
they need: first to the cells of their own label, for their best rows of the
same label, the positives; then to all, for the best rows of other labels at or
under each positive's score. A task holds one cell's planes and streams the
anchors past it; it gives a few rows for each anchor, which are ranked at last.
A label that holds most rows has many cells, and equal vectors cost no more
than others: candidates come in the order of their ids, so that ties never
displace what is held.

Defined results: rows with a null id, label or vector, or with a null or
non-finite component take no part, nor do vectors not of the most common length
(the shorter of two as common); rows that repeat an id are one (the smallest by
label and numbers); ties go to the smaller id; an anchor without positives, or
a positive without negatives, gives no rows; fewer than wanted are all given;
an empty table gives no rows; other columns are ignored, whatever their names.
Components so large that scores could exceed 64 bits are an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeshift.llm.common import Stage, table

#: Candidates of a cell at most (about 100 bytes each in memory) and, where rows are few, at least.
CELL, SMALL_CELL = 1 << 19, 1024
#: Anchors whose tables lie side by side, and candidates that are looked up at once.
ANCHORS_AT_ONCE, CANDIDATES_AT_ONCE = 64, 2048

RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def bit_planes(numbers: np.ndarray, bits: int) -> np.ndarray:
    """(row, plane, group): bit p of eight components a byte; the last plane is the sign."""
    n, size = numbers.shape
    groups = -(-size // 8)
    wide = np.zeros((n, groups * 8), dtype=np.int64)
    wide[:, :size] = numbers
    return np.stack([np.packbits(((wide >> p) & 1).astype(np.uint8).reshape(n, groups, 8), axis=2, bitorder="little")[:, :, 0] for p in range(bits)], axis=1)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """(group, byte, anchor): the sum of those of a group's eight components whose bit is set in the byte."""
    n, size = anchors.shape
    groups = -(-size // 8)
    wide = np.zeros((groups * 8, n), dtype=kind)
    wide[:size] = anchors.T
    sums = np.zeros((groups, 256, n), dtype=kind)
    for k in range(8):
        sums[:, 1 << k : 2 << k] = sums[:, : 1 << k] + wide[k::8][:, None, :]
    return sums


def scores(sums: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """(candidate, anchor): exact inner products."""
    n, bits, groups = planes.shape
    total = np.zeros((n, sums.shape[2]), dtype=sums.dtype)
    for p in range(bits - 1, -1, -1):  # from the sign's plane down
        part = sums[0][planes[:, p, 0]]
        for g in range(1, groups):
            part += sums[g][planes[:, p, g]]
        total <<= 1
        total += -part if p == bits - 1 else part
    return total


class Slots:
    """The best candidates so far of slots: each an anchor's, with the least and the greatest score it takes."""

    def __init__(self, anchor: np.ndarray, least: np.ndarray, most: np.ndarray, limit: int):
        self.limit, self.most = limit, most
        n = int(anchor[-1]) + 1 if len(anchor) else 0
        self.first = np.searchsorted(anchor, np.arange(n))
        self.count = np.searchsorted(anchor, np.arange(n), side="right") - self.first
        self.bar = least - 1  # only scores above it enter
        self.top = np.maximum.reduceat(most, self.first) if n else most
        self.slot, self.found, self.score = (np.empty(0, np.int64) for _ in range(3))
        self.floor = np.minimum.reduceat(self.bar, self.first) if n else self.bar

    def offer(self, anchor: np.ndarray, found: np.ndarray, score: np.ndarray) -> None:
        """Candidates in the order of their ids, and of larger ids than all before."""
        slots, at = [self.slot], [np.arange(0)]
        for k in range(int(self.count.max(initial=0))):
            slot = self.first[anchor] + k
            fits = np.flatnonzero(self.count[anchor] > k)
            fits = fits[(score[fits] > self.bar[slot[fits]]) & (score[fits] <= self.most[slot[fits]])]
            slots.append(slot[fits])
            at.append(fits)
        if not any(map(len, at)):
            return
        at = np.concatenate(at)
        slot, found, score = np.concatenate(slots), np.concatenate([self.found, found[at]]), np.concatenate([self.score, score[at]])
        order = np.lexsort((found, -score, slot))
        slot, found, score = slot[order], found[order], score[order]
        keep = np.arange(len(slot)) - np.searchsorted(slot, slot) < self.limit
        self.slot, self.found, self.score = slot[keep], found[keep], score[keep]
        held = np.bincount(self.slot, minlength=len(self.bar))
        full = held == self.limit
        self.bar[full] = self.score[np.cumsum(held)[full] - 1]
        self.floor = np.minimum.reduceat(self.bar, self.first)


class Cell:
    """The candidates of one cell, in the order of their ids."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, planes: np.ndarray):
        self.ids, self.labels, self.planes = ids, labels, planes

    def best(self, ids: np.ndarray, labels: np.ndarray, numbers: np.ndarray, slots: Slots, same: bool, kind: type) -> None:
        """Offers a batch of anchors what this cell has of their own label, or of all others."""
        sums, limit = subset_sums(numbers, kind), np.iinfo(kind).max  # beyond all scores
        for k in range(0, len(self.ids), CANDIDATES_AT_ONCE):
            part = slice(k, k + CANDIDATES_AT_ONCE)
            of = scores(sums, self.planes[part])
            floor, top = (np.clip(x, -limit, limit).astype(kind) for x in (slots.floor, slots.top))
            row, anchor = np.nonzero((of > floor) & (of <= top))
            score = of[row, anchor].astype(np.int64)
            row += k
            fits = (self.labels[row] == labels[anchor]) & (self.ids[row] != ids[anchor]) if same else self.labels[row] != labels[anchor]
            slots.offer(anchor[fits], self.ids[row[fits]], score[fits])


DEALT = "home long, cell int, kind int, vec_id long, label long, planes binary, numbers array<long>, positives array<long>, scores array<long>"


def met(dealt: DataFrame, size: int, bits: int, kind: type, limit: int, same: bool, low: int) -> DataFrame:
    """(anchor_id, positive_id, positive_score, vec_id, score) of each cell and anchor, rows sorted by cell, kind and id.

    With ``same``, the best of the anchor's own label (no positive); else for
    each positive the best of other labels from ``low`` per cent of its score up to it.
    """
    groups = -(-size // 8)

    def lists(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)

    def asked(cell: Cell, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for k in range(0, len(rows), ANCHORS_AT_ONCE):
            part = rows.slice(k, ANCHORS_AT_ONCE)
            ids, labels = part.column("vec_id").to_numpy(), part.column("label").to_numpy()
            numbers = lists(part.column("numbers")).reshape(-1, size)
            if same:
                anchor, positive = np.arange(len(ids)), np.full(len(ids), -1)
                least, most = np.full(len(ids), -(1 << 62)), np.full(len(ids), 1 << 62)
            else:
                each = part.column("positives")
                anchor = np.repeat(np.arange(len(ids)), each.value_lengths().to_numpy(zero_copy_only=False))
                positive, most = lists(each), lists(part.column("scores"))
                least = -(-low * most // 100)
            slots = Slots(anchor, least, most, limit)
            cell.best(ids, labels, numbers, slots, same, kind)
            s = slots.slot
            yield pa.record_batch([pa.array(x) for x in (ids[anchor[s]], positive[s], most[s], slots.found, slots.score)], names=["anchor_id", "positive_id", "positive_score", "vec_id", "score"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, cell = None, [], None
        for batch in batches:
            home, place, sort = (batch.column(c).to_numpy().astype(np.int64) for c in ("home", "cell", "kind"))
            edges = np.flatnonzero((np.diff(home) != 0) | (np.diff(place) != 0) | (np.diff(sort) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(home)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if now != (home[a], place[a]):
                    now, held, cell = (home[a], place[a]), [], None
                if sort[a] == 0:
                    planes = np.frombuffer(b"".join(part.column("planes").to_pylist()), np.uint8).reshape(-1, bits, groups)
                    held.append((part.column("vec_id").to_numpy(), part.column("label").to_numpy(), planes))
                elif held or cell:
                    if cell is None:
                        cell, held = Cell(*(np.concatenate(x) for x in zip(*held, strict=True))), []
                    yield from asked(cell, part)

    return dealt.mapInArrow(run, "anchor_id long, positive_id long, positive_score long, vec_id long, score long")


def ranked(found: DataFrame, keys: list[str], limit: int) -> DataFrame:
    nth = F.row_number().over(W.partitionBy(*keys).orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", nth).where(F.col("rank") <= limit)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 5, low: int = 80, scale: int = 256, cell_size: int = CELL) -> DataFrame:
    """Hard negatives of the rows (vec_id, embedding, label) that ``anchors``, a condition on vec_id, holds for.

    (anchor_id, positive_id, rank, negative_id, positive_score, negative_score): of each anchor
    its best ``positives`` other rows of the same label, and for each of them the best
    ``negatives`` rows of other labels, whose scores are ``low`` to 100 per cent of the positive's.
    """
    spark = rows.sparkSession
    stage = Stage(spark, "hard_negatives")
    empty = spark.createDataFrame([], RESULT)
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    good = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    good = good.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.transform("embedding", lambda x: F.floor(x.cast("double") * scale)).alias("numbers"))
    common = good.groupBy(F.size("numbers").alias("size")).agg(F.count("*").alias("n")).where("size > 0").orderBy(F.desc("n"), "size").limit(1).collect()
    if not common:
        return empty
    size = common[0]["size"]
    base = good.where(F.size("numbers") == size).groupBy("vec_id").agg(F.min(F.struct("label", "numbers")).alias("row"))
    base = stage.write(base.select("vec_id", "row.label", "row.numbers"), "base")
    facts = base.agg(F.count("*").alias("n"), F.max(F.array_max("numbers")).alias("top"), F.min(F.array_min("numbers")).alias("bottom")).collect()[0]
    largest = max(abs(facts["top"]), abs(facts["bottom"]))
    if size * largest * largest >= 1 << 62:
        raise ValueError(f"components up to {largest} in {size} dimensions: scores could exceed 64 bits")
    bits = max(facts["top"].bit_length(), (-facts["bottom"] - 1).bit_length() if facts["bottom"] < 0 else 0) + 1
    kind = np.int32 if size * largest * largest < 1 << 30 else np.int64  # in between, sums of planes stay under twice the largest
    cores = spark.sparkContext.defaultParallelism
    per_cell = min(cell_size, max(SMALL_CELL, -(-facts["n"] // (4 * cores))))
    cells = -(-facts["n"] // per_cell)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("numbers").flatten().to_numpy(zero_copy_only=False).reshape(-1, size)
            rows_of = [x.tobytes() for x in bit_planes(numbers, bits)]
            yield pa.record_batch([batch.column("vec_id"), batch.column("label"), pa.array(rows_of, pa.binary())], names=["vec_id", "label", "planes"])

    candidates = stage.write(base.mapInArrow(packed, "vec_id long, label long, planes binary"), "candidates")
    asking = base.where(anchors)
    nothing = {"planes": F.lit(None).cast("binary"), "numbers": F.lit(None).cast("array<long>"), "positives": F.lit(None).cast("array<long>"), "scores": F.lit(None).cast("array<long>")}

    def dealt(held: DataFrame, asked: DataFrame) -> DataFrame:
        both = held.withColumn("kind", F.lit(0)).unionByName(asked.withColumn("kind", F.lit(1)), allowMissingColumns=True)
        both = both.select("home", "cell", "kind", "vec_id", "label", *(F.col(c) if c in both.columns else nothing[c].alias(c) for c in nothing))
        return both.repartition(max(cells, 2 * cores), "home", "cell").sortWithinPartitions("home", "cell", "kind", "vec_id")

    # Positives: a label's rows lie in as many cells as they need; its anchors go to each.
    of_label = stage.write(candidates.groupBy("label").agg(F.ceil(F.count("*") / per_cell).cast("int").alias("cells")), "labels")
    held = candidates.join(of_label, "label").select(F.col("label").alias("home"), F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int").alias("cell"), "vec_id", "label", "planes")
    asked = asking.join(of_label, "label").select(F.col("label").alias("home"), F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), "vec_id", "label", "numbers")
    near = ranked(met(dealt(held, asked), size, bits, kind, positives, True, low), ["anchor_id"], positives)
    chosen = near.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("list"))  # at most `positives` of each
    chosen = stage.write(chosen.select(F.col("anchor_id").alias("vec_id"), F.col("list.vec_id").alias("positives"), F.col("list.score").alias("scores")), "positives")
    # Negatives: cells hold all labels.
    held = candidates.select(F.lit(0).cast("long").alias("home"), F.pmod(F.xxhash64("vec_id"), F.lit(cells)).cast("int").alias("cell"), "vec_id", "label", "planes")
    asked = asking.join(chosen, "vec_id").select(F.lit(0).cast("long").alias("home"), F.explode(F.sequence(F.lit(0), F.lit(cells - 1))).alias("cell"), "vec_id", "label", "numbers", "positives", "scores")
    far = stage.write(met(dealt(held, asked), size, bits, kind, negatives, False, low), "negatives")
    out = ranked(far, ["anchor_id", "positive_id"], negatives)
    return out.select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") % 10 + 1) % 10).otherwise(F.col("label"))
    return mine(rows.withColumn("label", shifted), F.col("vec_id") % 100 == 0)
