"""Packing of token streams into fixed windows (operator 10).

1. One pass over the texts cuts each document into full windows and one
   remainder, and writes a row per piece (never the ids themselves) with its
   ordinal among the pieces of that length in its task.
2. Counts of pieces by length - ``window`` numbers, whatever the input's size -
   go to the driver. There, shallow combinations of lengths that fill a window
   exactly are enumerated, non-negative least squares solves how often to use
   each against the histogram, the solution is rounded without overdrawing any
   length, and what is left is packed greedily, the longest first.
3. The plan is a short table: for each length, which ordinals go to which
   sequences and offsets. Every piece finds its place by its global ordinal.

Nothing is grouped by length or sequence, so a length that a third of all
documents share moves no more rows into one task than any other.

Defined results: a null or empty text is the single closing id; repeated rows
are packed each; no documents give no rows; a text of any length is cut into
windows as it is encoded; other columns are ignored.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from lakeshift.llm import bpe
from lakeshift.llm.common import Stage, slices, table


class LibraryIds(bpe.TextEncoder):
    """Ids from a tokenizer library's merging of each unit.

    It merges whatever pair has the lowest id, which is the order of the merges
    exactly when their results' ids ascend; other vocabularies use our encoder.
    """

    def __init__(self, path: str):
        own = bpe.codec(path)
        super().__init__(own.special)
        made = [own.made[k][1] for k in sorted(own.made, key=lambda k: own.made[k][0])]
        self.own = own if made != sorted(made) or len(own.entry) != len(own.parts) + 256 else None
        self.library = tiktoken.Encoding("packing", pat_str=bpe.PRETOKEN.pattern, mergeable_ranks=own.entry, special_tokens={})

    def unit_ids(self, unit: str) -> bytes:
        if self.own is not None:
            return self.own.unit_ids(unit)
        ids = array("I", self.library.encode_ordinary(unit))
        return ids.tobytes()


_ENCODERS: dict[str, LibraryIds] = {}


def encoder(path: str) -> LibraryIds:
    if path not in _ENCODERS:
        _ENCODERS[path] = LibraryIds(path)
    return _ENCODERS[path]


def cut(docs: DataFrame, vocabulary: str, window: int, end_id: int) -> DataFrame:
    """A row per piece: (doc_id, start, length, ids_crc32, doc_tokens, task, nth of its length in the task)."""
    end = int(end_id).to_bytes(4, "little")
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(vocabulary).encode, TaskContext.get().partitionId()
        seen = [0] * (window + 1)
        for batch in slices(batches, "text"):
            row_of, columns = [], [array("q") for _ in range(5)]
            for row, text in enumerate(batch.column("text").to_pylist()):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    length = len(piece) // 4
                    row_of.append(row)
                    for column, value in zip(columns, (start, length, zlib.crc32(piece), total, seen[length]), strict=True):
                        column.append(value)
                    seen[length] += 1
            start, length, crc, total, nth = (pa.array(np.frombuffer(c, dtype=np.int64)) if len(c) else pa.array([], pa.int64()) for c in columns)
            tasks = pa.array(np.full(len(row_of), task, dtype=np.int64))
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row_of, pa.int64())), start, length, crc, total, tasks, nth], names=names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, task long, nth long"
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def combinations(counts: np.ndarray, window: int, per_length: int = 8) -> list[dict[int, int]]:
    """Shallow fills of the window by present lengths: pairs, repeats with one filler, and some triples of each length."""
    present = np.flatnonzero(counts[:window])
    here = set(present.tolist())
    found: dict[tuple, dict[int, int]] = {}

    def add(*lengths: int) -> None:
        parts: dict[int, int] = {}
        for length in lengths:
            parts[length] = parts.get(length, 0) + 1
        found.setdefault(tuple(sorted(lengths)), parts)

    for a in present.tolist():
        if window - a in here:
            add(a, window - a)
        for times in (2, 3):
            rest = window - times * a
            if rest == 0:
                add(*[a] * times)
            elif rest in here:
                add(*[a] * times, rest)
        partners = present[present < window - a]
        got = 0
        for b in partners[np.argsort(-counts[partners], kind="stable")].tolist():
            if window - a - b in here:
                add(a, b, window - a - b)
                got += 1
                if got == per_length:
                    break
    return list(found.values())


def non_negative_least_squares(columns: list[dict[int, int]], target: np.ndarray, sweeps: int = 40) -> np.ndarray:
    """min |Ax - target| over x >= 0 by cyclic coordinate descent; A's columns hold few entries each."""
    x = np.zeros(len(columns))
    left = target.astype(np.float64).copy()
    entries = [(list(c.keys()), list(c.values()), float(sum(v * v for v in c.values()))) for c in columns]
    for _ in range(sweeps):
        moved = 0.0
        for k, (rows, times, norm) in enumerate(entries):
            step = max(sum(left[r] * t for r, t in zip(rows, times, strict=True)) / norm, -x[k])
            if step:
                x[k] += step
                for r, t in zip(rows, times, strict=True):
                    left[r] -= step * t
                moved = max(moved, abs(step))
        if moved < 0.05:
            break
    return x


def plan(counts: np.ndarray, window: int) -> list[tuple[dict[int, int], int]]:
    """(lengths with multiplicity, repeats) that use up every count exactly."""
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []

    def use(parts: dict[int, int], times: int) -> None:
        times = min(times, *(int(left[a]) // n for a, n in parts.items()))
        if times > 0:
            out.append((parts, times))
            for a, n in parts.items():
                left[a] -= n * times

    if left[window]:
        use({window: 1}, int(left[window]))
    columns = combinations(left, window)
    solved = non_negative_least_squares(columns, np.where(np.arange(window + 1) < window, left, 0))
    for k in np.argsort(-solved, kind="stable").tolist():
        if (times := int(round(solved[k]))) < 1:
            break
        use(columns[k], times)
    while left.any():  # greedily: the longest first, each gap to the longest that fits
        parts: dict[int, int] = {}
        space = window
        for a in np.flatnonzero(left)[::-1].tolist():
            n = min(int(left[a]), space // a)
            if n:
                parts[a] = n
                space -= n * a
        use(parts, int(left.max()))
    return out


def places(sequences: list[tuple[dict[int, int], int]]) -> np.ndarray:
    """Rows (length, first ordinal, in each sequence, first sequence, offset), sorted: where ordinals of a length go."""
    taken: dict[int, int] = {}
    first, rows = 0, []
    for parts, times in sequences:
        offset = 0
        for length, n in parts.items():
            rows.append((length, taken.get(length, 0), n, first, offset))
            taken[length] = taken.get(length, 0) + n * times
            offset += n * length
        first += times
    return np.array(sorted(rows), dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, vocabulary: str, window: int = 1024, end_id: int = 0) -> DataFrame:
    """A row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    stage = Stage(docs.sparkSession, "packing")
    pieces = stage.write(cut(docs, vocabulary, window, end_id), "pieces")
    by_task = stage.write(pieces.groupBy("length", "task").agg(F.count("*").alias("n")), "by_task")
    counts = np.zeros(window + 1, dtype=np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row for each of `window` lengths
        counts[row["length"]] = row["n"]
    where = places(plan(counts, window))
    before = F.coalesce(F.sum("n").over(W.partitionBy("length").orderBy("task").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    starts = stage.write(by_task.select("length", "task", before.alias("before")), "starts")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        span = int(counts.max()) + 1
        keys = where[:, 0] * span + where[:, 1]
        for batch in batches:
            length, ordinal = (batch.column(c).to_numpy() for c in ("length", "ordinal"))
            at = where[np.searchsorted(keys, length * span + ordinal, side="right") - 1]
            nth = ordinal - at[:, 1]
            sequence, offset = at[:, 3] + nth // at[:, 2], at[:, 4] + nth % at[:, 2] * length
            yield pa.record_batch([*(batch.column(c) for c in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"])

    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    placed = pieces.join(starts, ["length", "task"]).select(*names, (F.col("before") + F.col("nth")).alias("ordinal"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return placed.mapInArrow(run, f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op10_nnls_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), bpe.default_vocabulary())
