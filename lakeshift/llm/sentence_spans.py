"""Substring dedup by sliding sentence spans (operator 3).

Every text is cut into sentences, and a sentence of as many words as a window or
more (three quarters of ``longest``: 12) at words that its own words choose: in
each window the one of the smallest hash. Every run of ``run`` consecutive pieces
is hashed. Runs are joined globally by their hash with the first place that each
repeated one has, in order of doc_id and position; every other place is a repeat.
The pieces that any repeat covers are removed, if together they make up at least
``min_words`` words in a row, so that a few short sentences met by chance stay.

Wherever a repeated passage starts or ends, its pieces are the same in all its
places from within its first window to within its last one, and none is longer
than a window. So a passage of 4 windows (48 words) or more always holds ``run``
= 3 whole ones, and loses all but at most 12 words at its start and 11 at its end
(a passage is the same words with the same line breaks).

Words are what white space separates, and sentences end at [.!?] before white
space or at a line break. In text without spaces (Chinese, Japanese, Thai) a
line is one word, so there a repeat of fewer than ``min_words`` lines stays.

A passage in thousands of documents is a partial aggregate and then a join of
two written tables, which Spark splits; nothing but a document's own positions
is ever gathered.

Defined results: null and empty texts stay as they are; a null doc_id neither
repeats nor is repeated; rows that repeat a doc_id and text are one document,
and cleaned alike; a document whose every sentence is a repeat keeps its row,
with an empty text; an empty table gives no rows; texts of any length are read
whole; other columns pass through (``n_chars``, if there, is counted anew).
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.llm.common import ASCII_LOWER, SMALL_BYTES, Stage, free_names, slices, table

SPACE = np.array([chr(c).isspace() for c in range(0x3002)])  # there are none above
MARKS = np.array([ord(c) for c in ".!?"], dtype=np.uint32)
RUN, LONGEST, MIN_WORDS = 3, 16, 20


def cuts(weights: np.ndarray, ends: np.ndarray, window: int) -> np.ndarray:
    """Marks of the words that end a piece; ``ends`` marks those that end a sentence.

    In each ``window`` words of one sentence those of the smallest weight end a
    piece. So pieces have ``window`` words at most, and whether a word ends one
    depends on fewer than ``window`` words on either side.
    """
    if len(weights) < window:
        return ends
    of = np.cumsum(ends) - ends
    within = of[: len(of) - window + 1] == of[window - 1 :]
    least = np.where(within, sliding(np.minimum, weights, window), 0)
    around = np.zeros(len(weights) + window - 1, dtype=weights.dtype)
    around[window - 1 : len(weights)] = least
    return ends | (sliding(np.maximum, around, window) == weights)


def sliding(pick: np.ufunc, values: np.ndarray, window: int) -> np.ndarray:
    """``pick`` over each ``window`` values in a row."""
    out, width = values, 1
    while width < window:
        step = min(width, window - width)
        out, width = pick(out[:-step], out[step:]), width + step
    return out


def words(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, weight, whether it ends a sentence) of each word; the case of a word doesn't move its weight."""
    chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    space = SPACE[np.minimum(chars, len(SPACE) - 1)]
    before = np.concatenate([[True], space[:-1]])
    starts = np.flatnonzero(before & ~space)
    if not len(starts):
        return starts, starts, starts
    plain = np.where(space, np.uint32(32), chars | ((chars - np.uint32(65) < 26).astype(np.uint32) << np.uint32(5)))
    mixed = plain * np.uint32(0x9E3779B1)
    mixed[1:] += plain[:-1] * np.uint32(0x85EBCA77)
    mixed[:1] += np.uint32(32 * 0x85EBCA77 % 2**32)
    mixed ^= mixed >> np.uint32(15)
    mixed *= np.uint32(0xC2B2AE3D)
    mixed ^= mixed >> np.uint32(13)
    mixed[space] = 0
    weights = np.maximum(np.add.reduceat(mixed, starts, dtype=np.uint32), 1)
    stops = np.flatnonzero(space & ~before) - 1  # the last character of each word, but for one that ends the text
    ends = np.zeros(len(starts), dtype=bool)
    ends[: len(stops)] = np.isin(chars[stops], MARKS)
    lines = np.searchsorted(starts, np.flatnonzero(chars == 10), "right") - 1
    ends[lines[lines >= 0]] = True
    ends[-1] = True
    return starts, weights, ends


def sentences(text: str, longest: int) -> list[tuple[int, int, str]]:
    """(end, words, content) of the pieces, which cover the text without gaps."""
    starts, weights, marks = words(text)
    if not len(starts):
        return []
    last = np.flatnonzero(cuts(weights, marks, max(1, 3 * longest // 4)))
    ends = [*starts[last[:-1] + 1].tolist(), len(text)]  # white space belongs to the piece before it
    sizes = np.diff(last, prepend=-1).tolist()
    return [(end, n, text[start:end]) for start, end, n in zip([0, *ends[:-1]], ends, sizes, strict=True)]


def run_hashes(text: str | None, run: int, longest: int) -> list[bytes]:
    """A 128-bit hash for each run of sentences; their case and spacing don't count."""
    own = [xxhash.xxh3_128_digest(b" ".join(c.encode("utf-8", "surrogatepass").translate(ASCII_LOWER).split())) for _, _, c in sentences(text or "", longest)]
    return [xxhash.xxh3_128_digest(b"".join(own[k : k + run])) for k in range(len(own) - run + 1)]


def covered(text: str, starts, run: int, longest: int, min_words: int) -> tuple[str, int, int]:
    """(text without repeats, its sentences, sentences removed), given where repeated runs start."""
    pieces = sentences(text, longest)
    out = np.zeros(len(pieces) + 1, dtype=bool)
    for k in starts:
        out[k : k + run] = True
    kept, at, removed, k = [], 0, 0, 0
    while k < len(pieces):
        j = k
        while j < len(pieces) and out[j] == out[k]:
            j += 1
        if out[k] and sum(w for _, w, _ in pieces[k:j]) >= min_words:
            removed += j - k
        else:
            kept.append(text[at : pieces[j - 1][0]])
        at = pieces[j - 1][0]
        k = j
    return ("".join(kept) if removed else text), len(pieces), removed


def remove_repeats(docs: DataFrame, run: int = RUN, longest: int = LONGEST, min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeats removed from ``text``, and two more columns: sentences, and sentences removed."""
    stage = Stage(docs.sparkSession, "spans", batch_bytes=SMALL_BYTES)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_BYTES):
            rows, places, found = array("q"), array("q"), []
            for row, text in enumerate(batch.column("text").to_pylist()):
                own = run_hashes(text, run, longest)
                rows.extend([row] * len(own))
                places.extend(range(len(own)))
                found += own
            take = pa.array(np.frombuffer(rows, dtype=np.int64)) if found else pa.array([], pa.int64())
            place = pa.array(np.frombuffer(places, dtype=np.int64)) if found else pa.array([], pa.int64())
            yield pa.record_batch([batch.column("doc_id").take(take), batch.column("key").take(take), place, pa.array(found, pa.binary())], names=["doc_id", "key", "at", "hash"])

    keyed = docs.where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).select("doc_id", F.xxhash64("text").alias("key"), "text")
    runs = stage.write(keyed.mapInArrow(hashes, f"doc_id {kind}, key long, at long, hash binary"), "runs")
    place = F.struct("doc_id", "key", "at")
    repeats = runs.groupBy("hash").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last").select("hash", "first")
    repeats = stage.write(repeats, "repeats")
    marks = runs.join(repeats, "hash").where(place != F.col("first")).groupBy("doc_id", "key").agg(F.sort_array(F.collect_set("at")).alias("starts"))
    own = docs.columns
    names = free_names(["n_sentences", "n_removed", "starts", "its_id", "its_key"], own)
    marks = stage.write(marks.toDF(*names[3:], names[2]), "marks")
    stage.drop("runs")
    joined = docs.join(marks, (F.col("doc_id") == F.col(names[3])) & (F.xxhash64("text") == F.col(names[4])), "left").select(*own, names[2])
    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], T.LongType()), T.StructField(names[1], T.LongType())])

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", SMALL_BYTES):
            rows = []
            for text, starts in zip(batch.column("text").to_pylist(), batch.column(names[2]).to_pylist(), strict=True):
                rows.append((None, 0, 0) if text is None else covered(text, starts or (), run, longest, min_words))
            texts, n, removed = zip(*rows, strict=True)
            columns = {c: batch.column(c) for c in own} | {"text": pa.array(texts, pa.string()), names[0]: pa.array(n, pa.int64()), names[1]: pa.array(removed, pa.int64())}
            yield pa.record_batch(list(columns.values()), names=list(columns))

    out = joined.mapInArrow(clean, schema)
    if "n_chars" in own:
        out = out.withColumn("n_chars", F.when(F.col(names[1]) > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars")))
    return out


def op3_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "n_sentences", "n_removed", "text")
