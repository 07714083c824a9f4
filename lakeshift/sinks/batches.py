"""Ordered, numbered batches of an extract.

Rows are range-partitioned by the extract's order and written once, sorted, to
the shared folder. From then on a row's place in its partition is a stored value,
so that prefix sums over the partitions' counts, a number for each, give every
row its place in the whole without a sort in one task. A batch is a run of
``batch_size`` places: batches ascend by key, and a task that is lost and run
again gives the same numbers. Equal keys can be in different partitions and
batches, so that a key that holds most rows is no task of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import accumulate

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from lakeshift.functions.columns import padded
from lakeshift.sinks.files import bronze_writer
from lakeshift.sinks.manifest import batch_id, batch_digests

#: Low bits of ``monotonically_increasing_id`` that count a partition's rows.
_INDEX_BITS = 33

MANIFEST = ["source_table", "batch_id", "batch_number", "record_count", "last_source_key", "watermark_after_batch"]


def number_batches(df: DataFrame, order: Sequence[str], batch_size: int, staged: Callable[[DataFrame, str], DataFrame], name: str = "ordered") -> DataFrame:
    """``df`` with ``batch_number`` (from 1): runs of ``batch_size`` rows in ascending ``order``, nulls first.

    ``staged`` writes the sorted rows and reads them back.
    """
    keys = [*order, "_tie"]
    ordered = df.withColumn("_tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ordered = staged(ordered.drop("_tie").withColumn("_at", F.monotonically_increasing_id()), name)
    part, index = F.shiftright("_at", _INDEX_BITS), F.col("_at").bitwiseAND(F.lit((1 << _INDEX_BITS) - 1))
    counts = sorted(tuple(r) for r in ordered.groupBy(part.alias("part")).count().collect())  # one of each partition
    starts = [0, *accumulate(n for _, n in counts)]
    places = df.sparkSession.createDataFrame([(p, start) for (p, _), start in zip(counts, starts, strict=False)], "_part long, _start long")
    numbered = ordered.join(F.broadcast(places), part == F.col("_part")).withColumn("_place", F.col("_start") + index)
    return numbered.withColumn("batch_number", F.expr(f"_place div {int(batch_size)} + 1")).drop("_at", "_part", "_start", "_place")


def ordered_manifest(numbered: DataFrame, table: str, key: str, order: Sequence[str]) -> DataFrame:
    """Per batch its number, record count and last key, and the mark that an extract ending there would have.

    The mark is the last row's first column of the order, for orders that begin with another
    column than the key (such as ``updated_at``); null for an order by key.
    """
    last = F.max(F.struct(*[F.col(c) for c in dict.fromkeys([*order, key])])).alias("_last")
    batches = numbered.groupBy("batch_number").agg(F.count(F.lit(1)).alias("record_count"), last)
    mark = F.col(f"_last.{order[0]}") if order[0] != key else F.lit(None)
    return batches.select(
        F.lit(table).alias("source_table"),
        batch_id(table, F.col("batch_number")).alias("batch_id"),
        "batch_number",
        "record_count",
        F.col(f"_last.{key}").cast("string").alias("last_source_key"),
        mark.cast("timestamp_ntz").alias("watermark_after_batch"),
    )


def write_batches(
    df: DataFrame, path: str, table: str, key: str, order: Sequence[str], batch_size: int, staged: Callable[[DataFrame, str], DataFrame], columns: Sequence[str] | None = None
) -> tuple[DataFrame, DataFrame, int]:
    """Land an extract as CSV, a folder ``batch=<number>`` for each batch.

    Returns its manifest rows with the digests of what was written, the ordered
    rows, and the number of rows observed during the write. A batch that lies in two partitions has two
    files, each sorted.
    """
    numbered = number_batches(df, order, batch_size, staged, f"ordered_{table}")
    rows = numbered.withColumn("batch", padded(F.col("batch_number"), 5))
    seen = Observation(f"batches_{table}")
    out = rows.select("batch", *(columns or df.columns)).sortWithinPartitions("batch", *order).observe(seen, F.count(F.lit(1)).alias("rows"))
    bronze_writer(out).partitionBy("batch").csv(path)
    manifest = ordered_manifest(numbered, table, key, order)
    digests = batch_digests(df.sparkSession, path, table)
    full = manifest.join(digests, "batch_id", "left").select(*MANIFEST, "sha256", F.lit("COMPLETED").alias("status"))
    return full, numbered, int(seen.get["rows"])
