"""The accounting ledger: how many source rows are not in Silver, and why (R2).

A ledger is a multiset ``(source_record_id, rejection_reason, rows)``. A full
load opens it with its quarantined rows; a merge posts an increment to it.
Only *touched* source ids can change: those of the increment's rows, and those
of base rows that compete with an accepted change for a payment id. Everything
else is carried over as it is, so that a merge never shuffles the ids of the
whole base: the base is read once, beside the increment's keys, which are
broadcast where their size allows it.

For a touched id the source holds as many rows as it was known to hold (in
Silver and in the ledger), or as many as the increment brings, whichever is
more: a row that arrives under a known id is the new state of a known row.
Rows without an id are never the same, so they add up. What the merged Silver
does not hold of them goes to the ledger, under the newest reasons first: those
of the increment's rejected rows, then ``DUPLICATE_PAYMENT_ID`` for rows that
lost against a newer one, then the reasons that the ledger had.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeshift import schema as S
from lakeshift.operators.joins import fits_broadcast

COLUMNS = ["source_record_id", "rejection_reason", "rows"]


def open_ledger(flagged: DataFrame) -> DataFrame:
    """The ledger of a full load: its rejected rows, counted by source id and reason."""
    rejected = flagged.filter(F.col("rejection_reason").isNotNull())
    return rejected.groupBy("source_record_id", "rejection_reason").agg(F.count(F.lit(1)).alias("rows"))


def small(keys: DataFrame) -> DataFrame:
    """Keys to join with, broadcast where their measured size allows it."""
    return F.broadcast(keys) if fits_broadcast(keys) else keys


def touched_rows(base: DataFrame, accepted: DataFrame, increment: DataFrame, key: str = "payment_id") -> DataFrame:
    """``(source_record_id, competes)`` of the base rows that an increment can affect.

    A row competes where an accepted change has its key; others are named by
    the increment's source ids only and stay as they are.
    """
    keys = accepted.select(F.col(key).alias("_key")).distinct().withColumn("_competes", F.lit(True))
    ids = increment.select(F.col("source_record_id").alias("_id")).where("_id is not null").distinct().withColumn("_named", F.lit(True))
    rows = base.select(key, "source_record_id").join(small(keys), F.col(key) == F.col("_key"), "left")
    rows = rows.join(small(ids), F.col("source_record_id") == F.col("_id"), "left")
    competes = F.coalesce("_competes", F.lit(False))
    return rows.where(competes | F.coalesce("_named", F.lit(False))).select("source_record_id", competes.alias("competes"))


def post_increment(
    ledger: DataFrame, base: DataFrame, flagged: DataFrame, winners: DataFrame, key: str = "payment_id", staged: Callable[[DataFrame, str], DataFrame] = lambda df, name: df
) -> DataFrame:
    """The ledger after a merge.

    ``flagged``: the increment's rows with ``rejection_reason`` (null: accepted);
    ``winners``: the merged rows of the accepted keys. ``staged`` writes a table
    that is read more than once.
    """
    accepted = flagged.filter(F.col("rejection_reason").isNull())
    there = staged(touched_rows(base, accepted, flagged, key), "ledger_touched")
    ids = there.select("source_record_id").union(flagged.select("source_record_id")).where("source_record_id is not null").distinct()
    ids = staged(ids, "ledger_ids")
    known = ledger.join(small(ids), "source_record_id", "left_semi").select(*COLUMNS)
    carried = ledger.join(small(ids), "source_record_id", "left_anti").select(*COLUMNS)

    def posted(rows: DataFrame, age: int | None, reason, n=F.lit(1), **counts) -> DataFrame:
        """Rows with what each adds to its id's counts, and to the rows of one age and reason."""
        named = [F.coalesce(counts.get(c, F.lit(0)), F.lit(0)).cast("long").alias(c) for c in ("prior", "after", "arrived")]
        return rows.select("source_record_id", *named, F.lit(age).cast("int").alias("age"), reason.alias("rejection_reason"), n.cast("long").alias("rows"))

    lost, competes, rejected = F.lit(S.DUPLICATE_PAYMENT_ID), F.col("competes"), F.col("rejection_reason").isNotNull()
    one = F.lit(1)
    entries = posted(there, 1, lost, F.when(competes, 1).otherwise(0), prior=one, after=F.when(competes, 0).otherwise(1))
    for more in (
        posted(winners, 1, lost, F.lit(-1), after=one),
        posted(accepted, 1, lost, arrived=one),
        posted(flagged.filter(rejected), 0, F.col("rejection_reason"), arrived=one),
        posted(known, 2, F.col("rejection_reason"), F.col("rows"), prior=F.col("rows")),
    ):
        entries = entries.union(more)
    sums = [F.sum(c).alias(c) for c in ("prior", "after", "arrived", "rows")]
    entries = entries.groupBy("source_record_id", "age", "rejection_reason").agg(*sums)  # a few of each id from here on
    by_id = entries.groupBy("source_record_id").agg(
        *[F.sum(c).alias(c) for c in ("prior", "after", "arrived")],
        F.array_sort(F.collect_list(F.when(F.col("rows") > 0, F.struct("age", "rejection_reason", "rows")))).alias("list"),
    )
    held = F.when(F.col("source_record_id").isNull(), F.col("prior") + F.col("arrived")).otherwise(F.greatest("prior", "arrived"))
    outside = held - F.col("after")

    def share(entry, k):
        before = F.aggregate(F.slice("list", 1, k), F.lit(0).cast("long"), lambda total, e: total + e["rows"])
        return F.struct(entry["rejection_reason"].alias("rejection_reason"), F.greatest(F.lit(0).cast("long"), F.least(entry["rows"], outside - before)).alias("rows"))

    new = by_id.select("source_record_id", F.explode(F.transform("list", share)).alias("e")).select("source_record_id", "e.rejection_reason", "e.rows").where("rows > 0")
    new = new.groupBy("source_record_id", "rejection_reason").agg(F.sum("rows").alias("rows"))
    return carried.union(new.select(*COLUMNS))


def quarantined_counts(ledger: DataFrame) -> DataFrame:
    """``(section, name, value)`` of the payments' quality report: invalid and duplicate rows."""
    duplicate = F.col("rejection_reason") == S.DUPLICATE_PAYMENT_ID
    sums = ledger.agg(
        F.coalesce(F.sum(F.when(~duplicate, F.col("rows"))), F.lit(0)).alias("payments_invalid"), F.coalesce(F.sum(F.when(duplicate, F.col("rows"))), F.lit(0)).alias("payments_duplicates")
    )
    pairs = F.array(*[F.struct(F.lit("quarantined_rows").alias("section"), F.lit(n).alias("name"), F.col(n).cast("long").alias("value")) for n in ("payments_invalid", "payments_duplicates")])
    return sums.select(F.explode(pairs).alias("e")).select("e.*")
