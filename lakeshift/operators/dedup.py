"""Latest-record-per-key deduplication.

``latest_by_key`` is a window top-1; Catalyst turns ``row_number() ... = 1``
into a partial ``WindowGroupLimit`` before the shuffle, so a key holding a
third of all rows is reduced to one row per map task before it is exchanged.

``split_duplicates`` needs the losers as well. Ranking every row of a hot key
would sort that whole group in one task, so instead the winners' ids are found
with the top-1 plan and joined back on ``(key, id)``: the join is hashed on
both columns, which spreads a hot key over all partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ORDER = ("updated_at", "source_record_id")


def _ordering(df: DataFrame, order: Sequence[str], tiebreak: bool) -> list[Column]:
    cols = [F.col(c).desc_nulls_last() for c in order]
    if tiebreak:
        # Deterministic survivor when the order columns tie (e.g. merchants
        # carry no surrogate id): fall back to the remaining columns.
        cols += [F.col(f.name).asc_nulls_last() for f in df.schema.fields if f.name not in order and not isinstance(f.dataType, T.MapType)]
    return cols


def latest_by_key(df: DataFrame, key: str | Sequence[str], order: Sequence[str] = DEFAULT_ORDER, tiebreak: bool = True) -> DataFrame:
    """Keep the newest row per key: order columns descending, NULLs last."""
    keys = [key] if isinstance(key, str) else list(key)
    newest_first = Window.partitionBy(*keys).orderBy(*_ordering(df, [c for c in order if c in df.columns], tiebreak))
    return df.select("*", F.row_number().over(newest_first).alias("_place")).where("_place = 1").select(*df.columns)


def flag_latest(
    df: DataFrame,
    key: str,
    order: Sequence[str] = DEFAULT_ORDER,
    id_col: str = "source_record_id",
    flag: str = "is_latest",
    eligible: Column | None = None,
) -> DataFrame:
    """Every row plus a boolean: is it the surviving row of its key?

    Only rows matching ``eligible`` compete (others are flagged False), so a
    classified frame needs a single join instead of a split and a union.
    ``id_col`` spreads a hot key over the partitions of the join back; it need
    not be unique: versions of one id are told apart by a hash of the whole
    row, and of rows alike in every column one wins. A row with a NULL key
    never wins (such rows are rejected before ranking).
    """
    hashed = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)]
    own = df.withColumn("_row", F.xxhash64(*hashed))
    competing = own if eligible is None else own.filter(eligible)
    names = [c for c in dict.fromkeys([*order, id_col, "_row"]) if c != key]
    by = [*[c for c in order if c in df.columns], id_col, "_row"]
    winners = latest_by_key(competing.select(key, *names), key, list(dict.fromkeys(by)), tiebreak=False)
    winners = winners.select(F.col(key).alias("_w_key"), F.col(id_col).alias("_w_id"), F.col("_row").alias("_w_row"), F.lit(True).alias("_w_flag"))
    same = (own[key] == F.col("_w_key")) & own[id_col].eqNullSafe(F.col("_w_id")) & (own["_row"] == F.col("_w_row"))
    joined = own.join(winners, same, "left")
    # Grouped by the join's own keys: rows alike in every column.
    alike = Window.partitionBy(key, id_col, "_row").orderBy(F.lit(1))
    first = F.coalesce(F.col("_w_flag"), F.lit(False)) & (F.row_number().over(alike) == 1)
    return joined.withColumn(flag, first).drop("_w_key", "_w_id", "_w_row", "_w_flag", "_row")


def split_duplicates(df: DataFrame, key: str, order: Sequence[str] = DEFAULT_ORDER, id_col: str = "source_record_id") -> tuple[DataFrame, DataFrame]:
    """(survivors, duplicates): rank 1 per key vs. every other row of that key."""
    flagged = flag_latest(df, key, order, id_col, "_is_latest")
    return flagged.filter("_is_latest").drop("_is_latest"), flagged.filter(~F.col("_is_latest")).drop("_is_latest")


def duplicate_keys(df: DataFrame, key: str, eligible: Column | None = None) -> DataFrame:
    """Keys held by more than one competing row (partial + final aggregate, so
    a hot key collapses map-side). NULL is a key like any other, as in the
    window."""
    competing = df if eligible is None else df.filter(eligible)
    return competing.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select(key)


def flag_latest_sparse(
    df: DataFrame,
    key: str,
    dup_keys: DataFrame,
    order: Sequence[str] = DEFAULT_ORDER,
    id_col: str = "source_record_id",
    flag: str = "is_latest",
    eligible: Column | None = None,
) -> DataFrame:
    """``flag_latest`` for the usual case where few keys repeat.

    ``dup_keys`` (from ``duplicate_keys``) must have a checked size: it is
    broadcast. Rows whose key does not repeat are decided without any
    shuffle: the single competing row wins. Only rows of repeated keys go
    through the ranking and join-back of ``flag_latest``.
    """
    marks = F.broadcast(dup_keys.select(F.col(key).alias("_dk"), F.lit(True).alias("_dup")))
    marked = df.join(marks, df[key].eqNullSafe(F.col("_dk")), "left").drop("_dk")
    repeated = F.coalesce(F.col("_dup"), F.lit(False))
    wins = F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))
    single = marked.filter(~repeated).drop("_dup").withColumn(flag, wins & F.col(key).isNotNull())
    multi = flag_latest(marked.filter(repeated).drop("_dup"), key, order, id_col, flag, eligible)
    return single.unionByName(multi)
