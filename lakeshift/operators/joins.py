"""Existence, anti and orphan joins.

Broadcast is explicit only behind a size check (``fits_broadcast``: the
optimizer's size estimate, an upper bound for scans, filters, projections and
aggregates, against ``spark.sql.autoBroadcastJoinThreshold``). Beyond it the
join shuffles and is made skew-proof: the existence flag against a
possibly non-unique dimension joins on ``(key, salt)``, where the streamed
side's salt is a deterministic row hash and the distinct key set is replicated
once per salt bucket. A key holding a third of the rows is spread over
``salt_buckets`` partitions, nothing fans out, and because the replicated key
set is re-shuffled, both join inputs come straight from a shuffle, which is
what AQE's skew-join split needs (a join fed directly by ``distinct()`` is
never split).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def reference_keys(dim: DataFrame, pk: str, unique: bool = False) -> DataFrame:
    """Distinct non-NULL keys of a parent table (distinct avoids fan-out, Q2)."""
    keys = dim.select(F.col(pk).alias("_ref_key")).where(F.col("_ref_key").isNotNull())
    return keys if unique else keys.distinct()


def size_estimate(df: DataFrame) -> int | None:
    """Optimizer size estimate in bytes, without executing anything.

    This is the number Spark's own static broadcast rule uses (file sizes for
    scans, never shrunk by filters or projections, so an upper bound). PySpark
    has no public accessor, so it is read from the JVM plan; if that is not
    available the size is unknown (``None``) and nothing is broadcast.
    """
    try:
        size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
        return int(size) if isinstance(size, int) else int(size.toString())
    except Exception:  # pragma: no cover - depends on the Spark build
        return None


_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def broadcast_limit(df: DataFrame) -> int:
    """``spark.sql.autoBroadcastJoinThreshold`` in bytes (-1 = never broadcast)."""
    text = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760b")).strip().lower()
    digits = text.rstrip("bkmgt")
    unit = text[len(digits):] or "b"
    return int(float(digits) * _UNITS.get(unit, 1)) if digits not in ("", "-") else -1


def fits_broadcast(df: DataFrame) -> bool:
    limit = broadcast_limit(df)
    size = size_estimate(df) if limit > 0 else None
    return size is not None and size <= limit


def flag_exists(
    df: DataFrame, fk: str, dim: DataFrame, pk: str, flag: str = "reference_exists", unique: bool = False, salt_buckets: int = 16
) -> DataFrame:
    """Add a boolean column: does ``df[fk]`` exist in ``dim[pk]``? NULL fk -> False.

    ``unique``: ``dim[pk]`` is known to be unique, so a plain left join cannot
    fan out and (no aggregate under it) stays splittable by AQE.
    """
    keys = reference_keys(dim, pk, unique).withColumn("_ref_hit", F.lit(True))
    if fits_broadcast(keys):
        joined = df.join(F.broadcast(keys), df[fk] == F.col("_ref_key"), "left")
    elif unique or salt_buckets <= 1:
        joined = df.join(keys, df[fk] == F.col("_ref_key"), "left")
    else:
        salted = keys.withColumn("_ref_salt", F.explode(F.sequence(F.lit(0), F.lit(salt_buckets - 1))))
        hashable = [F.col(f.name) for f in df.schema.fields if not isinstance(f.dataType, T.MapType)] or [F.lit(0)]
        streamed = df.withColumn("_salt", F.pmod(F.xxhash64(*hashable), F.lit(salt_buckets)).cast("int"))
        cond = (streamed[fk] == F.col("_ref_key")) & (F.col("_salt") == F.col("_ref_salt"))
        joined = streamed.join(salted, cond, "left").drop("_salt", "_ref_salt")
    return joined.withColumn(flag, F.coalesce(F.col("_ref_hit"), F.lit(False))).drop("_ref_key", "_ref_hit")


def without_keys(base: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """Base rows whose key is absent from the change set."""
    return base.join(changes.select(key), key, "left_anti").select(*base.columns)


def semi(df: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """Rows whose fk exists in the parent (no fan-out, J10)."""
    return df.join(dim.select(F.col(pk).alias("_ref_key")), df[fk] == F.col("_ref_key"), "left_semi")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows with no parent; a NULL fk is an orphan."""
    return child.join(parent.select(F.col(pk).alias("_ref_key")), child[fk] == F.col("_ref_key"), "left_anti")
