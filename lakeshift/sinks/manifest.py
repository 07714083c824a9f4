"""Batch manifests, content digests and manifest verification (K2-K4).

A *batch* is a key range of ``batch_size`` consecutive surrogate keys
(``key div batch_size``) — computed per row, so batches need no global sort
or ``row_number`` over an unpartitioned window. String keys fall back to a
stable hash bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift.functions.columns import padded_id


def batch_number(df: DataFrame, key: str, batch_size: int, buckets: int | None = None) -> Column:
    """1-based batch number of each row."""
    if isinstance(df.schema[key].dataType, (T.LongType, T.IntegerType, T.ShortType)):
        return (F.expr(f"`{key}` div {int(batch_size)}") + 1).cast("long")
    if not buckets:
        raise ValueError("string keys need an explicit bucket count")
    return (F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)) + 1).cast("long")


def batch_id(table: str, number: Column) -> Column:
    return padded_id(f"{table}-", number, 5)


def assign_batches(df: DataFrame, table: str, key: str, batch_size: int, buckets: int | None = None) -> DataFrame:
    return df.withColumn("batch_id", batch_id(table, batch_number(df, key, batch_size, buckets)))


def batch_manifest(df: DataFrame, table: str, key: str, batch_size: int, buckets: int | None = None) -> DataFrame:
    """Per batch: record count and last key (K2); one partial/final aggregate."""
    batched = assign_batches(df, table, key, batch_size, buckets)
    return batched.groupBy("batch_id").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.max(F.col(key)).cast("string").alias("last_source_key"),
    ).select(F.lit(table).alias("source_table"), "batch_id", "record_count", "last_source_key", F.lit("COMPLETED").alias("status"))


def canonical_row(df: DataFrame, columns: list[str] | None = None) -> Column:
    """Text form of a row that no other row shares: each value as its length,
    a colon and its text, and a NULL as ``-``."""

    def marked(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    return F.concat(*[marked(c) for c in columns or df.columns])


def row_digest(df: DataFrame, columns: list[str] | None = None) -> Column:
    """SHA-256 of the canonical row (K3b) — layout independent, unlike file hashes."""
    return F.sha2(canonical_row(df, columns), 256)


def digest_folds(df: DataFrame, columns: list[str] | None = None) -> list[Column]:
    """Row count, XOR and sum of 60-bit digest prefixes: folds in any order, which also combine."""
    h = F.conv(F.substring(row_digest(df, columns), 1, 15), 16, 10).cast("long")
    return [F.count(F.lit(1)).alias("record_count"), F.bit_xor(h).alias("digest_xor"), F.sum(h.cast("decimal(38,0)")).alias("digest_sum")]


def content_checksum(df: DataFrame, group: list[str] | None = None, columns: list[str] | None = None) -> DataFrame:
    """Order-free content fingerprint (``digest_folds``) of a table or of each group.

    It is independent of partitioning and file layout, and computed with a partial aggregate.
    """
    return df.groupBy(*(group or [])).agg(*digest_folds(df, columns))


def file_checksums(spark, path: str, glob: str | None = None) -> DataFrame:
    """SHA-256 of every file under ``path`` (K3), computed on the executors."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(path).select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))


def verify_manifest(recorded: DataFrame, landed: DataFrame) -> DataFrame:
    """Compare recorded per-batch counts with recomputed ones (K4).

    ``recorded``/``landed``: ``(source_table, batch_id, record_count)``. Full
    outer join on the batch; status MATCHED / COUNT_MISMATCH / MISSING_BATCH /
    UNEXPECTED_BATCH.
    """
    r = recorded.select("source_table", "batch_id", F.col("record_count").alias("recorded_count"))
    lnd = landed.select("source_table", "batch_id", F.col("record_count").alias("landed_count"))
    j = r.join(lnd, ["source_table", "batch_id"], "full_outer")
    status = (
        F.when(F.col("landed_count").isNull(), "MISSING_BATCH")
        .when(F.col("recorded_count").isNull(), "UNEXPECTED_BATCH")
        .when(F.col("recorded_count") == F.col("landed_count"), "MATCHED")
        .otherwise("COUNT_MISMATCH")
    )
    return j.withColumn("status", status)


def verify_files(recorded: DataFrame, landed: DataFrame) -> DataFrame:
    """Compare recorded batches ``(source_table, batch_id, record_count, sha256)``
    with the same, recomputed from the files that are there now (K4): garbage,
    missing and added files each show."""
    keys = ["source_table", "batch_id"]
    r = recorded.select(*keys, F.col("record_count").alias("recorded_count"), F.col("sha256").alias("recorded_sha256"))
    lnd = landed.select(*keys, F.col("record_count").alias("landed_count"), F.col("sha256").alias("landed_sha256"))
    status = (
        F.when(F.col("landed_sha256").isNull(), "MISSING_BATCH")
        .when(F.col("recorded_sha256").isNull(), "UNEXPECTED_BATCH")
        .when(F.col("recorded_sha256") != F.col("landed_sha256"), "DIGEST_MISMATCH")
        .when(F.col("recorded_count") != F.col("landed_count"), "COUNT_MISMATCH")
        .otherwise("MATCHED")
    )
    return r.join(lnd, keys, "full_outer").withColumn("status", status)


def batch_of(path: Column, table: str) -> Column:
    """The batch that a landed file belongs to: its folder ``batch=<number>``, else the file itself."""
    folder = F.regexp_extract(path, "/batch=([^/]+)/[^/]+$", 1)
    return F.when(folder != "", F.concat(F.lit(f"{table}-"), folder)).otherwise(F.element_at(F.split(path, "/"), -1))


def batch_digests(spark, path: str, table: str) -> DataFrame:
    """(batch_id, sha256) of landed batches (K3): a file's own digest, or one of its files' digests in order."""
    files = file_checksums(spark, path, "*.csv").select(batch_of(F.col("path"), table).alias("batch_id"), "sha256")
    each = files.groupBy("batch_id").agg(F.sort_array(F.collect_list("sha256")).alias("each"))  # one or a few files
    return each.select("batch_id", F.when(F.size("each") == 1, F.col("each")[0]).otherwise(F.sha2(F.array_join("each", ","), 256)).alias("sha256"))


def bronze_manifest(spark, path: str, table: str, key: str, schema=None) -> DataFrame:
    """Manifest of a landed Bronze table as its files are now: one row per batch
    with its record count, last key and SHA-256 (K2 + K3), all computed by executors."""
    from lakeshift.sources.files import CSV_OPTIONS
    from lakeshift import schema as S

    schema = schema or S.ENTITIES[table]["schema"]
    # Counting must not fail on a file that verification is to find damaged.
    options = CSV_OPTIONS | {"mode": "PERMISSIVE", "enforceSchema": "true"}
    rows = (
        spark.read.options(**options).schema(schema).csv(path)
        .select(batch_of(F.col("_metadata.file_path"), table).alias("batch_id"), F.col(key))
        .groupBy("batch_id")
        .agg(F.count(F.lit(1)).alias("record_count"), F.max(key).cast("string").alias("last_source_key"))
    )
    # A file without rows, as an empty task leaves, is no batch.
    return rows.join(batch_digests(spark, path, table), "batch_id", "left").select(
        F.lit(table).alias("source_table"), "batch_id", "record_count", "last_source_key", "sha256", F.lit("COMPLETED").alias("status")
    )
