"""File sinks: Bronze CSV batches, immutable Parquet datasets, JSON reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, Observation
from pyspark.sql import functions as F

from lakeshift.sources.files import CSV_OPTIONS, EXACT_TIMES, PARTS, part_folders


def bronze_writer(df: DataFrame, mode: str = "errorifexists") -> DataFrameWriter:
    """A writer of header CSV that keeps values as they are."""
    opts = {k: v for k, v in CSV_OPTIONS.items() if k in ("header", "escape")}
    # Keep whitespace-only values verbatim (the writer trims by default).
    opts.update(ignoreLeadingWhiteSpace="false", ignoreTrailingWhiteSpace="false", **EXACT_TIMES)
    return df.write.mode(mode).options(**opts)


def write_bronze(df: DataFrame, path: str, batch_size: int = 50_000, mode: str = "errorifexists") -> int:
    """Land a table as header CSV files of at most ``batch_size`` rows, in no order.

    ``maxRecordsPerFile`` bounds a file while every task writes its own files in
    parallel; ``sinks.batches`` lands ordered, numbered batches.
    Returns the number of rows written, observed during the write itself.
    """
    obs = Observation("bronze_write")
    bronze_writer(df.observe(obs, F.count(F.lit(1)).alias("rows")), mode).option("maxRecordsPerFile", batch_size).csv(path)
    return int(obs.get["rows"])


def write_dataset(
    df: DataFrame,
    path: str,
    partition_by: str | list[str] | None = None,
    mode: str = "errorifexists",
    max_records_per_file: int | None = None,
    rebalance: bool = True,
) -> None:
    """Immutable Parquet write (K5-K7): a rerun into an existing path fails
    instead of duplicating data. NULL partition values land in
    ``__HIVE_DEFAULT_PARTITION__`` and read back as NULL.

    Partitioned writes are rebalanced on the partition columns first: AQE
    splits a hot partition value into advisory-size tasks and merges small
    ones, so each directory gets few, well-sized files instead of one file
    per task and value.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if parts and rebalance:
        df = df.hint("rebalance", *parts)
    writer = df.write.mode(mode)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)


def write_days(df: DataFrame, path: str, column: str, days: set, base: str) -> None:
    """A dataset that holds ``days`` itself and refers to ``base`` for all others.

    ``df`` has those days' rows, laid out as they shall be written; ``base`` is a
    dataset partitioned by ``column``, and stays as it is.
    """
    spark = df.sparkSession
    write_dataset(df, path, column, rebalance=False)
    own = {(None if d is None else str(d),) for d in days}
    folders = {k: v for k, v in part_folders(spark, base, [column]).items() if k not in own} | part_folders(spark, path, [column])
    rows = [(list(k), v) for k, v in sorted(folders.items(), key=str)]
    write_report(spark.createDataFrame(rows, "part array<string>, folder string"), f"{path}/{PARTS}")


def write_report(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON report of an already-aggregated (small) DataFrame, one file."""
    df.coalesce(1).write.mode(mode).options(ignoreNullFields="false", **EXACT_TIMES).json(path)


def write_listing(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """JSON of a DataFrame that grows with the data, such as a manifest: one file per task."""
    df.write.mode(mode).options(ignoreNullFields="false", **EXACT_TIMES).json(path)


def write_quarantine(df: DataFrame, path: str, as_of=None, mode: str = "errorifexists") -> None:
    """Unified quarantine sink partitioned by table and reason."""
    if as_of is not None and "quarantined_at" not in df.columns:
        df = df.withColumn("quarantined_at", F.lit(as_of).cast("timestamp"))
    write_dataset(df, path, ["source_table", "rejection_reason"], mode)
