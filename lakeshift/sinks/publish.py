"""Compaction, publication and catalog registration.

Compaction uses the ``REBALANCE`` hint instead of ``repartition(year, month)``
or ``coalesce(1)``: adaptive execution then splits a large month (or category)
into several advisory-size files and merges small ones, so one hot partition
never lands in a single task and small tables still become one file.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakeshift.operators.reconcile import month_partitions
from lakeshift.sources.files import PARTS, part_folders, path_exists, read_dataset, unescaped


@dataclass(frozen=True)
class Layout:
    """Where a published dataset lies and how it is cut: by the month of a date, by a column's values, or not."""

    below: str  # the publication's root
    month_of: str | None = None
    values_of: str | None = None


#: A publication: the layout of each source path.
Bundle = dict[str, Layout]


def compaction_plan(df: DataFrame, date_column: str | None = None, category_column: str | None = None) -> tuple[DataFrame, list[str]]:
    """The rebalanced frame and its publication partition columns."""
    if date_column:
        df = month_partitions(df, date_column)
        parts = ["partition_year", "partition_month"]
    elif category_column:
        parts = [category_column]
    else:
        parts = []
    return df.hint("rebalance", *parts), parts


def compact(
    df: DataFrame,
    path: str,
    date_column: str | None = None,
    category_column: str | None = None,
    max_records_per_file: int | None = None,
    compression: str = "snappy",
) -> int:
    """Write a compacted, partitioned copy; returns the row count (observed
    during the write, no extra pass)."""
    out, parts = compaction_plan(df, date_column, category_column)
    obs = Observation("compaction")
    out = out.observe(obs, F.count(F.lit(1)).alias("rows"))
    writer = out.write.mode("errorifexists").option("compression", compression)
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if parts:
        writer = writer.partitionBy(*parts)
    writer.parquet(path)
    return int(obs.get["rows"])


def parquet_files(spark: SparkSession, path: str) -> int:
    """How many Parquet files a dataset holds; the listing stays on the executors."""
    folders = sorted(part_folders(spark, path).values()) if path_exists(spark, f"{path}/{PARTS}") else [path]
    if not folders:
        return 0
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(folders)
    return files.select("path").count()


def publish(spark: SparkSession, bundle: Bundle, root: str, max_records_per_file: int | None = None) -> DataFrame:
    """Publish a bundle of datasets (K11, K12). Refuses when any source is
    missing or the publication exists; returns the per-dataset report."""
    missing = [source for source in bundle if not path_exists(spark, source)]
    if missing:
        raise FileNotFoundError("missing source outputs: " + ", ".join(missing))
    if path_exists(spark, root):
        raise FileExistsError(f"publication already exists: {root}")
    rows = []
    for source, layout in bundle.items():
        target = f"{root.rstrip('/')}/{layout.below}"
        n = compact(read_dataset(spark, *source.rstrip("/").rsplit("/", 1)), target, layout.month_of, layout.values_of, max_records_per_file)
        rows.append((layout.below, n, parquet_files(spark, source), parquet_files(spark, target)))
    report = spark.createDataFrame(rows, "dataset string, records long, input_parquet_files long, output_parquet_files long")
    report.coalesce(1).write.mode("errorifexists").json(f"{root.rstrip('/')}/_publication_report")
    return report


def _literal(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_sql(spec: dict[str, str | None]) -> str:
    return "PARTITION (" + ", ".join(f"`{c}` = {'null' if v is None else _literal(v)}" for c, v in spec.items()) + ")"


def catalog_partitions(spark: SparkSession, name: str) -> set[tuple]:
    rows = spark.sql(f"SHOW PARTITIONS {name}").collect()
    return {tuple(unescaped(x.partition("=")[2]) for x in r[0].split("/")) for r in rows}


def register_table(spark: SparkSession, name: str, path: str, df_schema, partition_columns: list[str] | None = None) -> dict[str, int]:
    """External Parquet table over a publication (K13), by the difference to what the catalog has.

    ``path`` may be a merged run's dataset, whose days lie in several runs' folders.
    A table of that name is moved to ``path`` and keeps its name and schema (another
    schema is an error). Its catalog partitions are compared with the folders below
    ``path``: new ones are added, vanished ones dropped, and where the table moves
    all change their place; files are not listed. Returns how many were
    ``added``, ``dropped`` and ``kept``.
    """
    parts = partition_columns or []
    place = _qualified(spark, path)
    known = spark.catalog.tableExists(name)
    if not known:
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df_schema.fields)
        clause = f" PARTITIONED BY ({', '.join(f'`{p}`' for p in parts)})" if parts else ""
        spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet{clause} LOCATION {_literal(place)}")
    own = [(f.name, f.dataType.simpleString()) for f in spark.table(name).schema.fields]
    moved_last = [(f.name, f.dataType.simpleString()) for f in sorted(df_schema.fields, key=lambda f: f.name in parts)]
    if own != moved_last:
        raise ValueError(f"{name} has the columns {own}, not {moved_last}")
    described = {r[0]: r[1] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
    moved = known and _qualified(spark, described["Location"]) != place
    if moved:
        spark.sql(f"ALTER TABLE {name} SET LOCATION {_literal(place)}")
    changes = {"added": 0, "dropped": 0, "kept": 0}
    if parts:
        there, folders = (catalog_partitions(spark, name) if known else set()), part_folders(spark, place, parts)
        gone = there if moved else there - folders.keys()
        new = folders.keys() if moved else folders.keys() - there
        for k, values in enumerate((sorted(gone, key=str), sorted(new, key=str))):
            for at in range(0, len(values), 100):
                specs = [(_partition_sql(dict(zip(parts, v, strict=True))), v) for v in values[at : at + 100]]
                if k == 0:
                    spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(s for s, _ in specs)}")
                else:
                    spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(f'{s} LOCATION {_literal(folders[v])}' for s, v in specs)}")
        changes = {"added": len(new), "dropped": len(gone), "kept": len(there) - len(gone)}
    spark.catalog.refreshTable(name)
    return changes


def published(spark: SparkSession, table: str, year: int, month: int) -> DataFrame:
    """Partition-pruned read of one published month."""
    return spark.table(table).filter((F.col("partition_year") == year) & (F.col("partition_month") == month))


def plan_publication(spark: SparkSession, source: str, source_root: str, prefix: str) -> DataFrame:
    """Object keys (and sizes) for copying a local run below a remote prefix.

    Keys are relative to ``source_root``; a ``published`` root keeps its name
    in the key. File contents are not read (only path and length).
    """
    root = source_root.rstrip("/")
    base = root.rsplit("/", 1)[-1]
    full = _qualified(spark, root)
    if not f"{_qualified(spark, source)}/".startswith(f"{full}/"):
        raise ValueError(f"{source} is not below {source_root}")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source).select("path", "length")
    bare = lambda c: F.regexp_replace(c, "^([a-zA-Z0-9]+:)/+", "$1/")  # noqa: E731  file:/x and file:///x are one place
    below = F.regexp_replace(F.lit(full), "^([a-zA-Z0-9]+:)/+", "$1/")
    inside = F.startswith(bare(F.col("path")), F.concat(below, F.lit("/")))
    rel = F.when(inside, F.substring(bare(F.col("path")), F.length(below) + 2, F.length("path"))).otherwise(F.raise_error(F.concat(F.col("path"), F.lit(" is outside the root"))))
    if base == "published":
        rel = F.concat(F.lit("published/"), rel)
    return files.select("path", "length", F.concat(F.lit(prefix.strip("/") + "/"), rel).alias("object_key"))


def _qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system's scheme and authority."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")


def publication_bundle(silver_run: str, gold_run: str, scd2_run: str) -> Bundle:
    """The nine datasets of a migration publication (K12): four Silver, four
    Gold and the SCD2 history, with their publication partitioning."""
    # The tables of each layer, by what they are cut.
    months = {"payments": "payment_date", "settlements": "settlement_date", "merchant_daily_metrics": "business_date"}
    values = {"payment_reconciliation": "reconciliation_status"}
    layers = {
        "silver": (silver_run, ["merchants", "customers", "payments", "settlements"]),
        "gold": (gold_run, ["payment_reconciliation", "merchant_daily_metrics", "merchant_scd2", "reconciliation_summary"]),
    }
    bundle = {f"{run.rstrip('/')}/{t}": Layout(f"{layer}/{t}", months.get(t), values.get(t)) for layer, (run, tables) in layers.items() for t in tables}
    return bundle | {f"{scd2_run.rstrip('/')}/merchant_scd2": Layout("gold/merchant_scd2_history")}
