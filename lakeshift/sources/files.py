"""File sources: Bronze CSV batches and partitioned Parquet datasets."""

from __future__ import annotations

import csv
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeshift import schema as S

# Python's csv module dialect: doubled quotes, embedded newlines legal.
# A header that differs from the schema is an error, not a silent swap of columns.
CSV_OPTIONS = {"header": "true", "escape": '"', "multiLine": "true", "mode": "FAILFAST", "enforceSchema": "false"}

#: Writers cut timestamps to milliseconds unless told otherwise; readers take any fraction.
EXACT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def header_signatures(spark: SparkSession, path: str) -> dict[tuple[str, ...], list[str]]:
    """The files below ``path`` by the columns that their headers name.

    Tasks open one file each and stop after its first line, so no file is read
    whole; what comes back is a path and a line per file, as Spark's own listing
    of the folder. Files without a line are left out.
    """
    own = spark.newSession()  # a file to each task
    own.conf.set("spark.sql.files.openCostInBytes", own.conf.get("spark.sql.files.maxPartitionBytes"))
    own.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                if batch.column("start")[0].as_py() == 0:  # not a later part of a large file
                    yield batch.slice(0, 1)
                return

    lines = own.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("start"), "value")
    heads = lines.mapInArrow(first, "path string, start long, value string").select("path", "value").collect()
    found: dict[tuple[str, ...], list[str]] = {}
    for row in sorted(heads):
        found.setdefault(tuple(next(csv.reader([row["value"]]), ())), []).append(row["path"])
    return found


def _by_header(names: tuple[str, ...], schema: T.StructType, file: str) -> T.StructType:
    """The schema of files with this header: the table's columns where the header has them, text for others."""
    missing = [c for c in schema.names if c not in names]
    twice = sorted({c for c in names if names.count(c) > 1})
    if missing or twice:
        raise ValueError(f"{file}: " + "; ".join(f"{what} {', '.join(columns)}" for what, columns in (("header lacks", missing), ("header repeats", twice)) if columns))
    return T.StructType([schema[c] if c in schema.names else T.StructField(c, T.StringType()) for c in names])


def read_bronze(spark: SparkSession, root: str, table: str, schema: T.StructType | None = None, missing_ok: bool = False) -> DataFrame:
    """Read one table of a Bronze run by the names in its files' headers.

    Files whose headers name the columns in another order are read as well, in
    one scan for each order; columns that the schema doesn't have are left out, and
    a header that lacks one of the schema's is an error that names the file. The
    table *directory* is the base, so layout directories such as
    ``extract_date=...`` surface as partition columns (lineage). An absent
    table yields an empty frame with the schema when ``missing_ok`` (Q7).
    """
    schema = schema or S.ENTITIES[table]["schema"]
    path = f"{root.rstrip('/')}/{table}"
    if not _exists(spark, path):
        if missing_ok:
            return spark.createDataFrame([], schema)
        raise FileNotFoundError(path)
    found = header_signatures(spark, path)
    reader = spark.read.options(**CSV_OPTIONS)
    if not found:
        return reader.schema(schema).csv(path)
    out = None
    for names, files in found.items():
        own = _by_header(names, schema, files[0])
        part = reader.schema(own).csv(path) if len(found) == 1 else reader.option("basePath", path).schema(own).csv(files)
        part = part.select(*schema.names, *[c for c in part.columns if c not in own.names])
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    return out


#: Partition column of the tables that are written by day.
DAYS = {"payments": "payment_date", "settlements": "settlement_date"}


#: Below a dataset that refers to other runs' folders: which partition lies where.
PARTS = "_parts"


def unescaped(text: str) -> str | None:
    """A partition value from its folder's or the catalog's name."""
    value = unquote(text)
    return None if value in ("__HIVE_DEFAULT_PARTITION__", "null") else value


def part_folders(spark: SparkSession, path: str, columns: list[str] | None = None) -> dict[tuple, str]:
    """The partitions of a dataset as {values: folder}: what it refers to, else the folders below it.

    One listing of folders, none of their files.
    """
    path = path.rstrip("/")
    if _exists(spark, f"{path}/{PARTS}"):
        return {tuple(r["part"]): r["folder"] for r in spark.read.schema("part array<string>, folder string").json(f"{path}/{PARTS}").collect()}
    p = spark._jvm.org.apache.hadoop.fs.Path(path + "".join(f"/{c}=*" for c in columns))
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p) or []
    out = {}
    for status in found:
        folder = status.getPath().toString()
        out[tuple(unescaped(x.partition("=")[2]) for x in folder.split("/")[-len(columns) :])] = folder
    return out


def read_dataset(spark: SparkSession, root: str, name: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Parquet dataset with Hive-style partition discovery.

    An empty partitioned table has no file to take a schema from, so it needs
    ``schema``; the entities' tables have theirs. A dataset that refers to folders
    of other runs (``PARTS``) is read from there, one scan for each run.
    """
    if schema is None and name in S.ENTITIES:
        schema = S.ENTITIES[name]["schema"]
        if name in DAYS:
            schema = T.StructType([*schema.fields, T.StructField(DAYS[name], T.DateType())])
    reader = spark.read.schema(schema) if schema else spark.read
    path = f"{root.rstrip('/')}/{name}" if name else root.rstrip("/")
    if not _exists(spark, f"{path}/{PARTS}"):
        return reader.parquet(path)
    runs: dict[str, list[str]] = {}
    for values, folder in part_folders(spark, path).items():
        runs.setdefault("/".join(folder.split("/")[: -len(values)]), []).append(folder)
    out = None
    for base, folders in sorted(runs.items()):
        part = reader.option("basePath", base).parquet(*sorted(folders))
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out


def path_exists(spark: SparkSession, path: str) -> bool:
    return _exists(spark, path)
