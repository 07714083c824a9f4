"""Helpers shared by the operators: staged tables, byte-wise words, Arrow batches.

Intermediate tables are written as Parquet into the folder that the session
names in ``spark.checkpoint.dir``, so that lost executors cost a re-read and not
a recomputation of the whole lineage.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; a local one only where a local session names none (tests)."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="lakeshift-llm-")
        sc.setCheckpointDir(folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


class Stage:
    """Tables of one operator call, each written once and read back with its known schema.

    With ``batch_bytes``, Arrow batches that go to Python tasks of these writes hold
    about as many bytes, for tasks whose texts or arrays are large.
    """

    def __init__(self, spark: SparkSession, name: str, batch_bytes: int | None = None):
        self.spark, self.folder, self.batch_bytes = spark, new_folder(spark, name), batch_bytes

    def write(self, df: DataFrame, name: str) -> DataFrame:
        path, conf, key = f"{self.folder}/{name}", self.spark.conf, BATCH_BYTES_KEY
        before = conf.get(key)
        try:
            if self.batch_bytes:
                conf.set(key, str(self.batch_bytes))
            df.write.option("compression", "zstd").parquet(path)
        finally:
            conf.set(key, before)
        return self.read(path, df.schema)

    def read(self, path: str, schema: T.StructType) -> DataFrame:
        loose = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        return self.spark.read.schema(loose).parquet(path)

    def drop(self, name: str) -> None:
        """Remove a table that only later, already written tables were made from."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_names(names: list[str], taken: list[str]) -> list[str]:
    """The names, each lengthened until no column has it."""
    lower, out = {t.lower() for t in taken}, []
    for name in names:
        while name.lower() in lower:
            name += "_"
        lower.add(name.lower())
        out.append(name)
    return out


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: Bytes of text that one Arrow batch handed on to Python code holds at most, but for a single longer text.
SLICE_BYTES = 8 << 20
#: The same where Python code makes many times its text in rows or where operators follow each other in one
#: executor, whose Python workers keep what their largest batch took.
SMALL_BYTES = 1 << 20

BATCH_BYTES_KEY = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by SMALL_BYTES, also for frames that are run later."""
    spark.conf.set(BATCH_BYTES_KEY, str(SMALL_BYTES))


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that each has at most ``most`` bytes of ``column`` or a single row."""
    for batch in batches:
        sizes = pc.binary_length(batch.column(column)).fill_null(0).to_pylist()
        start = total = 0
        for k, size in enumerate(sizes):
            if k > start and total + size > most:
                yield batch.slice(start, k - start)
                start, total = k, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


#: A-Z to a-z, all other bytes as they are.
ASCII_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; none for a null."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    return (raw.translate(ASCII_LOWER) if lower else raw).split()
