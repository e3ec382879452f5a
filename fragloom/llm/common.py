"""Helpers shared by the text operators."""

from __future__ import annotations

import ctypes
import re
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from fragloom.session import scratch_path

# Rows and payload bytes after which a Python stage hands a batch back.
BATCH_ROWS = 4096
BATCH_BYTES = 8 << 20

# Whether Spark removes a query's shuffle files when it ends, or when the driver happens to collect its garbage.
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, whole."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def tidy(spark: SparkSession) -> Iterator[None]:
    """Let queries that are made and run meanwhile leave no shuffle files behind."""
    before = spark.conf.get(_TIDY, "false")
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(_TIDY, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once to the shared folder and read it back: its lineage ends there.

    The files outlive lost executors. They stay in the folder named by
    `spark.checkpoint.dir`, whose owner clears it after the run.
    """
    path = scratch_path(df.sparkSession, label)
    with tidy(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder with the scheme that Spark takes it to have, so that executors find the same one."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toString()


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system and the path in it of a qualified folder, as executors see them."""
    return fs.FileSystem.from_uri(re.sub("^file:/(?!/)", "file:///", re.sub("^s3[an]:", "s3:", uri)))


def read_parquet(folder: str) -> Iterator[tuple]:
    """The rows of a finished Parquet folder in the shared file system, read by a task."""
    system, path = open_folder(folder)
    for info in system.get_file_info(fs.FileSelector(path, allow_not_found=True)):
        if info.base_name.endswith(".parquet"):
            with system.open_input_file(info.path) as file:
                yield from batch_rows(pq.ParquetFile(file).iter_batches())


def utf8(column: str) -> Column:
    """The text as UTF-8 bytes, null as no bytes."""
    return F.coalesce(F.col(column).cast("binary"), F.lit(b""))


def quoted(name: str) -> str:
    """A column name that may hold dots or backticks, for F.col."""
    return "`" + name.replace("`", "``") + "`"


def tasks(df: DataFrame) -> int:
    """How many partitions a shuffle gets in this session."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def arrow_batches(rows: Iterable[tuple], schema: StructType) -> Iterator[pa.RecordBatch]:
    """Rows as record batches, bounded in rows and in bytes of text."""
    arrow = to_arrow_schema(schema)
    columns: list[list] = [[] for _ in arrow]
    size = 0
    for row in rows:
        for column, value in zip(columns, row, strict=True):
            column.append(value)
            if isinstance(value, (bytes, str)):
                size += len(value)
        if len(columns[0]) >= BATCH_ROWS or size >= BATCH_BYTES:
            yield _batch(columns, arrow)
            columns = [[] for _ in arrow]
            size = 0
    if columns[0]:
        yield _batch(columns, arrow)
    del columns
    give_back()


def give_back() -> None:
    """Return what a task, or the driver, has freed to the system: its Python lives on and serves other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps it
        pass


def _batch(columns: Sequence[list], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, arrow, strict=True)], schema=arrow
    )


def batch_rows(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of record batches, a few at a time."""
    for batch in batches:
        for start in range(0, batch.num_rows, 512):
            part = batch.slice(start, 512)
            yield from zip(*(column.to_pylist() for column in part.columns), strict=True)
