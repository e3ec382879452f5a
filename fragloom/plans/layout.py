"""How the files of a split are laid out."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fragloom.functions.ranges import FRAGMENT_ID

# Size that files should have, and the smallest worth writing without a shuffle.
FILE_BYTES = 128 << 20
SMALL_FILE_BYTES = FILE_BYTES // 8

# Files that a task has open at once; only rows of further fragments are sorted.
OPEN_FILES = 64

# How Spark is told not to sort a task's rows by fragment before it writes them.
_UNSORTED = {"spark.sql.maxConcurrentOutputFileWriters": str(OPEN_FILES), "spark.sql.optimizer.plannedWrite.enabled": "false"}


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of the files below a folder."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(target).getLength()


def plan_tasks(sizes: Sequence[float], tasks: int) -> list[tuple[int, int]]:
    """For fragments of these sizes in bytes the first task that writes each, and how many do.

    A large fragment is divided among tasks of its own, a file each; small ones share a task
    up to an even share of the whole for `tasks` of them.
    """
    share = min(FILE_BYTES, sum(sizes) / max(1, tasks))
    plan: list[tuple[int, int]] = []
    following, room = 0, -1.0
    for size in sizes:
        files = max(1, math.ceil(size / FILE_BYTES))
        if files == 1 and size <= room:
            plan.append((following - 1, 1))
            room -= size
        else:
            plan.append((following, files))
            following += files
            room = share - size if files == 1 else -1.0
    return plan


def write_split(
    assigned: DataFrame,
    path: str,
    n: int,
    in_bytes: int,
    rows: Sequence[int] | None = None,
    lookup: Sequence[str] = (),
) -> None:
    """Write rows into one directory per fragment.

    `in_bytes` is the stored size of the rows. If files stay large enough, each task writes its own
    and no row is shuffled. Otherwise tasks get fragments, or parts of them, by their size,
    which `rows`, or one count, tells: adaptive execution is not needed for it. Rows are
    read twice then, so the frame must come from stored files. `lookup` is as in `write_batch`.
    """
    # A scan has a task for each core, more where the splits of its files would be too large.
    read_tasks = max(assigned.sparkSession.sparkContext.defaultParallelism, in_bytes // FILE_BYTES)
    if in_bytes / (read_tasks * n) < SMALL_FILE_BYTES:
        if rows is None:
            counted = dict(assigned.groupBy(FRAGMENT_ID).count().collect())
            rows = [counted.get(i, 0) for i in range(n)]
        row_bytes = in_bytes / max(1, sum(rows))
        plan = plan_tasks([r * row_bytes for r in rows], read_tasks)
        first, files = (F.split(F.lit(",".join(str(p[k]) for p in plan)), ",").cast("array<int>") for k in (0, 1))
        fragment = F.col(FRAGMENT_ID)
        task = F.get(first, fragment) + F.pmod(F.monotonically_increasing_id(), F.get(files, fragment)).cast("int")
        assigned = assigned.repartitionById(max(a + b for a, b in plan), task)
    _write(assigned, path, lookup)


def write_batch(assigned: DataFrame, path: str, n: int, lookup: Sequence[str] = ()) -> None:
    """Write rows of unknown size into one directory per fragment, reading them once.

    Adaptive execution sizes the tasks: small fragments share one, large ones are divided. Where it
    is off, every fragment is dealt out to as many tasks as make the session's shuffle partitions.
    Columns of `lookup` order the rows of a file and get Bloom filters, by which a reader skips
    row groups and pages that cannot hold a value.
    """
    spark = assigned.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled") == "true":
        assigned = assigned.hint("rebalance", F.col(FRAGMENT_ID))
    else:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        salt = F.pmod(F.monotonically_increasing_id(), F.lit(max(1, tasks // n)))
        assigned = assigned.repartition(tasks, FRAGMENT_ID, salt)
    _write(assigned, path, lookup)


def _write(assigned: DataFrame, path: str, lookup: Sequence[str]) -> None:
    if lookup:
        assigned = assigned.sortWithinPartitions(FRAGMENT_ID, *("`" + c.replace("`", "``") + "`" for c in lookup))
    # A session set to overwrite single partitions would keep those of a failed attempt.
    writer = assigned.write.mode("overwrite").option("partitionOverwriteMode", "static")
    for column in lookup:
        # The filter's size follows the values that a row group turns out to have.
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    if lookup:
        writer = writer.option("parquet.bloom.filter.adaptive.enabled", "true")
    # The sort for one open file at a time would hold all rows of a task, many times their stored size.
    with _settings(assigned.sparkSession, {} if lookup else _UNSORTED):
        writer.partitionBy(FRAGMENT_ID).parquet(path)


@contextmanager
def _settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """The session with other settings for a while."""
    before = {name: spark.conf.get(name) for name in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
