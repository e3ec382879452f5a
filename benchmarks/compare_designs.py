"""Compare ways to do the same work on a ratings table of realistic size.

Not part of the registered queries: the table is generated, with about a third of
all rows on one rating. Usage: ``python benchmarks/compare_designs.py [rows]``.
Prints one JSON line per comparison.
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from fragloom.functions.ranges import FRAGMENT_ID, RangeSpec, assign_range  # noqa: E402
from fragloom.operators.numbering import ROW_NUMBER, number_rows, number_stored_rows  # noqa: E402
from fragloom.operators.splits import assign_round_robin  # noqa: E402
from fragloom.plans.layout import stored_bytes, write_split  # noqa: E402
from fragloom.session import local_session, scratch_path  # noqa: E402
from fragloom.sources.delimited import read_delimited, read_lines  # noqa: E402
from fragloom.sources.exports import write_lines  # noqa: E402

# Fixed value: rows of the full ratings file.
FULL_FILE_ROWS = 10_000_054
N = 5


def seconds(action) -> float:
    """The better of two runs; the first compiles."""
    timings = []
    for _ in range(2):
        start = time.perf_counter()
        action()
        timings.append(time.perf_counter() - start)
    return round(min(timings), 2)


def report(name: str, **timings: float) -> None:
    print(json.dumps({"comparison": name, "rows": ROWS, **timings}), flush=True)


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = local_session(8)
    path = scratch_path(spark, "generated")
    hashed = F.pmod(F.xxhash64("id"), F.lit(1000))
    spark.range(ROWS).select(
        (hashed * 71).cast("int").alias("userid"),
        F.col("id").cast("int").alias("movieid"),
        F.when(hashed < 334, 4.0).otherwise((hashed % 11) / 2.0).alias("rating"),
    ).write.parquet(path)
    base = spark.read.parquet(path)
    size = stored_bytes(spark, path)
    spec = RangeSpec(N)
    noop(assign_range(base, spec))

    def scratch():
        return scratch_path(spark, "out")

    def filtered_scans():
        target = scratch()
        for i in range(N):
            low = F.col("rating") >= 0 if i == 0 else F.col("rating") > i
            base.where(low & (F.col("rating") <= i + 1)).write.parquet(f"{target}/{FRAGMENT_ID}={i}")

    report(
        "range split",
        planned_files=seconds(lambda: write_split(assign_range(base, spec), scratch(), N, size)),
        gathered=seconds(
            lambda: assign_range(base, spec)
            .repartition(FRAGMENT_ID)
            .write.partitionBy(FRAGMENT_ID)
            .parquet(scratch())
        ),
        filtered_scans=seconds(filtered_scans),
    )

    def single_task(df):
        return df.withColumn(ROW_NUMBER, F.row_number().over(Window.orderBy("movieid")) - 1)

    report(
        "row numbers",
        storage_order=seconds(lambda: noop(number_stored_rows(base))),
        by_number=seconds(lambda: noop(number_rows(base, "movieid"))),
        by_tuple=seconds(lambda: noop(number_rows(base, ["userid", "movieid"]))),
        single_task=seconds(lambda: noop(single_task(base))),
    )

    def deal(numbered):
        write_split(assign_round_robin(numbered, N), scratch(), N, size)

    report(
        "round-robin split",
        storage_order=seconds(lambda: deal(number_stored_rows(base))),
        by_number=seconds(lambda: deal(number_rows(base, "movieid"))),
        single_task=seconds(lambda: deal(single_task(base))),
    )

    lines = scratch_path(spark, "lines")
    write_lines(base.withColumn("timestamp", F.lit(838985046)), lines, "::")
    report(
        "text load",
        strict=seconds(lambda: read_delimited(spark, lines).write.parquet(scratch())),
        split_lines=seconds(lambda: read_lines(spark, lines).write.parquet(scratch())),
        skip_bad=seconds(lambda: read_lines(spark, lines, bad_records="skip").write.parquet(scratch())),
    )
    spark.stop()


if __name__ == "__main__":
    ROWS = int(sys.argv[1]) if len(sys.argv) > 1 else FULL_FILE_ROWS
    main()
