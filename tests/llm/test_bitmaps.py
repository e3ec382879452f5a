import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from fragloom.llm.bitmaps import bitmap_of, held
from fragloom.llm.common import stored
from fragloom.llm.components import connected_components


def jobs_of(spark, name, run):
    spark.sparkContext.setJobGroup(name, name)
    try:
        return run(), len(spark.sparkContext.statusTracker().getJobIdsForGroup(name))
    finally:
        spark.sparkContext.setJobGroup("other", "other")


def test_a_bitmap_takes_as_many_jobs_for_few_tasks_as_for_many(spark):
    hashes = spark.range(5000).select(F.xxhash64("id").alias("h")).cache()
    values = [r.h for r in hashes.collect()]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    jobs = []
    try:
        for n in (2, 40):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            shared, took = jobs_of(spark, f"bitmap-{n}", lambda: bitmap_of(hashes))
            jobs.append(took)
            assert held(shared.value, np.array(values)).all()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        hashes.unpersist()
    assert jobs[0] == jobs[1] <= 3


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = manager.getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {name for name in names if name.startswith("shuffle_")}


def test_a_stored_frame_leaves_no_shuffle_files_and_the_setting_as_it_was(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, setting = shuffle_files(spark), spark.conf.get(name, "false")
    frame = stored(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert frame.count() == 7 and spark.conf.get(name, "false") == setting
    frame = stored(frame.groupBy("count").agg(F.max("k").alias("k")), "again")
    for _ in range(50):
        left = shuffle_files(spark) - before
        # The count above is no stored frame: one shuffle.
        if len({f.split("_")[1] for f in left}) <= 1:
            break
        time.sleep(0.2)
    assert len({f.split("_")[1] for f in left}) <= 1


@pytest.mark.parametrize(
    ("links", "want"),
    [
        ([], {}),
        ([(3, 1), (3, 2)], {1: 1, 2: 1, 3: 1}),
        ([(2, 1), (3, 2)], {1: 1, 2: 1, 3: 1}),
        ([(i + 1, i) for i in range(20)], dict.fromkeys(range(21), 0)),
        ([(9, 4), (8, 4), (7, 5)], {4: 4, 8: 4, 9: 4, 5: 5, 7: 5}),
    ],
)
def test_components_end_in_stars(spark, links, want):
    found = connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()
    assert len(found) == len(want) and dict(map(tuple, found)) == want
