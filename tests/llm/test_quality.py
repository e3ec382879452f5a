import zlib

import numpy as np
import pytest
from fixtures import documents, texts
from pyspark.sql import functions as F

from fragloom.llm import quality as q

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def scored(spark):
    return {r.doc_id: r for r in q.op3_fourier_quality(spark, SF_DIR).collect()}


def test_held_out_rows_are_told_apart(spark, scored):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()
    held = [(scored[r.doc_id], r.quality) for r in labels if scored[r.doc_id].held_out]
    good, bad = ([s.score for s, label in held if label == v] for v in (1, 0))
    above = np.mean([[g > b or 0.5 * (g == b) for b in bad] for g in good])
    assert above > 0.98
    assert np.mean([s.predicted == label for s, label in held]) > 0.95


def test_folds_and_threshold(scored):
    for i, row in scored.items():
        assert row.held_out == (zlib.crc32(str(i).encode()) % 4 == 2)
        assert 0 <= row.score <= 1 and row.predicted == int(row.score >= 0.7)


def test_held_out_labels_and_other_columns_do_not_matter(spark, scored):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = F.when(q.fold_of(F.col("doc_id")) == 2, 1 - F.col("quality")).otherwise(F.col("quality"))
    got = q.score_documents(docs, labels.withColumn("quality", flipped)).collect()
    assert all(abs(r.score - scored[r.doc_id].score) < 1e-6 for r in got)


def test_every_case_gets_a_score(spark):
    rows = texts()
    labels = spark.createDataFrame(
        [(i, k % 2, 0) for k, (i, _) in enumerate(rows)] + [(15, None, 0), (99999, 1, 0)], "doc_id bigint, quality int, toxic int"
    )
    got = q.score_documents(documents(spark), labels).collect()
    assert sorted((r.doc_id for r in got), key=repr) == sorted((i for i, _ in rows), key=repr)
    assert all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (10, 11)}) == 1  # null and empty


def test_without_labels_nothing_is_rejected(spark):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = documents(spark)
    assert {r.score for r in q.score_documents(docs, none).collect()} == {1.0}
    assert q.keep_good(docs, none).count() == docs.count()


def test_no_documents(spark):
    labels = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert q.score_documents(documents(spark, []), labels).collect() == []


def test_rejected_documents_go(spark, scored):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    kept = q.keep_good(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    assert kept.schema == docs.schema
    assert {r.doc_id for r in kept.select("doc_id").collect()} == {i for i, r in scored.items() if r.predicted}


def test_partition_sums_are_the_whole_sums(spark):
    rng = np.random.default_rng(0)
    stats, label = rng.normal(size=(60, len(q.STATISTICS))), rng.integers(0, 2, 60)
    df = spark.createDataFrame([(s.tolist(), int(y)) for s, y in zip(stats, label, strict=True)], "stats array<double>, label bigint")
    fourier = q.FourierMap.draw(stats.mean(axis=0).tolist(), stats.std(axis=0).tolist(), 16)
    gram, target, n = q.normal_equations(df.repartition(7), fourier)
    z = fourier(stats)
    assert n == 60 and np.allclose(gram, z.T @ z) and np.allclose(target, z.T @ label)


def test_fourier_features_approach_the_kernel():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(40, 8))
    fourier = q.FourierMap.draw([0.0] * 8, [1.0] * 8, 20_000)
    z = fourier(x)[:, :-1]
    squares = ((x[:, None] - x[None]) ** 2).sum(axis=2)
    assert np.abs(z @ z.T - np.exp(-squares / (2 * (8 / 2)))).max() < 0.05


def test_isotonic_steps():
    at, level = q.isotonic([(0.0, 1, 2), (0.1, 0, 2), (0.2, 3, 4), (0.3, 1, 2), (0.4, 5, 5)])
    assert np.all(np.diff(level) >= 0) and np.interp([0.05, 0.25, 0.4], at, level).tolist() == [0.25, 4 / 6, 1.0]
