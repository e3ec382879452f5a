"""Trees, proofs and tampering against a plain tree of lists."""

import hashlib
import zlib

import pytest
from fixtures import TO_LOWER, documents, rows_of, texts, write_tables
from pyspark.sql import functions as F

from fragloom.llm import manifest
from fragloom.llm.manifest import FIELDS, op12_slot_pivot_manifest


def digest(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def plain_leaf(row):
    values = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row]
    return digest(*values)


def plain_tree(nodes):
    """The top and, for every node, its path of (before, after)."""
    paths, places = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + 16] for i in range(0, len(nodes), 16)]
        for path, at in zip(paths, places, strict=True):
            run, slot = runs[at // 16], at % 16
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
        places = [at // 16 for at in places]
        nodes = [digest(*run) for run in runs]
    return nodes[0], paths


def plain(rows):
    """Rows are (doc_id, source, lang, n_chars, text)."""
    leaves = sorted(
        ((r[1] is not None, (r[1] or "").encode(), r[0] is not None, r[0] or 0, plain_leaf(r), r) for r in rows),
        key=lambda x: x[:5],
    )
    groups = {}
    for leaf in leaves:
        groups.setdefault(leaf[:2], []).append(leaf)
    trees = [(group, *plain_tree([leaf[4] for leaf in group])) for group in groups.values()]
    root, upper = plain_tree([t[1] for t in trees])
    out = []
    for (group, subroot, paths), above in zip(trees, upper, strict=True):
        for leaf, path in zip(group, paths, strict=True):
            r, whole = leaf[5], path + above
            node = leaf[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                node = plain_leaf((*r[:4], None if r[4] is None else r[4].translate(TO_LOWER)))
            for before, after in whole:
                node = digest(before, node, after)
            proof = digest(*(b + a for b, a in whole))
            out.append((r[0], leaf[4], subroot, root, proof, node, node == root))
    return sorted(out, key=repr)


SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def sources(sizes):
    rows, i = [], 0
    for source, size in sizes:
        for _ in range(size):
            rows.append((i * 7919 % 100_003, source, ["en", None, "dé"][i % 3], i % 5 or None, f"Text {i}" if i % 11 else None))
            i += 1
    return rows


@pytest.mark.parametrize(
    "sizes",
    [
        [("a", 1)],
        [("a", 2)],
        [("a", 16)],
        [("a", 17)],
        [(None, 3), ("", 1), ("é", 40), ("z", 300), ("b", 16), ("B", 257)],
        [(f"s{i}", 1 + i % 3) for i in range(300)],
    ],
)
def test_against_a_plain_tree(spark, tmp_path, sizes):
    rows = sources(sizes)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(6)
    folder = write_tables(spark, str(tmp_path), documents=docs)
    assert rows_of(op12_slot_pivot_manifest(spark, folder)) == plain(rows)


def test_awkward_rows(spark, tmp_path):
    docs = documents(spark, texts() + [(None, None), (None, None), (7, "\0"), (-9, "A" * 100_000)])
    docs = docs.withColumn("source", F.when(F.col("doc_id") % 3 != 0, F.col("source")))
    folder = write_tables(spark, str(tmp_path), documents=docs)
    rows = [tuple(r) for r in docs.select(*FIELDS).collect()]
    got = rows_of(op12_slot_pivot_manifest(spark, folder))
    assert got == plain(rows) and {r[-1] for r in got} == {True, False}


def test_no_rows(spark, tmp_path):
    folder = write_tables(spark, str(tmp_path), documents=documents(spark, []))
    assert op12_slot_pivot_manifest(spark, folder).collect() == []


def test_a_hot_group_is_numbered_by_several_tasks_and_without_python(spark):
    rows = spark.range(5000).select("id", F.lit("one").alias("source"), F.lit(None).cast("string").alias("text"))
    made = manifest.manifest(rows, ["id", "source", "text"], "source", "id")
    plan = made._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "NestedLoop" not in plan
    placed = manifest.numbered(
        rows.select(F.lit(False).alias("no_group"), F.col("source").alias("group"), "id", F.col("id").cast("string").alias("hash"))
    )
    assert placed.where("place = id AND n = 5000").count() == 5000
    assert "SinglePartition" not in placed._jdf.queryExecution().toString()
