"""The pipeline against plain versions of its stages, one after the other."""

import hashlib
from collections import Counter

import corpus_pipeline
import numpy as np
import public_tokenizers
import pytest
import tiktoken
from fixtures import documents, rows_of, texts, write_tables
from test_decontaminate import benchmark, expected as leaks
from test_near_copies import plain_kept

from fragloom.llm import byte_bpe, quality

SF_DIR = "/root/testdata/sf0.001"


def plain_cut(rows, size=400):
    times = Counter()
    raws = [(i, text.encode()) for i, text in rows]
    for _, raw in raws:
        times.update(raw[at : at + size] for at in range(len(raw) - size + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for at in range(len(raw) - size + 1):
            if times[raw[at : at + size]] > 1:
                gone[at : at + size] = b"\1" * size
        out.append((i, bytes(b for b, cut in zip(raw, gone, strict=True) if not cut).decode(errors="ignore")))
    return out


def plain_pipeline(rows, items, good):
    rows = [(i, text or "") for i, text in rows if i in good]
    alone = set(plain_kept(rows))
    rows = [row for row in rows if row[0] in alone]
    rows = plain_cut(rows)
    dirty = {r[0] for r in leaks(rows, items) if r[5]}
    ranks = byte_bpe.parse_ranks(open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb").read())
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = []
    for i, text in rows:
        if i not in dirty:
            ids = np.array(library.encode_ordinary(text), "<u4").tobytes()
            out.append((i, len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=repr)


def test_given_tables_against_plain_stages(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    scores = quality.score_documents(read("documents"), read("labels")).collect()
    good = {r.doc_id for r in scores if r.predicted}
    rows = [tuple(r) for r in read("documents").select("doc_id", "text").collect()]
    items = [tuple(r) for r in read("benchmark").select("item_id", "text").collect()]
    want = plain_pipeline(rows, items, good)
    assert 0 < len(want) < len(rows)
    assert rows_of(corpus_pipeline.run(spark, SF_DIR)) == want


@pytest.fixture(scope="module")
def awkward(spark, tmp_path_factory):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    folder = tmp_path_factory.mktemp("tables")
    return write_tables(spark, str(folder), documents=documents(spark), labels=labels, benchmark=benchmark(spark))


def test_stages_keep_the_columns_of_documents(spark, awkward):
    docs = spark.read.parquet(f"{awkward}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, awkward)
        assert kept.columns == columns, name
        docs = kept
    assert docs.count() < len(texts())


def test_awkward_documents_pass_through(spark, awkward):
    got = {r.doc_id for r in corpus_pipeline.run(spark, awkward).collect()}
    assert {10, 15, 19, 31} & got == {10} | ({31} & got)  # 15 is a test item, 19 copies 17
    assert 17 in got


def test_empty_tables(spark, tmp_path):
    tables = {
        "documents": documents(spark, []),
        "labels": spark.createDataFrame([], "doc_id bigint, quality int, toxic int"),
        "benchmark": benchmark(spark, []),
    }
    assert corpus_pipeline.run(spark, write_tables(spark, str(tmp_path), **tables)).collect() == []
