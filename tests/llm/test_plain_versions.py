"""Chunk fingerprints, the quality scorer and byte shards against versions written out step by step."""

import base64
import struct
import zlib
from collections import Counter

import numpy as np
import xxhash
from fixtures import documents, texts
from pyspark.sql import functions as F

from fragloom.llm import fingerprints, quality, sharding

SF_DIR = "/root/testdata/sf0.001"


# Chunks, a byte at a time


def plain_chunks(data):
    chunks, start, hashed, at = [], 0, 0, 0
    gear = fingerprints._GEAR.tolist()
    while at < len(data):
        hashed = (hashed * 2 + gear[data[at]]) % 2**32
        at += 1
        size = at - start
        zero_bits = 6 if size < 32 else 4
        if at == len(data) or size == 128 or (size >= 8 and hashed < 2 ** (32 - zero_bits) and len(data) - start > 8):
            chunks.append(data[start:at])
            start = at
    return chunks


def plain_print(data):
    weights = Counter()
    for chunk in plain_chunks(data):
        weights[xxhash.xxh3_64_intdigest(chunk) % 2**32] += len(chunk)
    return weights


def plain_likeness(mine, other):
    if not mine:
        return float(not other)
    return sum(min(n, other.get(k, 0)) for k, n in mine.items()) / sum(mine.values())


def plain_text(weights):
    return base64.b64encode(b"".join(struct.pack("<II", k, n) for k, n in sorted(weights.items()))).decode()


def test_fingerprints_and_likeness_byte_by_byte(spark):
    rows = [r for r in texts() if r[0] != 27] + [(27, texts()[17][1][:20_000])]
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] is not None, (r[1] or "").encode())))
    want = []
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        mine, edited, other = (plain_print(t.encode()) for t in (text, text[: len(text) - half] + following[:half], following))
        want.append((i, plain_text(mine), plain_text(edited), plain_likeness(mine, edited), plain_likeness(mine, other)))
    got = fingerprints.compare_with_next(documents(spark, rows)).select(
        "doc_id", "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


# Scores, from statistics in one array


def plain_isotonic(labels, rows):
    """For each cell the greatest least mean: no pools are kept."""
    sums, counts = np.concatenate([[0], np.cumsum(labels)]), np.concatenate([[0], np.cumsum(rows)])
    mean = lambda j, k: (sums[k + 1] - sums[j]) / (counts[k + 1] - counts[j])
    n = len(labels)
    return np.array([max(min(mean(j, k) for k in range(i, n)) for j in range(i + 1)) for i in range(n)])


def test_scores_from_plain_normal_equations(spark):
    read = lambda name: spark.read.parquet(f"{SF_DIR}/{name}.parquet")
    described = {r.doc_id: np.array(r.stats) for r in quality.describe(read("documents")).collect()}
    known = {r.doc_id: r.quality for r in read("labels").collect() if r.quality is not None and r.doc_id in described}
    fold = lambda i: zlib.crc32(str(i).encode()) % 4
    train = [i for i in known if fold(i) in (0, 1)]
    x, y = np.array([described[i] for i in train]), np.array([known[i] for i in train], float)
    mean, spread = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3)
    drawn = quality.FourierMap.draw(list(mean), list(x.std(axis=0)), quality.FOURIER_FEATURES)

    def waves(stats):
        scaled = np.minimum(np.maximum((np.array(stats) - mean) / spread, -4), 4)
        angle = [sum(a * b for a, b in zip(scaled, column, strict=True)) for column in drawn.directions.T]
        return np.array([np.sqrt(2 / 192) * np.cos(a + p) for a, p in zip(angle, drawn.phases, strict=True)] + [1.0])

    z = np.array([waves(row) for row in x])
    penalty = np.diag([1e-3 * len(y) / 192] * 192 + [0.0])
    weights = np.linalg.solve(sum(np.outer(row, row) for row in z) + penalty, sum(row * label for row, label in zip(z, y, strict=True)))
    cells = {}
    for i in known:
        if fold(i) == 3:
            cell = min(max(int(np.floor(waves(described[i]) @ weights * 512)), -512), 1024)
            cells.setdefault(cell, []).append(known[i])
    order = sorted(cells)
    level = plain_isotonic([sum(cells[c]) for c in order], [len(cells[c]) for c in order])
    at = [(c + 0.5) / 512 for c in order]
    for r in quality.score_documents(read("documents"), read("labels")).collect():
        want = np.clip(np.interp(waves(described[r.doc_id]) @ weights, at, level), 0, 1)
        assert abs(r.score - want) < 1e-6, r.doc_id


# Shards, from all rows in order


def test_shards_are_stretches_of_the_sorted_rows(spark):
    rows = [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").collect()]
    hashes = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    hashes = {r.doc_id: r.h for r in hashes.collect()}
    raw = {i: (text or "").encode() for i, text in rows}
    got = {r.doc_id: r for r in sharding.op10_histogram_sort_shards(spark, "/root/testdata/sf0.01").collect()}
    assert {i: (r.size, r.text_crc32) for i, r in got.items()} == {i: (len(b) + 1, zlib.crc32(b)) for i, b in raw.items()}
    ordered = sorted(raw, key=lambda i: (hashes[i], i))
    assert ordered == sorted(raw, key=lambda i: (got[i].shard, got[i].slot))
    total, below = sum(r.size for r in got.values()), 0
    largest = max(r.size for r in got.values())
    for shard in range(8):
        assert abs(below - shard * total / 8) <= sharding.TOLERANCE * total / 8 + largest
        below += sum(r.size for r in got.values() if r.shard == shard)
