import hashlib

import pytest
from fixtures import documents, prose, texts

from fragloom.llm import fingerprints as f


def expected(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] is not None, (r[1] or "").encode())))
    out = []
    for (i, text), (_, following) in zip(ordered, ordered[1:] + ordered[:1], strict=True):
        text, following = text or "", following or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        mine, other = (f.Fingerprint.of(t.encode()) for t in (text, following))
        changed = f.Fingerprint.of(edited.encode())
        digest = hashlib.sha256(edited.encode()).hexdigest()
        out.append((i, len(text), digest, str(mine), str(changed), mine.contained_in(changed), mine.contained_in(other)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("partitions", ["1", "7"])
def test_every_case_against_plain_order(spark, partitions):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = f.compare_with_next(documents(spark)).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(map(tuple, got), key=repr) == expected(texts())


def test_one_row_is_its_own_next(spark):
    (row,) = f.compare_with_next(documents(spark, [(1, "abcd efgh")])).collect()
    assert (row.near_next, row.n_chars) == (1.0, 9)


def test_no_rows(spark):
    assert f.compare_with_next(documents(spark, [])).collect() == []


def test_chunks_cover_the_text_within_their_limits():
    data = prose(1, 3000).encode()
    cuts = f.cuts_of(data)
    sizes = [b - a for a, b in zip([0, *cuts], cuts, strict=False)]
    assert cuts[-1] == len(data) and max(sizes) <= f.MAX_CHUNK and min(sizes[:-1]) >= f.MIN_CHUNK


def test_gear_hashes_roll():
    data = prose(2, 100).encode()
    h, rolled = 0, []
    for b in data:
        h = ((h << 1) + int(f._GEAR[b])) & 0xFFFFFFFF
        rolled.append(h)
    assert f.gear_hashes(data).tolist() == rolled


def test_an_insertion_moves_few_chunks():
    text = prose(3, 2000)
    shifted = text[:50] + "inserted words " + text[50:]
    a, b = f.Fingerprint.of(text.encode()), f.Fingerprint.of(shifted.encode())
    assert a.contained_in(b) > 0.97
    assert a.contained_in(f.Fingerprint.of(prose(4, 2000).encode())) < 0.05


def test_containment_of_empty_texts():
    empty, other = f.Fingerprint.of(b""), f.Fingerprint.of(b"text")
    assert empty.contained_in(empty) == 1 and empty.contained_in(other) == 0 and other.contained_in(empty) == 0
