import hashlib
from collections import Counter

import pytest
from fixtures import documents, prose, rows_of, texts

from pyspark.sql import functions as F

from fragloom.llm import bitmaps, repeats, suffix_array

SIZE = 400


def expected(rows):
    times = Counter()
    raws = [(i, (text or "").encode()) for i, text in rows]
    for _, raw in raws:
        times.update(raw[at : at + SIZE] for at in range(len(raw) - SIZE + 1))
    out = []
    for i, raw in raws:
        gone = bytearray(len(raw))
        for at in range(len(raw) - SIZE + 1):
            if times[raw[at : at + SIZE]] > 1:
                gone[at : at + SIZE] = b"\1" * SIZE
        kept = bytes(b for b, cut in zip(raw, gone, strict=True) if not cut)
        spans = sum(1 for a, b in zip(b"\0" + bytes(gone), gone, strict=False) if b and not a)
        out.append((i, len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def removed(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in df.collect()), key=repr)


CASES = {
    "as it is": {},
    "tiny blocks": {"BLOCK_BYTES": 1},
    "one block": {"BLOCK_BYTES": 1 << 30},
    "all anchors crowded": {"CROWDED": 0},
    "some anchors crowded": {"CROWDED": 5},
    "each distance by itself": {"CROWDED": 0, "STEP": 1},
}


@pytest.mark.parametrize("case", CASES)
def test_every_case_against_plain_strings(spark, monkeypatch, case):
    for name, value in CASES[case].items():
        monkeypatch.setattr(suffix_array, name, value)
    assert removed(suffix_array.remove_repeats(documents(spark))) == expected(texts())


def test_full_bitmaps_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(bitmaps, "BITS", 1 << 15)
    assert removed(suffix_array.remove_repeats(documents(spark))) == expected(texts())


def test_the_sort_decides_every_byte(spark, monkeypatch):
    monkeypatch.setattr(suffix_array, "_spans_of", lambda block: iter(()))
    assert all(r.n_removed == 0 for r in suffix_array.remove_repeats(documents(spark)).collect())


def test_only_wanted_places_reach_the_sort(spark, monkeypatch):
    opened = []
    two = repeats.RepeatedRuns.open_two

    def counted(self, columns, found):
        rows = two(self, columns, found)
        opened.append((rows.count(), self.runs.select(F.explode(F.array_distinct(F.array("first", "last")))).count()))
        return rows

    monkeypatch.setattr(bitmaps, "BITS", 1 << 15)
    monkeypatch.setattr(repeats.RepeatedRuns, "open_two", counted)
    rows = [row for row in texts() if row[0] is not None]
    rows = list(dict(rows).items())  # no repeated rows, which are places of their own
    assert removed(suffix_array.remove_repeats(documents(spark, rows))) == expected(rows)
    assert opened[0][0] == opened[0][1] > 0


def test_an_anchor_of_many_different_runs(spark, monkeypatch):
    monkeypatch.setattr(suffix_array, "CROWDED", 100)
    phrase = prose(71, 60)
    rows = [(i, prose(5000 + i % 700, 45) + " " + phrase + " " + prose(9000 + i % 650, 45)) for i in range(800)]
    assert removed(suffix_array.remove_repeats(documents(spark, rows))) == expected(rows)


def test_lengths_around_the_window(spark):
    text = prose(70, 400)
    rows = [(n, prose(200 + n, 8) + text[n : n + n % 7 + 397] + prose(400 + n, 8)) for n in range(0, 60, 3)]
    rows += [(1000, text), (1001, "é" * 300), (1002, "é" * 199 + "x" + "é" * 199)]
    assert removed(suffix_array.remove_repeats(documents(spark, rows))) == expected(rows)


def test_no_rows(spark):
    assert suffix_array.remove_repeats(documents(spark, [])).collect() == []


def test_the_cover_has_every_distance():
    cover, period = suffix_array.COVER, suffix_array.PERIOD
    assert {(a - b) % period for a in cover for b in cover} == set(range(period))


def test_cut_documents_keep_their_columns_and_whole_characters(spark):
    docs = documents(spark)
    cut = suffix_array.cut_repeats(docs)
    assert cut.schema == docs.schema
    got, before = rows_of(cut.drop("text", "n_chars")), rows_of(docs.drop("text", "n_chars"))
    assert got == before
    for r in cut.where("doc_id NOT IN (29, 30, 31)").collect():
        assert (r.text is None) == (r.n_chars is None)
        assert r.text is None or len(r.text) == r.n_chars


def test_cut_text_is_what_is_left(spark):
    want = {r[0]: r for r in expected(texts())}
    for r in suffix_array.cut_repeats(documents(spark)).where("doc_id BETWEEN 11 AND 28").collect():
        n_bytes, n_removed = want[r.doc_id][1:3]
        assert n_bytes - n_removed - 3 * want[r.doc_id][3] * 2 <= len(r.text.encode()) <= n_bytes - n_removed
