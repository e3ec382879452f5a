"""Suffix-array dedup: bytes covered by 400-byte strings that start anywhere else too.

Only suffixes that may share 400 bytes with another are sorted. Every 400-byte window has
an anchor within it, and equal windows have it at the same place, so a suffix bucket is an
anchor and a distance from it. Of the runs of windows whose anchor repeats, equal ones are
counted once, by hash: the first and the last place of each are cut out of the texts, sent to
the bucket's task and sorted blockwise. What the sort finds repeated in a run holds at all
its places: the order decides every byte that goes. A block is one anchor, or several small
ones, and at most about `BLOCK_BYTES`.

In a block the positions of a difference cover (their distance from the anchor, mod 57, is
in the cover) are ranked first by their first 57, then 114, then 228 bytes. A suffix is
then placed by its first bytes, by the ranks of two cover positions that between them span all
but the ends of its window, and by its last bytes: long ties cost no more than short ones.
Neighbours that agree in all of these are equal strings.

The suffix buckets of an anchor with more than `CROWDED` different runs are not one block: they
are dealt out by groups of `STEP` distances, and by what all windows of a group have in
common, the bytes around the anchor.

A null text is empty; texts under 400 bytes are never cut. Rows of one id and text are
still two places, so repeated rows remove each other's long strings. Repeated rows give as
many rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.bitmaps import bitmap_of, held
from fragloom.llm.common import arrow_batches, batch_rows, quoted, stored, table, tasks
from fragloom.llm.repeats import ByteText, RepeatedRuns, Runs, _long, as_texts, covered, with_spans

BLOCK_BYTES = 1 << 18
SORTED_AT_ONCE = 1 << 17

# Different runs of an anchor above which its distances are dealt to several blocks.
CROWDED = 1 << 12
# Distances from such an anchor that stay together.
STEP = 46

WINDOW = ByteText.size

#: A difference cover: every distance mod PERIOD is that of two of these residues.
PERIOD = 57
COVER = (0, 1, 3, 13, 32, 36, 43, 52)
_IN_COVER = np.isin(np.arange(PERIOD), COVER)
# From each residue to the next one in the cover, and back to the last.
_AHEAD = np.array([next(d for d in range(PERIOD) if (r + d) % PERIOD in COVER) for r in range(PERIOD)])
_BACK = np.array([next(d for d in range(PERIOD) if (r - d) % PERIOD in COVER) for r in range(PERIOD)])

# Bytes that a rank compares, and bytes compared directly at either end of a window.
_RANKED = 4 * PERIOD
_ENDS = 24


def _dense(keys: Sequence[np.ndarray]) -> np.ndarray:
    """Ranks of rows by several keys, the first one first; equal rows share a rank."""
    order = np.lexsort(tuple(reversed(keys)))
    differ = np.zeros(len(order), bool)
    for key in keys:
        ordered = key[order]
        differ[1:] |= ordered[1:] != ordered[:-1]
    ranks = np.empty(len(order), np.int32)
    ranks[order] = np.cumsum(differ)
    return ranks


class Block:
    """Some slices of text side by side, each with the place of its anchor."""

    def __init__(self, slices: list[bytes], anchor_at: list[int]):
        lengths = np.array([len(s) for s in slices])
        # Room behind a slice for ranks that look past its end.
        rooms = lengths + _RANKED
        self.offsets = np.cumsum(rooms) - rooms
        self.size = int(rooms.sum())
        text = b"".join(s + b"\0" * _RANKED for s in slices) + b"\0" * 8
        # The eight bytes from each position on as a number that sorts as they do.
        self.view = np.ndarray((self.size,), ">u8", text, 0, (1,))
        self.counts = lengths - WINDOW + 1
        self.anchors = self.offsets + np.array(anchor_at)
        self._rank_cover(rooms)

    def _eight(self, at: np.ndarray) -> np.ndarray:
        return self.view[at].astype(np.uint64)

    def _rank_cover(self, rooms: np.ndarray) -> None:
        """Ranks by 228 bytes at the positions of the cover; elsewhere -1."""
        residue = (np.arange(self.size) - np.repeat(self.anchors, rooms)) % PERIOD
        cover = np.flatnonzero(_IN_COVER[residue])
        cover = cover[cover < self.size - 2 * PERIOD]
        starts = [*range(0, PERIOD - 8, 8), PERIOD - 8]
        half = len(starts) // 2
        first = _dense([self._eight(cover + s) for s in starts[:half]])
        first = _dense([first, *(self._eight(cover + s) for s in starts[half:])])
        self.rank = np.full(self.size + _RANKED, -1, np.int32)
        self.rank[cover] = first
        for step in (PERIOD, 2 * PERIOD):
            self.rank[cover] = _dense([self.rank[cover], self.rank[cover + step]])

    def repeated(self, bucket: np.ndarray) -> np.ndarray:
        """Which windows, slice by slice, have an equal one elsewhere in the same bucket.

        `bucket` numbers the anchor of each slice. Buckets, an anchor and a distance from it, are
        sorted some distances at a time, about `SORTED_AT_ONCE` windows.
        """
        before = np.cumsum(self.counts) - self.counts
        at = np.repeat(self.offsets - before, self.counts) + np.arange(self.counts.sum())
        distance = np.repeat(self.anchors, self.counts) - at
        anchor = np.repeat(bucket, self.counts)
        found = np.zeros(len(at), bool)
        by_distance = np.argsort(distance, kind="stable")
        ends = np.cumsum(np.bincount(distance))
        start = 0
        while start < len(at):
            end = ends[min(np.searchsorted(ends, start + SORTED_AT_ONCE), len(ends) - 1)]
            some = by_distance[start:end]
            found[some] = self._equal(anchor[some], at[some], distance[some])
            start = end
        return found

    def _equal(self, anchor: np.ndarray, at: np.ndarray, distance: np.ndarray) -> np.ndarray:
        """Which of these windows agree with a neighbour in the order of their suffixes."""
        ahead = _AHEAD[(-distance) % PERIOD]
        second = at + WINDOW - _RANKED
        second -= _BACK[(second - at - distance) % PERIOD]
        keys = [
            anchor * WINDOW + distance,
            *(self._eight(at + s) for s in range(0, _ENDS, 8)),
            self.rank[at + ahead],
            self.rank[second],
            *(self._eight(at + s) for s in range(WINDOW - _ENDS, WINDOW, 8)),
        ]
        order = np.lexsort(tuple(reversed(keys)))
        same = np.ones(max(0, len(order) - 1), bool)
        for key in keys:
            ordered = key[order]
            same &= ordered[1:] == ordered[:-1]
        found = np.zeros(len(order), bool)
        found[order[1:][same]] = True
        found[order[:-1][same]] = True
        return found


def _slices(text: ByteText, runs: Runs, crowded: np.ndarray) -> Sequence:
    """The bytes that the windows of runs cover: run, bucket, offset in the run, place of the anchor, slice.

    Runs of crowded anchors are cut into the windows of each group of distances.
    """
    rows: tuple[list, ...] = ([], [], [], [], [])
    places = zip(runs.starts.tolist(), runs.counts.tolist(), runs.places.tolist(), runs.anchors.view(np.int64).tolist(), crowded.tolist(), strict=True)
    for start, n, anchor_at, anchor, is_crowded in places:
        for first, end, bucket in _groups(text, start, n, anchor_at, anchor) if is_crowded else [(start, start + n, anchor)]:
            cut = text.text[first : end + WINDOW - 1]
            for column, value in zip(rows, (start, bucket, first - start, anchor_at - first, cut), strict=True):
                column.append(value)
    return [*(np.array(column, np.int64) for column in rows[:4]), rows[4]]


def _groups(text: ByteText, start: int, n: int, anchor_at: int, anchor: int) -> Iterator[tuple[int, int, int]]:
    """(first window, end, bucket) of the windows of a run, by the group of their distance from the anchor."""
    at = start
    while at < start + n:
        group = (anchor_at - at) // STEP
        end = min(start + n, anchor_at - group * STEP + 1)
        # All windows of the group hold these bytes, whatever their distance.
        core = text.text[anchor_at - group * STEP : anchor_at - (group + 1) * STEP + WINDOW + 1]
        seed = (anchor ^ group) & 0xFFFFFFFFFFFFFFFF
        yield at, end, int(np.uint64(xxhash.xxh3_64_intdigest(core, seed)).view(np.int64))
        at = end


def _blocks(rows: Iterable[tuple]) -> Iterator[list[tuple]]:
    """Rows (anchor, content, bucket, offset, place, slice), sorted by bucket, content and offset, in blocks of whole buckets.

    Of the same part of equal runs two rows are enough, and no more are held.
    """
    block, size, same = [], 0, 0
    for row in rows:
        if block and row[2] == block[-1][2]:
            same = same + 1 if row[:4] == block[-1][:4] else 0
            if same > 1:
                continue
        else:
            same = 0
            if size >= BLOCK_BYTES:
                yield block
                block, size = [], 0
        block.append(row)
        size += len(row[5])
    if block:
        yield block


def _spans_of(block: list[tuple]) -> Iterator[tuple]:
    """(anchor, content, offset, n) of the repeated windows of a block's runs."""
    _, bucket = np.unique(np.array([row[2] for row in block]), return_inverse=True)
    sorted_ = Block([row[5] for row in block], [row[4] for row in block])
    found = sorted_.repeated(bucket)
    start, last = 0, None
    for row, n in zip(block, sorted_.counts.tolist(), strict=True):
        if row[:4] != last:
            marks = np.flatnonzero(np.diff(found[start : start + n], prepend=False, append=False))
            for first, end in marks.reshape(-1, 2).tolist():
                yield row[0], row[1], row[3] + first, end - first
        start, last = start + n, row[:4]


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, key, start, n): n windows from start on that start elsewhere too."""
    runs = RepeatedRuns(texts, ByteText)
    crowded = bitmap_of(runs.runs.where(F.col("contents") > CROWDED).select("anchor").distinct())

    def slices(text: ByteText, some: Runs) -> Sequence:
        return _slices(text, some, held(crowded.value, some.anchors.view(np.int64)))

    columns = [*_long("run", "bucket", "offset", "place"), T.StructField("slice", T.BinaryType())]
    opened = runs.open_two(columns, slices).select("anchor", "content", "bucket", "offset", "place", "slice")
    schema = T.StructType(_long("anchor", "content", "offset", "n"))

    def sort_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (span for block in _blocks(batch_rows(batches)) for span in _spans_of(block))
        yield from arrow_batches(rows, schema)

    dealt = opened.repartition(tasks(opened), "bucket").sortWithinPartitions("bucket", "anchor", "content", "offset")
    found = stored(dealt.mapInArrow(sort_blocks, schema), "repeated-windows")
    places = runs.places.select("doc", "key", "anchor", "content", "start")
    return places.join(found, ["anchor", "content"]).select("doc", "key", (F.col("start") + F.col("offset")).alias("start"), "n")


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_bytes, n_removed, n_spans, kept (the bytes that stay)."""
    texts = as_texts(documents, id_col, text_col)
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[id_col].dataType),
            *_long("n_bytes", "n_removed", "n_spans"),
            T.StructField("kept", T.BinaryType()),
        ]
    )

    def run(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        def kept() -> Iterator[tuple]:
            for doc, _, text, starts, counts in rows:
                if starts:
                    gone = covered(len(text), starts, counts, WINDOW)
                    n_spans = int(np.count_nonzero(np.diff(gone, prepend=False)) + gone[-1]) // 2
                    left = np.frombuffer(text, np.uint8)[~gone].tobytes()
                    yield doc, len(text), len(text) - len(left), n_spans, left
                else:
                    yield doc, len(text), 0, 0, text

        yield from arrow_batches(kept(), schema)

    return with_spans(texts, repeated_spans(texts), run, schema)


def cut_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars") -> DataFrame:
    """The documents with all their columns, their texts without repeated bytes.

    Pieces of a character that a cut went through go too. A count of characters in
    `chars_col`, if there is one, is brought up to date.
    """
    whole = F.struct(*(documents[quoted(c)] for c in documents.columns)).alias("row")
    texts = as_texts(documents, id_col, text_col)
    doc, text = documents[quoted(id_col)], documents[quoted(text_col)]
    rows = documents.select(doc.alias("doc"), F.xxhash64(doc, text).alias("key"), whole)
    schema = T.StructType([T.StructField("row", documents.schema)])

    def run(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        def kept() -> Iterator[tuple]:
            for _, _, row, starts, counts in rows:
                if starts:
                    raw = row[text_col].encode()
                    gone = covered(len(raw), starts, counts, WINDOW)
                    left = np.frombuffer(raw, np.uint8)[~gone].tobytes().decode(errors="ignore")
                    row = {**row, text_col: left, **({chars_col: len(left)} if chars_col in row else {})}
                yield (row,)

        yield from arrow_batches(kept(), schema)

    return with_spans(rows, repeated_spans(texts), run, schema).select("row.*")


def op8_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 400-byte strings that start elsewhere too."""
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
