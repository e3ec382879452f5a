"""Benchmark decontamination by Wu-Manber multi-pattern search.

A test string is a window of consecutive words of a benchmark item. Test strings
and documents are normalised to their words, one space between them and one at
either end, so that a match of bytes is a match of whole words.

A block shift table says how far the search may jump from where a block of bytes
stands; where it says zero, the hash bucket of that block selects test strings
and direct comparison confirms them. Test strings are searched in classes of
similar length, as the shortest of a class bounds its jumps.

Documents are not shuffled. Test strings are made, and equal ones merged, by Spark, and lie in
the shared folder in blocks of about `BLOCK_BYTES`, which tasks read there. Rows pass one
search stage for each block, which adds its hits to a bit mask of the row, so memory is
bounded whatever the size of the benchmark or of one item.

Null and empty texts have no words and are never hit. Rows are judged one by one:
repeated rows and repeated ids give as many rows. A benchmark without words leaves
everything clean. Other columns of the documents play no part.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, qualified, quoted, read_parquet, stored, table, tasks, utf8
from fragloom.session import scratch_path

WINDOW_WORDS = 10

# Test strings in one block, in bytes; a Python worker keeps the tables of one.
BLOCK_BYTES = 32 << 20

# What a byte of prose tells, in symbols: the base of the block length rule.
ALPHABET = 4

#: Words are digits, lower-case letters and everything beyond ASCII.
_TO_WORDS = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """The words of a text: A-Z lower-cased, then runs of digits, letters and non-ASCII characters."""
    return text.translate(_TO_WORDS).split()


def windows_of(words: list[bytes], size: int = WINDOW_WORDS) -> Iterator[bytes]:
    """Every window of an item; one window of all its words if they are fewer."""
    for start in range(max(1, len(words) - size + 1) if words else 0):
        yield b" " + b" ".join(words[start : start + size]) + b" "


class WuManber:
    """Search one class of test strings, all at least as long as the shortest."""

    def __init__(self, patterns: Iterable[bytes]):
        patterns = list(patterns)
        self.reach = min(map(len, patterns))
        ideal = math.ceil(math.log(2 * self.reach * len(patterns) + 1, ALPHABET))
        self.block = max(1, min(ideal, self.reach // 2 + 1))
        self.jump = self.reach - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[bytes]]] = defaultdict(lambda: defaultdict(list))
        for pattern in patterns:
            for end in range(self.block, self.reach + 1):
                block = pattern[end - self.block : end]
                self.shift[block] = min(self.shift.get(block, self.jump), self.reach - end)
            # Bucket by the block that ends the common reach, then by the first bytes.
            tail = pattern[self.reach - self.block : self.reach]
            self.buckets[tail][pattern[: self.reach]].append(pattern)

    def find(self, text: bytes) -> Iterator[tuple[int, bytes]]:
        """Start and test string of every occurrence."""
        size, reach, jump, shift = self.block, self.reach, self.jump, self.shift.get
        end, last = reach, len(text)
        while end <= last:
            step = shift(text[end - size : end], jump)
            if step:
                end += step
                continue
            bucket = self.buckets[text[end - size : end]]
            for pattern in bucket.get(text[end - reach : end], ()):
                if text.startswith(pattern, end - reach):
                    yield end - reach, pattern
            end += 1


class Searcher:
    """All test strings of a block, in classes of doubling length, and the items they come from."""

    def __init__(self, owners: dict[bytes, list[str]]):
        self.owners = owners
        classes = defaultdict(list)
        for pattern in owners:
            classes[len(pattern).bit_length()].append(pattern)
        self.classes = [WuManber(patterns) for _, patterns in sorted(classes.items())]

    def search(self, words: list[bytes], hit: np.ndarray) -> set[str]:
        """Mark the words hit; return the items found."""
        if not words:
            return set()
        text = b" " + b" ".join(words) + b" "
        spaces, found = None, set()
        for matcher in self.classes:
            for start, pattern in matcher.find(text):
                if spaces is None:
                    spaces = np.flatnonzero(np.frombuffer(text, np.uint8) == 32)
                first = int(np.searchsorted(spaces, start))
                hit[first : first + pattern.count(b" ") - 1] = True
                found.update(self.owners[pattern])
        return found


def write_blocks(benchmark: DataFrame, window_words: int = WINDOW_WORDS, block_bytes: int = BLOCK_BYTES) -> list[str]:
    """Write all different (test string, item) in blocks of about `block_bytes`; returns their folders.

    Items are cut into windows by the tasks that read them, and dealt to blocks by hash, so neither a
    long item nor a window of many items fills one: parts of what belongs together may lie in
    several blocks, whose findings are added up. The driver knows their number alone. A null item id
    is written as no characters.
    """
    schema = T.StructType([T.StructField("item", T.StringType()), T.StructField("window", T.BinaryType())])

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = ((item, window) for item, text in batch_rows(batches) for window in windows_of(words_of(text), window_words))
        yield from arrow_batches(found, schema)

    items = benchmark.select(F.coalesce(benchmark["item_id"].cast("string"), F.lit("")), utf8("text"))
    windows = stored(items.mapInArrow(cut, schema).distinct(), "benchmark-windows")
    size = windows.agg(F.sum(F.length("window") + F.length("item"))).first()[0]
    if size is None:
        return []
    count = -(-size // block_bytes)
    path = scratch_path(benchmark.sparkSession, "benchmark-blocks")
    dealt = windows.withColumn("block", F.pmod(F.xxhash64("window", "item"), F.lit(count)))
    dealt.repartition(min(count, 2 * tasks(windows)), "block").write.partitionBy("block").parquet(path)
    return [f"{qualified(benchmark.sparkSession, path)}/block={i}" for i in range(count)]


_KEPT: dict[str, Searcher] = {}


def searcher_of(block: str) -> Searcher:
    """The searcher of a block, which a Python worker builds once and keeps for its next tasks."""
    if block not in _KEPT:
        _KEPT.clear()
        owners: dict[bytes, list[str]] = defaultdict(list)
        for item, window in read_parquet(block):
            owners[window].append(item)
        _KEPT[block] = Searcher(owners)
    return _KEPT[block]


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    window_words: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    id_type = documents.schema[id_col].dataType
    work = T.StructType([T.StructField("doc_id", id_type), *_WORK])
    out = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_hit", T.LongType()),
            T.StructField("n_items", T.LongType()),
            T.StructField("items_sha256", T.StringType()),
            T.StructField("contaminated", T.BooleanType()),
        ]
    )

    def report(row: tuple, hit: np.ndarray, items: set[str]) -> tuple:
        n_hit = int(hit.sum())
        joined = ",".join(sorted(items)).encode()
        return row[0], len(hit), n_hit, len(items), hashlib.sha256(joined).hexdigest(), n_hit > 0

    rows = documents.select(documents[quoted(id_col)].alias("doc_id"), *_work_columns(documents, text_col))
    blocks = write_blocks(benchmark, window_words, block_bytes) or [None]
    for block in blocks[:-1]:
        rows = rows.mapInArrow(_stage(block, work, None), work)
    return rows.mapInArrow(_stage(blocks[-1], out, report), out)


def drop_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    window_words: int = WINDOW_WORDS,
    block_bytes: int = BLOCK_BYTES,
    text_col: str = "text",
) -> DataFrame:
    """The documents without a hit, with all their columns. Only texts reach Python, once a block."""

    def clean(block: str):
        @F.arrow_udf("boolean")
        def without_hit(texts: pa.Array) -> pa.Array:
            searcher = searcher_of(block)
            kept = np.ones(len(texts), bool)
            for i, text in enumerate(texts):
                words = words_of(text.as_py())
                hit = np.zeros(len(words), bool)
                searcher.search(words, hit)
                kept[i] = not hit.any()
            return pa.array(kept)

        return without_hit

    for block in write_blocks(benchmark, window_words, block_bytes):
        documents = documents.where(clean(block)(utf8(quoted(text_col))))
    return documents


#: What a search stage adds to the first column, which it passes on.
_WORK = (
    T.StructField("text", T.BinaryType()),
    T.StructField("hits", T.BinaryType()),
    T.StructField("items", T.ArrayType(T.StringType())),
)


def _work_columns(documents: DataFrame, text_col: str) -> list:
    none = F.array().cast("array<string>").alias("items")
    return [utf8(quoted(text_col)).alias("text"), F.lit(None).cast("binary").alias("hits"), none]


def _stage(block: str | None, schema: T.StructType, report):
    """A search of one block; the last one reports."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def searched() -> Iterator[tuple]:
            for row in batch_rows(batches):
                first, text, hits, items = row
                words = words_of(text)
                hit = np.zeros(len(words), bool)
                if hits:
                    hit |= np.unpackbits(np.frombuffer(hits, np.uint8), count=len(words)).view(bool)
                found = set(items) if block is None else searcher_of(block).search(words, hit) | set(items)
                if report is None:
                    yield first, text, np.packbits(hit).tobytes(), sorted(found)
                else:
                    yield report(row, hit, found)

        yield from arrow_batches(searched(), schema)

    return run


def op2_wu_manber_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against every window of the benchmark."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
