"""Windows of a corpus that occur more than once, sought among runs with equal anchors.

The texts are scanned several times where they lie; only what may repeat is shuffled. The
first scan counts anchors. The second states the runs whose anchor occurs more than once, and
equal runs are counted: a run that occurs as a whole again is settled, one row for all
its windows. Where one anchor has several different runs, single windows may still be equal;
a third scan opens one of each of these runs, for the operator to compare its windows.

Bitmaps of a fixed size tell a scan which anchors and places are wanted. A document is known by
its id and `key`, a hash of id and text, so repeated rows are one document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from fragloom.llm.anchors import mixed, runs_of
from fragloom.llm.bitmaps import bitmap_of, held, may_hold
from fragloom.llm.common import batch_rows, quoted, stored, utf8

# Rows, and bytes of slices, that a scan gathers before it hands them on.
_GATHER = 1 << 14
_GATHER_BYTES = 4 << 20


@dataclass(frozen=True)
class Runs:
    """Of each run the start, the number of windows, the hash of its anchor and where that is."""

    starts: np.ndarray
    counts: np.ndarray
    anchors: np.ndarray
    places: np.ndarray

    def where(self, keep: np.ndarray) -> Runs:
        return Runs(self.starts[keep], self.counts[keep], self.anchors[keep], self.places[keep])

    def windows(self) -> np.ndarray:
        """Where every window of the runs starts, run by run."""
        before = np.cumsum(self.counts) - self.counts
        return np.repeat(self.starts - before, self.counts) + np.arange(self.counts.sum())


_NONE = np.zeros(0, np.int64)
_NO_RUNS = Runs(_NONE, _NONE, _NONE.view(np.uint64), _NONE)


# Longer words are hashed one by one; words that are hashed together.
_LONG_WORD = 64
_WORDS_AT_ONCE = 1 << 15

_IS_WORD = np.ones(256, bool)
_IS_WORD[[0x20, *range(0x09, 0x0E)]] = False
# Numbers for bytes, none for the spaces behind a word, and for places in a word.
_OF_BYTE = mixed(np.arange(1, 257)) * _IS_WORD
_OF_PLACE = mixed(np.arange(2001, 2001 + _LONG_WORD)) | np.uint64(1)


def word_hashes(text: bytes) -> np.ndarray:
    """A hash of each word of a text, as `bytes.split` finds them, many words at a time."""
    raw = np.frombuffer(text, np.uint8)
    inside = np.zeros(len(raw) + 2, bool)
    inside[1:-1] = _IS_WORD[raw]
    ends = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = ends[::2], ends[1::2]
    hashes = np.empty(len(starts), np.uint64)
    for at in range(0, len(starts), _WORDS_AT_ONCE):
        some = starts[at : at + _WORDS_AT_ONCE]
        first, last = some[0], starts[at + len(some)] if at + len(some) < len(starts) else len(raw)
        lengths = np.diff(some, append=last)
        place = np.minimum(np.arange(first, last) - np.repeat(some, lengths), _LONG_WORD - 1)
        hashes[at : at + len(some)] = mixed(np.add.reduceat(_OF_BYTE[raw[first:last]] * _OF_PLACE[place], some - first))
    for i in np.flatnonzero(ends - starts > _LONG_WORD).tolist():
        hashes[i] = xxhash.xxh64_intdigest(text[starts[i] : ends[i]])
    return hashes


class WordText:
    """A text as words, `size` of which make a window."""

    size, gram = 20, 5

    _BASE = np.uint64(0x9E3779B97F4A7C15)
    _powers = np.ones(1, np.uint64)
    _inverse = np.ones(1, np.uint64)

    def __init__(self, text: bytes):
        hashes = word_hashes(text)
        n = self.n_words = len(hashes)
        if n < self.size:
            return
        self._prepare(n)
        # Sums of hashes times ascending powers give the hash of any stretch at once.
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes * WordText._powers[:n], out=self.sums[1:])

    @classmethod
    def _prepare(cls, n: int) -> None:
        if len(cls._powers) < n:
            m = max(n, 2 * len(cls._powers))
            inverse = np.uint64(pow(int(cls._BASE), -1, 1 << 64))
            WordText._powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, cls._BASE)]), dtype=np.uint64)
            WordText._inverse = np.cumprod(np.concatenate([[np.uint64(1)], np.full(m - 1, inverse)]), dtype=np.uint64)

    def stretch(self, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
        """The hash of the words in each stretch."""
        return mixed((self.sums[starts + lengths] - self.sums[starts]) * WordText._inverse[starts])

    def runs(self) -> Runs:
        n = self.n_words
        if n < self.size:
            return _NO_RUNS
        grams = self.stretch(np.arange(n - self.gram + 1), self.gram)
        starts, counts, anchors = runs_of(grams, self.size, self.gram)
        return Runs(starts, counts, grams[anchors], anchors)

    def contents(self, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A hash of the whole content of runs."""
        return self.stretch(starts, counts + self.size - 1) ^ mixed(counts)


class ByteText:
    """A text as bytes, `size` of which make a window."""

    size, gram = 400, 32

    _FACTORS = tuple(map(np.uint64, (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)))

    def __init__(self, text: bytes):
        self.text = text

    def runs(self) -> Runs:
        n = len(self.text)
        if n < self.size:
            return _NO_RUNS
        eights = np.ndarray((n - 7,), "<u8", self.text, 0, (1,))
        pieces = n - self.gram + 1
        grams = eights[:pieces] * self._FACTORS[0]
        for k in range(1, self.gram // 8):
            grams ^= grams >> np.uint64(29)
            grams += eights[8 * k : 8 * k + pieces] * self._FACTORS[k]
        grams = mixed(grams)
        starts, counts, anchors = runs_of(grams, self.size, self.gram)
        return Runs(starts, counts, grams[anchors], anchors)

    def contents(self, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
        digest, text, more = xxhash.xxh3_64_intdigest, self.text, self.size - 1
        places = zip(starts.tolist(), counts.tolist(), strict=True)
        return np.fromiter((digest(text[s : s + n + more]) for s, n in places), np.uint64, len(starts))


DOC = ("doc", "key")


def as_texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc, key, text) of documents, text in bytes."""
    doc, text = documents[quoted(id_col)], documents[quoted(text_col)]
    return documents.select(doc.alias("doc"), key_of(doc, text).alias("key"), utf8(quoted(text_col)).alias("text"))


def key_of(doc: Column, text: Column) -> Column:
    return F.xxhash64(doc, text)


def scan(texts: DataFrame, columns: Sequence[T.StructField], found_in: Callable[[int, bytes], Sequence], named: bool = True) -> DataFrame:
    """Rows (doc, key, *columns): what `found_in(key, text)` finds in each text, a list or array a column.

    Where rows need not be `named`, they come without doc and key.
    """
    schema = T.StructType([*([texts.schema["doc"], texts.schema["key"]] if named else []), *columns])
    arrow = to_arrow_schema(schema)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, keys, lengths, parts, gathered, size = [], [], [], [[] for _ in columns], 0, 0

        def batch() -> pa.RecordBatch:
            arrays = []
            if named:
                of = pa.array(np.repeat(np.arange(len(docs)), lengths))
                arrays = [pa.array(docs, arrow.field(0).type).take(of), pa.array(keys, pa.int64()).take(of)]
            for part, field in zip(parts, list(arrow)[-len(columns) :], strict=True):
                flat = np.concatenate(part) if isinstance(part[0], np.ndarray) else [x for p in part for x in p]
                arrays.append(pa.array(flat, field.type))
            return pa.RecordBatch.from_arrays(arrays, schema=arrow)

        for doc, key, text in batch_rows(batches):
            found = found_in(key, text)
            n = len(found[0])
            if not n:
                continue
            docs.append(doc)
            keys.append(key)
            lengths.append(n)
            for part, values in zip(parts, found, strict=True):
                if isinstance(values, np.ndarray):
                    part.append(values.view(np.int64))
                else:
                    part.append(values)
                    size += sum(map(len, values))
            gathered += n
            if gathered >= _GATHER or size >= _GATHER_BYTES:
                yield batch()
                docs, keys, lengths, parts, gathered, size = [], [], [], [[] for _ in columns], 0, 0
        if gathered:
            yield batch()

    return texts.mapInArrow(run, schema)


def _long(*names: str) -> list[T.StructField]:
    return [T.StructField(name, T.LongType()) for name in names]


class RepeatedRuns:
    """The runs of a corpus that may hold repeated windows.

    `places` has every run whose anchor repeats: doc, key, anchor, content, start, n.
    `runs` has each different one of these once: anchor, content, times (that it occurs), first
    (doc, start, key: its first place), last and contents (how many different runs its anchor has).
    """

    def __init__(self, texts: DataFrame, kind: type[WordText] | type[ByteText]):
        anchors = scan(texts, _long("anchor"), lambda key, text: [kind(text).runs().anchors], named=False)
        again = anchors.groupBy("anchor").agg(F.count("*").alias("times")).where("times > 1").select("anchor")
        wanted = bitmap_of(again)

        def repeated(key: int, text: bytes) -> Sequence:
            seen = kind(text)
            runs = seen.runs()
            runs = runs.where(held(wanted.value, runs.anchors.view(np.int64)))
            if not len(runs.starts):
                return [_NONE] * 4
            return [runs.anchors, seen.contents(runs.starts, runs.counts), runs.starts, runs.counts]

        self.texts, self.kind = texts, kind
        self.places = stored(scan(texts, _long("anchor", "content", "start", "n"), repeated), "repeated-runs")
        runs = self.places.groupBy("anchor", "content").agg(
            F.count("*").alias("times"),
            F.min(F.struct("doc", "start", "key")).alias("first"),
            F.max(F.struct("doc", "start", "key")).alias("last"),
        )
        runs = stored(runs, "different-runs")
        several = runs.groupBy("anchor").agg(F.count("*").alias("contents"))
        self.runs = stored(runs.join(several, "anchor").where("times > 1 OR contents > 1"), "repeated-contents")

    def settled(self) -> DataFrame:
        """Places of runs that occur as a whole again, with `first`."""
        whole = self.runs.where("times > 1").select("anchor", "content", "first")
        return self.places.join(whole, ["anchor", "content"])

    def open(self, among: Column, columns: Sequence[T.StructField], opened: Callable) -> DataFrame:
        """Rows of `opened(text, runs)` for one place of each run of `among` whose anchor has others.

        A few runs at other places may be opened as well.
        """
        at = F.col("first.key").bitwiseXOR(F.col("first.start"))
        branching = self.runs.where((F.col("contents") > 1) & among)
        return self._scan_at(bitmap_of(branching.select(at.alias("at"))), bitmap_of(branching.select("first.key")), columns, opened)

    def open_two(self, columns: Sequence[T.StructField], opened: Callable) -> DataFrame:
        """Rows (doc, key, anchor, content, *columns) of the first and the last place of every run that may repeat, no others.

        The first of `columns` must be `run`, where the run of a row starts in its text.
        """
        places = F.explode(F.array_distinct(F.array("first", "last"))).alias("at")
        at = self.runs.select("anchor", "content", places)
        at = stored(at.select("anchor", "content", "at.doc", "at.key", F.col("at.start").alias("run")), "places-to-open")
        shared = bitmap_of(at.select(F.col("key").bitwiseXOR(F.col("run")).alias("at")))
        rows = self._scan_at(shared, bitmap_of(at.select("key")), columns, opened)
        # The bitmap lets other places through, more the larger the corpus: they end here.
        exact = at.select("anchor", "content", F.col("doc").alias("d"), F.col("key").alias("k"), F.col("run").alias("r"))
        same = (F.col("key") == F.col("k")) & (F.col("run") == F.col("r")) & F.col("doc").eqNullSafe(F.col("d"))
        return rows.join(exact, same).drop("d", "k", "r")

    def _scan_at(self, wanted, keys, columns: Sequence[T.StructField], opened: Callable) -> DataFrame:
        kind = self.kind

        def find(key: int, text: bytes) -> Sequence:
            # Most copies have no place to open, and need no runs.
            if not held(keys.value, np.array([key]))[0]:
                return [_NONE] * len(columns)
            seen = kind(text)
            runs = seen.runs()
            return opened(seen, runs.where(held(wanted.value, np.int64(key) ^ runs.starts)))

        return scan(self.texts, columns, find)


def with_spans(rows: DataFrame, spans: DataFrame, run: Callable, schema: T.StructType) -> DataFrame:
    """`run` over rows (doc, key, ..) with the spans (doc, key, start, n) of their document.

    The function gets an iterator of tuples: the columns of the rows, then start and n as
    lists, or None. Rows of documents without spans are not shuffled, but for a few.
    """
    spans = stored(spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "n")).alias("spans")), "spans")
    shared = bitmap_of(spans.select("key"))
    other = spans.select(F.col("doc").alias("d"), F.col("key").alias("k"), "spans.start", "spans.n")
    match = (F.col("key") == F.col("k")) & F.col("doc").eqNullSafe(F.col("d"))
    cut = rows.where(may_hold(shared, F.col("key"))).join(other, match, "left").drop("d", "k")

    def run_whole(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The key is the second column; each row is either here or in the join.
        key, bits = 1, shared.value
        yield from run((*row, None, None) for row in batch_rows(batches) if not held(bits, np.array([row[key]]))[0])

    def run_cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batch_rows(batches))

    return rows.mapInArrow(run_whole, schema).union(cut.mapInArrow(run_cut, schema))


def covered(length: int, starts: Sequence[int] | None, counts: Sequence[int] | None, size: int) -> np.ndarray:
    """Which symbols of a text the windows at these starts cover."""
    change = np.zeros(length + 1, np.int64)
    if starts:
        first = np.array(starts)
        np.add.at(change, first, 1)
        np.add.at(change, np.minimum(first + np.array(counts) + size - 1, length), -1)
    return np.cumsum(change[:-1]) > 0
