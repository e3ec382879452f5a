"""Document fingerprints from content-defined chunks.

A rolling gear hash over the bytes of a text proposes cuts where its high bits are
zero. Cuts are normalised: none within `MIN_CHUNK` bytes, a strict mask until
`NORMAL_CHUNK`, a loose one after it, always one at `MAX_CHUNK`. An inserted or removed
passage moves the cuts near it and leaves the others, so the set of chunk digests resists
shifts. A fingerprint is that set with the bytes that each digest stands for; the share
of those bytes that another fingerprint holds as well is how far it contains the text.

Each document is compared with the next by id, and with its own text whose second half is
replaced from the next. Rows are exchanged once, by ranges of the id; the first document
of a range is sent to the range before it too, so that no task looks beyond its own rows.

A null text counts as empty; an empty text has an empty fingerprint, which is like another
empty one (1) and unlike all others (0). Null ids come first; rows of one id follow each
other in the order of their texts, so repeated rows are each other's next. A single row
is its own next. Other columns play no part.
"""

from __future__ import annotations

import base64
import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, quoted, table, tasks

MIN_CHUNK, NORMAL_CHUNK, MAX_CHUNK = 8, 32, 128

# High bits of the gear hash that are zero at a cut: before the normal size and after it.
STRICT_BITS, LOOSE_BITS = 6, 4

# A random number for each byte value, from a fixed seed.
_GEAR = np.random.default_rng(20).integers(0, 1 << 32, 256, np.uint64).astype(np.uint32)


def gear_hashes(data: bytes) -> np.ndarray:
    """The 32-bit gear hash after each byte: hash = (hash << 1) + gear[byte].

    A byte leaves the hash after 32 more, so sums over 1, 2, 4, .. 32 bytes give all at once.
    """
    hashes = _GEAR[np.frombuffer(data, np.uint8)]
    for span in (1, 2, 4, 8, 16):
        longer = hashes.copy()
        longer[span:] += hashes[:-span] << np.uint32(span)
        hashes = longer
    return hashes


def cuts_of(data: bytes) -> list[int]:
    """Where the chunks of a text end."""
    if len(data) <= MIN_CHUNK:
        return [len(data)] if data else []
    hashes = gear_hashes(data)
    loose_at = np.flatnonzero(hashes < np.uint32(1 << (32 - LOOSE_BITS)))
    strict = (loose_at[hashes[loose_at] < np.uint32(1 << (32 - STRICT_BITS))] + 1).tolist()
    loose = (loose_at + 1).tolist()
    cuts, start, size = [], 0, len(data)
    n_strict, n_loose = len(strict), len(loose)
    while size - start > MIN_CHUNK:
        normal = start + NORMAL_CHUNK
        i = bisect_left(strict, start + MIN_CHUNK)
        if i < n_strict and strict[i] < normal:
            start = strict[i]
        else:
            i = bisect_left(loose, normal)
            start = min(loose[i] if i < n_loose else size, start + MAX_CHUNK, size)
        cuts.append(start)
    if start < size:
        cuts.append(size)
    return cuts


@dataclass(frozen=True)
class Fingerprint:
    """Chunk digests with the bytes they stand for."""

    weights: dict[int, int]
    size: int

    @classmethod
    def of(cls, data: bytes) -> Fingerprint:
        weights: dict[int, int] = {}
        digest, start = xxhash.xxh3_64_intdigest, 0
        for end in cuts_of(data):
            key = digest(data[start:end]) & 0xFFFFFFFF
            weights[key] = weights.get(key, 0) + end - start
            start = end
        return cls(weights, len(data))

    def contained_in(self, other: Fingerprint) -> float:
        """The share of this text's bytes whose chunks the other has as well."""
        if not self.size:
            return float(not other.size)
        theirs = other.weights
        shared = self.weights.keys() & theirs.keys()
        return sum(min(self.weights[k], theirs[k]) for k in shared) / self.size

    def __str__(self) -> str:
        """Digests and weights in ascending order, as 32-bit numbers in base64."""
        pairs = np.fromiter(chain.from_iterable(sorted(self.weights.items())), "<u4", 2 * len(self.weights))
        return base64.b64encode(pairs.tobytes()).decode()


def _with_next(rows: Iterable[tuple]) -> Iterator[tuple[object, str, str]]:
    """(id, text, next text) from rows sorted by range, whether sent from the range after, id and text."""
    last = None
    for part, is_next, doc_id, text in rows:
        if last is not None and last[0] == part:
            yield last[1], last[2], text or ""
        last = None if is_next else (part, doc_id, text or "")


def compare_with_next(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited text, both fingerprints, near_edited, near_next."""
    id_type = documents.schema[id_col].dataType
    if not isinstance(id_type, T.IntegralType):
        raise TypeError(f"{id_col} must be an integer, not {id_type.simpleString()}")
    key = F.coalesce(documents[quoted(id_col)].cast("bigint"), F.lit(-(1 << 63)))
    parts = tasks(documents)
    cuts = documents.select(key.alias("key")).agg(
        F.percentile_approx("key", [i / parts for i in range(1, parts)] or [0.5], 20 * parts)
    ).first()[0]
    cuts = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def part_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(), "right").astype(np.int32))

    firsts = documents.select(key.alias("key")).groupBy(part_of("key").alias("part")).agg(F.min("key")).collect()
    firsts = sorted(tuple(row) for row in firsts)
    # The first key of a range, and the range before it that has rows; the last comes before the first.
    before = {first: firsts[i - 1][0] for i, (_, first) in enumerate(firsts)}
    first_keys = np.array([first for _, first in firsts], np.int64)
    parts_before = np.array([before[first] for _, first in firsts], np.int32)

    @F.pandas_udf("int")
    def part_before(keys: pd.Series) -> pd.Series:
        """The range that needs this row as its next one, or -1."""
        place = np.searchsorted(first_keys, keys.to_numpy())
        place[place == len(first_keys)] = 0
        return pd.Series(np.where(first_keys[place] == keys.to_numpy(), parts_before[place], -1).astype(np.int32))

    rows = documents.select(
        key.alias("key"), documents[quoted(id_col)].alias("doc_id"), documents[quoted(text_col)].alias("text")
    ).select("*", part_of("key").alias("own"), part_before("key").alias("ahead"))
    own = F.struct(F.col("own").alias("part"), F.lit(False).alias("is_next"))
    ahead = F.struct(F.col("ahead").alias("part"), F.lit(True).alias("is_next"))
    places = F.explode(F.when(F.col("ahead") >= 0, F.array(own, ahead)).otherwise(F.array(own)))
    dealt = (
        rows.select("key", "doc_id", "text", places.alias("place"))
        .select("place.part", "place.is_next", "key", "doc_id", "text")
        .repartitionById(len(cuts) + 1, F.col("part"))
        .sortWithinPartitions("part", "is_next", "key", "text")
        .select("part", "is_next", "doc_id", "text")
    )
    out = T.StructType(
        [
            T.StructField("doc_id", id_type),
            T.StructField("n_chars", T.LongType()),
            T.StructField("edited_sha256", T.StringType()),
            T.StructField("fingerprint", T.StringType()),
            T.StructField("edited_fingerprint", T.StringType()),
            T.StructField("near_edited", T.DoubleType()),
            T.StructField("near_next", T.DoubleType()),
        ]
    )

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def compared() -> Iterator[tuple]:
            ahead: tuple[str, Fingerprint] | None = None
            for doc_id, text, next_text in _with_next(batch_rows(batches)):
                mine = ahead[1] if ahead is not None and ahead[0] == text else Fingerprint.of(text.encode())
                theirs = Fingerprint.of(next_text.encode())
                ahead = next_text, theirs
                half = len(text) // 2
                edited = (text[: len(text) - half] + next_text[:half]).encode()
                changed = Fingerprint.of(edited)
                digest = hashlib.sha256(edited).hexdigest()
                near = mine.contained_in(changed), mine.contained_in(theirs)
                yield doc_id, len(text), digest, str(mine), str(changed), *near

        yield from arrow_batches(compared(), out)

    return dealt.mapInArrow(compare, out)


def op1_chunk_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document against the next, and against its text with half of the next."""
    return compare_with_next(table(spark, sf_dir, "documents"))
