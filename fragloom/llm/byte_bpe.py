"""Byte-level BPE: encode texts to token ids by a table of ranks, and decode ids to bytes.

A text is split into pieces by a pattern. Within a piece the adjacent pair of tokens
with the lowest rank is merged, leftmost first, until no pair has a rank. A segment
tree over the byte positions of the piece holds the least (rank, position) of the
pairs that start there; its root names the next merge, which changes the leaves of
the merged token, of its live left neighbour and of the token that went, and the
nodes above these three: work in the logarithm of the piece's length. Trees of many
pieces of like length stand side by side in one array and step together.

Rows are worked on where they lie, without a shuffle; the rank file, bounded by
`MAX_RANK_BYTES`, is broadcast. A long text passes in blocks of pieces, so that
memory follows `BLOCK_PIECES` and the longest piece.

Null and empty texts give no ids and decode to no bytes. Rows are encoded one by one:
repeated rows and repeated ids give as many rows. Other columns play no part.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, quoted, table

MAX_RANK_BYTES = 64 << 20

# Pieces encoded at a time, pieces whose ids a task remembers, leaves of trees side by side.
BLOCK_PIECES = 200_000
KNOWN_PIECES = 300_000
FOREST_LEAVES = 1 << 19

# Bytes beyond which a piece gets a tree by itself.
LONG_PIECE = 256

_NONE = np.iinfo(np.int64).max


def parse_ranks(data: bytes) -> dict[bytes, int]:
    """A rank file: on each line a token in base64 and its rank, which is its id."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}


class PairRanks:
    """The rank of two adjacent tokens, for arrays of them: an open-addressing table."""

    def __init__(self, ranks: dict[bytes, int]):
        self.width = max(ranks.values()) + 1
        pairs = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    pairs[left * self.width + right] = rank
        bits = max(4, (2 * len(pairs)).bit_length())
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.values = np.full(1 << bits, _NONE, np.int64)
        keys = np.fromiter(pairs.keys(), np.int64, len(pairs))
        values = np.fromiter(pairs.values(), np.int64, len(pairs))
        slots = self._slots(keys)
        while len(keys):
            # Of the keys that want a free slot one gets it; the others try the next.
            free = self.keys[slots] == -1
            self.keys[slots[free]] = keys[free]
            placed = self.keys[slots] == keys
            self.values[slots[placed]] = values[placed]
            keys, values, slots = keys[~placed], values[~placed], (slots[~placed] + 1) & self.mask

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def __call__(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left * self.width + right
        slots = self._slots(keys)
        seen = self.keys[slots]
        found = np.where(seen == keys, self.values[slots], _NONE)
        open_ = np.flatnonzero((seen != keys) & (seen != -1))
        while len(open_):
            slots[open_] = (slots[open_] + 1) & self.mask
            seen = self.keys[slots[open_]]
            hit = seen == keys[open_]
            found[open_[hit]] = self.values[slots[open_[hit]]]
            open_ = open_[~hit & (seen != -1)]
        return found


class Forest:
    """Segment trees over the byte positions of several pieces."""

    def __init__(self, pieces: list[bytes], leaves: int, byte_ids: np.ndarray, ranks: PairRanks):
        n = len(pieces)
        self.leaves, self.ranks = leaves, ranks
        lengths = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(leaves, b"\0") for p in pieces), np.uint8).reshape(n, leaves)
        place = np.arange(leaves)
        self.token = np.where(place < lengths[:, None], byte_ids[raw], -1)
        self.after = np.where(place + 1 < lengths[:, None], place + 1, -1)
        self.before = np.broadcast_to(place - 1, (n, leaves)).copy()
        self.tree = np.full((n, 2 * leaves), _NONE, np.int64)
        row, at = np.nonzero(self.after >= 0)
        self.tree[row, leaves + at] = self._key(self.token[row, at], self.token[row, at + 1], at)
        width = leaves
        while width > 1:
            level = self.tree[:, width : 2 * width]
            np.minimum(level[:, 0::2], level[:, 1::2], out=self.tree[:, width // 2 : width])
            width //= 2

    def _key(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """(rank, position) in one number: the least is the leftmost of the lowest rank."""
        rank = self.ranks(left, right)
        return np.where(rank == _NONE, _NONE, rank * self.leaves + at)

    def _set(self, row: np.ndarray, changes: list[tuple[np.ndarray, np.ndarray]]) -> None:
        """New keys at some leaves, then the nodes above them, level by level."""
        nodes = [self.leaves + at for at, _ in changes]
        for node, (_, key) in zip(nodes, changes, strict=True):
            self.tree[row, node] = key
        while nodes[0].size and nodes[0][0] > 1:
            nodes = [node >> 1 for node in nodes]
            for node in nodes:
                self.tree[row, node] = np.minimum(self.tree[row, 2 * node], self.tree[row, 2 * node + 1])

    def merge_all(self) -> list[bytes]:
        """The ids left in each piece, as little-endian unsigned 32-bit integers."""
        row = np.flatnonzero(self.tree[:, 1] != _NONE)
        while len(row):
            least = self.tree[row, 1]
            at = least % self.leaves
            gone = self.after[row, at]
            new = self.after[row, gone]
            self.token[row, at] = least // self.leaves
            self.token[row, gone] = -1
            self.after[row, at] = new
            linked = new >= 0
            self.before[row[linked], new[linked]] = at[linked]
            none = np.full(len(row), _NONE)
            right = none.copy()
            r, a, b = row[linked], at[linked], new[linked]
            right[linked] = self._key(self.token[r, a], self.token[r, b], a)
            ahead = self.before[row, at]
            inner = ahead >= 0
            # The first token has no pair ahead of it; its removed neighbour stands in.
            left_at = np.where(inner, ahead, gone)
            left = none.copy()
            r, a, b = row[inner], ahead[inner], at[inner]
            left[inner] = self._key(self.token[r, a], self.token[r, b], a)
            self._set(row, [(gone, none), (at, right), (left_at, left)])
            row = row[self.tree[row, 1] != _NONE]
        left = self.token >= 0
        ids = self.token[left].astype("<u4").tobytes()
        ends = (4 * np.cumsum(left.sum(axis=1))).tolist()
        return [ids[start:end] for start, end in zip([0, *ends], ends, strict=False)]


def merge_long(piece: bytes, ranks: dict[bytes, int]) -> bytes:
    """The ids of one piece: the same tree in plain numbers, which suits a single long piece better."""
    n = len(piece)
    leaves = 1 << (n - 1).bit_length()
    token = [piece[i : i + 1] for i in range(n)]
    after, before = [*range(1, n), -1], list(range(-1, n - 1))
    tree = [_NONE] * (2 * leaves)

    def key(at: int) -> int:
        rank = ranks.get(token[at] + token[after[at]]) if after[at] >= 0 else None
        return _NONE if rank is None else rank * leaves + at

    def put(at: int, value: int) -> None:
        node = leaves + at
        tree[node] = value
        while node > 1:
            least = min(tree[node], tree[node ^ 1])
            node >>= 1
            if tree[node] == least:
                return
            tree[node] = least

    tree[leaves : leaves + n] = map(key, range(n))
    for node in range(leaves - 1, 0, -1):
        tree[node] = min(tree[2 * node], tree[2 * node + 1])
    while tree[1] != _NONE:
        at = tree[1] % leaves
        gone = after[at]
        token[at] += token[gone]
        token[gone] = b""
        after[at] = after[gone]
        if after[at] >= 0:
            before[after[at]] = at
        put(gone, _NONE)
        put(at, key(at))
        if before[at] >= 0:
            put(before[at], key(before[at]))
    return np.array([ranks[t] for t in token if t], "<u4").tobytes()


class Encoder:
    """Encode pieces and texts by one table of ranks."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.pattern = regex.compile(pattern)
        self.pairs = PairRanks(ranks)
        self.byte_ids = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that are not known yet."""
        new = set(pieces).difference(self.known)
        if len(self.known) + len(new) > KNOWN_PIECES:
            self.known.clear()
            new = set(pieces)
        by_leaves: dict[int, list[tuple[str, bytes]]] = {}
        for piece in new:
            raw = piece.encode()
            whole = self.ranks.get(raw)
            if whole is not None:
                self.known[piece] = whole.to_bytes(4, "little")
            elif len(raw) > LONG_PIECE:
                self.known[piece] = merge_long(raw, self.ranks)
            else:
                by_leaves.setdefault(1 << (len(raw) - 1).bit_length(), []).append((piece, raw))
        for leaves, group in by_leaves.items():
            step = max(1, FOREST_LEAVES // leaves)
            for start in range(0, len(group), step):
                some = group[start : start + step]
                merged = Forest([raw for _, raw in some], leaves, self.byte_ids, self.pairs).merge_all()
                for (piece, _), ids in zip(some, merged, strict=True):
                    self.known[piece] = ids

    def encode_block(self, texts: list[list[str]]) -> list[bytes]:
        """The ids of lists of pieces, as little-endian unsigned 32-bit integers."""
        self.learn([piece for pieces in texts for piece in pieces])
        return [b"".join(map(self.known.__getitem__, pieces)) for pieces in texts]

    def encode(self, texts: Iterable[tuple[object, str]]) -> Iterator[tuple[object, bytes]]:
        """(key, text) to (key, ids); texts are taken together up to `BLOCK_PIECES`."""
        keys: list[object] = []
        block: list[list[str]] = []
        held = 0
        for key, text in texts:
            if len(text) > 8 * BLOCK_PIECES:
                yield from zip(keys, self.encode_block(block), strict=True)
                keys, block, held = [], [], 0
                yield key, self._encode_long(text)
                continue
            pieces = self.pattern.findall(text)
            keys.append(key)
            block.append(pieces)
            held += len(pieces)
            if held >= BLOCK_PIECES:
                yield from zip(keys, self.encode_block(block), strict=True)
                keys, block, held = [], [], 0
        yield from zip(keys, self.encode_block(block), strict=True)

    def _encode_long(self, text: str) -> bytes:
        found = (match.group() for match in self.pattern.finditer(text))
        parts = []
        while pieces := list(islice(found, BLOCK_PIECES)):
            parts += self.encode_block([pieces])
        return b"".join(parts)


_ENCODERS: dict[tuple[int, str], Encoder] = {}


def _encoder(data: bytes, pattern: str) -> Encoder:
    """One encoder for each rank file in a Python worker, kept from task to task."""
    key = hash(data), pattern
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(parse_ranks(data), pattern)
    return _ENCODERS[key]


def _rank_file(spark: SparkSession, path: str):
    with open(path, "rb") as file:
        data = file.read(MAX_RANK_BYTES + 1)
    if len(data) > MAX_RANK_BYTES:
        raise ValueError(f"{path} is larger than {MAX_RANK_BYTES} bytes")
    return spark.sparkContext.broadcast(data)


def _rows_to(documents: DataFrame, id_col: str, columns: list[T.StructField]) -> T.StructType:
    return T.StructType([T.StructField("doc_id", documents.schema[id_col].dataType), *columns])


_IDS, _DECODED = T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())


def _encoded(rows: Iterable[tuple], data: bytes, pattern: str) -> Iterator[tuple]:
    """(id, text) to (id, ids)."""
    return _encoder(data, pattern).encode((doc_id, text or "") for doc_id, text in rows)


def _decoded(rows: Iterable[tuple], data: bytes) -> Iterator[tuple]:
    """(id, ids) to (id, ids, decoded)."""
    tokens = {rank: token for token, rank in parse_ranks(data).items()}
    for doc_id, ids in rows:
        yield doc_id, ids, b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _texts(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(documents[quoted(id_col)].alias("doc_id"), documents[quoted(text_col)].alias("text"))


def encode_documents(
    documents: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id and ids, little-endian unsigned 32-bit integers one after another."""
    ranks = _rank_file(documents.sparkSession, rank_path)
    schema = _rows_to(documents, id_col, [_IDS])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from arrow_batches(_encoded(batch_rows(batches), ranks.value, pattern), schema)

    return _texts(documents, id_col, text_col).mapInArrow(run, schema)


def decode_documents(encoded: DataFrame, rank_path: str) -> DataFrame:
    """Encoded documents with `decoded`, the bytes that their ids stand for."""
    ranks = _rank_file(encoded.sparkSession, rank_path)
    schema = _rows_to(encoded, "doc_id", [_IDS, _DECODED])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from arrow_batches(_decoded(batch_rows(batches), ranks.value), schema)

    return encoded.select("doc_id", "ids").mapInArrow(run, schema)


def round_trip(
    documents: DataFrame, rank_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, ids and decoded; both ways in one Python worker a task."""
    ranks = _rank_file(documents.sparkSession, rank_path)
    schema = _rows_to(documents, id_col, [_IDS, _DECODED])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        data = ranks.value
        yield from arrow_batches(_decoded(_encoded(batch_rows(batches), data, pattern), data), schema)

    return _texts(documents, id_col, text_col).mapInArrow(run, schema)


def token_digests(documents: DataFrame, rank_path: str, pattern: str) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256."""
    return round_trip(documents, rank_path, pattern).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document by the public ranks."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return token_digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
