"""Prefix trie of conversations from padded matrices of turn ids.

A conversation is a series of turns (role, text). Every distinct series of first d turns is a
node; conversations that begin with it are its members. Series of turn ids (128 bits of
hash of role and text) are exchanged by ranges of the whole series, ties by conversation, so
a series that a third of all conversations share is divided among shards as well.

A shard numbers its turns densely and lays them out as a matrix, one conversation a row, padded
with -1, `PANEL` columns at a time so that one long conversation does not widen all rows.
`numpy.lexsort` orders the rows; where a column differs from the row before, a mask is set and
accumulated by OR along the columns: a set cell begins a node. `reduceat` then sums members,
words, leaves and children of every depth, the deepest first.

Only nodes on the path of a shard's first or last row may go on in another shard. What they
need is additive: members, words of members, words of nodes, leaves and children. Parts are
added by node; where the last row of a shard and the first of the next share a path, its
nodes were counted on both sides and are taken off once. The digest of a node's ends follows
the shards in order, a part at a time. Shards grow in number with the table, about
`SHARD_TURNS` turns each, and hold ids, never texts.

Turns are ordered by turn, null first, ties by their ids; a null role or text is empty. Rows
without a conv_id belong to no conversation and play no part. A conversation is the unit that
one task holds, as 24 bytes a turn. No rows give no nodes. Other columns play no part.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, quoted, stored, table, tasks

PANEL = 32
SHARD_TURNS = 1 << 20

NO_ENDS = hashlib.sha256(b"").hexdigest()


# Conversations as series of turns

TURN_TYPE = "array<struct<a:bigint,b:bigint,words:bigint>>"


def series(
    conversations: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv_id, turns): the id, in two halves, and the number of words of each turn, in order."""
    role, text = (F.coalesce(conversations[quoted(c)], F.lit("")) for c in (role_col, text_col))
    conv, turn = conversations[quoted(id_col)], conversations[quoted(turn_col)]
    words = F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("bigint")
    # Two hashes of the same pair, the second one begun with another seed.
    named = F.struct(
        turn.isNotNull().alias("some"), turn.alias("turn"), F.xxhash64(role, text).alias("a"),
        F.xxhash64(F.lit("turn"), text, role).alias("b"), words.alias("words"),
    )
    rows = conversations.where(conv.isNotNull()).select(conv.alias("conv_id"), named.alias("turn"))
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")).select(
        "conv_id", F.transform("turns", lambda t: F.struct(t["a"], t["b"], t["words"])).cast(TURN_TYPE).alias("turns")
    )


def branched(series: DataFrame, family: Column, own: Column, most: int) -> DataFrame:
    """Series that begin with the first turns, `own` of them, of the series whose id is their `family`.

    `own` is `most` at most. Their own turns follow after as many. Families are small, so a
    window over one is as well.
    """
    kin = Window.partitionBy("family")
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, most))).over(kin)
    rows = series.withColumn("family", family).withColumn("own", own).withColumn("head", head)
    taken = F.slice(F.coalesce("head", F.array().cast(TURN_TYPE)), F.lit(1), F.col("own"))
    rest = F.slice("turns", F.col("own") + 1, F.size("turns"))
    return rows.select("conv_id", F.concat(taken, rest).alias("turns"))


# One shard

class Shard:
    """Conversations (conv ids, lengths, flat turn ids and words), and what all their prefixes come to."""

    def __init__(self, convs: np.ndarray, lengths: np.ndarray, ids: np.ndarray, words: np.ndarray):
        self.convs, self.lengths, self.ids, self.words = convs, lengths, ids, words
        self.offsets = np.cumsum(lengths) - lengths
        # Words from each turn to the end of its conversation.
        before = np.concatenate([[0], np.cumsum(words)])
        ends = np.repeat(self.offsets + lengths, lengths)
        self.onward = before[ends] - before[:-1]
        self.dense = self._dense()
        self.panels = list(self._panels())
        self.first, self.last = self._path(0), self._path(-1)

    def _dense(self) -> np.ndarray:
        """Turns by number, equal ones alike and in the order of their ids."""
        order = np.lexsort((self.ids[:, 1], self.ids[:, 0]))
        new = np.any(np.diff(self.ids[order], axis=0, prepend=self.ids[order[:1]]) != 0, axis=1)
        dense = np.empty(len(order), np.int32)
        dense[order] = np.cumsum(new)
        return dense

    def _panels(self) -> Iterator[tuple]:
        """(depth before, rows in order, which cells begin a node, which hold a turn) panel by panel."""
        rows, group, depth = np.arange(len(self.convs)), np.zeros(len(self.convs), np.int64), 0
        while len(rows):
            columns = depth + np.arange(PANEL)
            held = columns < self.lengths[rows][:, None]
            at = np.minimum(self.offsets[rows][:, None] + columns, max(0, len(self.dense) - 1))
            cells = np.where(held, self.dense[at], -1) if len(self.dense) else np.full(held.shape, -1)
            order = np.lexsort((self.convs[rows], *cells.T[::-1], group))
            rows, group, cells, held = rows[order], group[order], cells[order], held[order]
            change = np.ones((len(rows), PANEL + 1), bool)
            change[1:, 0] = group[1:] != group[:-1]
            change[1:, 1:] = cells[1:] != cells[:-1]
            begins = np.logical_or.accumulate(change, axis=1)
            group = np.cumsum(begins[:, -1])
            yield depth, rows, begins[:, 1:] & held, held, group
            depth += PANEL
            more = self.lengths[rows] > depth
            rows, group = rows[more], group[more]

    def _path(self, side: int) -> int:
        """A row whose series is the first or the last of all."""
        row = -1
        for depth, rows, _, _, group in self.panels:
            row = rows[side]
            tied = rows[group == group[side]]
            ended = self.lengths[tied] <= depth + PANEL
            if side == 0 and ended.any():
                return int(tied[ended][0])
            if ended.all():
                return int(tied[0])
        return int(row)

    def path_of(self, row: int) -> list[bytes]:
        """The names of the nodes on a row's path, the root first."""
        start = self.offsets[row]
        name = xxhash.xxh3_128()
        names = [name.digest()]
        for pair in self.ids[start : start + self.lengths[row]]:
            name.update(pair.tobytes())
            names.append(name.digest())
        return names

    def nodes(self) -> Iterator[tuple]:
        """Of each depth, deepest first: (depth, rows in order, first places of nodes, and an array a figure).

        Figures are members, least conv, words of members from here on, words of nodes from here
        on, leaves, children, and words of the node's own last turn.
        """
        n = len(self.convs)
        node_words, leaves, begun = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
        for depth, rows, begins, held, _ in reversed(self.panels):
            for column in reversed(range(PANEL)):
                at = np.flatnonzero(held[:, column])
                if not len(at):
                    continue
                members, starts = rows[at], np.flatnonzero(begins[at, column])
                turn = self.offsets[members] + depth + column
                own = self.words[turn[starts]]
                yield self._figures(depth + column + 1, members, starts, self.onward[turn], own, node_words, leaves, begun)
        order = np.argsort(self.convs, kind="stable")
        onward = np.zeros(n, np.int64)
        some = self.lengths > 0
        onward[some] = self.onward[self.offsets[some]]
        root = np.zeros(1, np.int64)
        yield self._figures(0, order, root, onward[order], root, node_words, leaves, begun)

    def _figures(self, depth, members, starts, onward, own, node_words, leaves, begun) -> tuple:
        firsts = members[starts]
        counts = np.diff(starts, append=len(members))
        ended = np.add.reduceat((self.lengths[members] == depth).astype(np.int64), starts)
        # Each node's own words, and each leaf, lie with one of its rows: sums over rows hold them once.
        node_words[firsts] += own
        leaves[firsts[ended == counts]] += 1
        children = np.add.reduceat(begun[members], starts)
        begun[members] = 0
        begun[firsts] = 1
        figures = [
            counts, np.minimum.reduceat(self.convs[members], starts), np.add.reduceat(onward, starts),
            np.add.reduceat(node_words[members], starts), np.add.reduceat(leaves[members], starts), children, own,
        ]
        return depth, members, starts, ended, figures


_LONGS = ("conv_id", "depth", "parent_conv_id", "n_convs", "row_words", "node_words", "n_leaves", "n_children", "words")
_PARTS = T.StructType(
    [
        T.StructField("shard", T.LongType()),
        *(T.StructField(name, T.LongType()) for name in _LONGS),
        # Of an inner node: its digest. Of one on the edge: its name, the sides it is on, its ends.
        T.StructField("ends_sha256", T.StringType()),
        T.StructField("node", T.BinaryType()),
        T.StructField("parent", T.BinaryType()),
        T.StructField("on_first", T.BooleanType()),
        T.StructField("on_last", T.BooleanType()),
        T.StructField("ends", T.BinaryType()),
    ]
)


def _joined(convs: np.ndarray) -> bytes:
    return ",".join(map(str, convs.tolist())).encode()


def shard_parts(shard: Shard, number: int) -> Iterator[tuple]:
    """Rows of `_PARTS`: finished nodes, nodes on the edges of the shard, and children of those."""
    names = {id_: shard.path_of(id_) for id_ in {shard.first, shard.last}}
    # Depth by depth towards the root, so children wait until their parents are known.
    waiting: list = []
    waiting_firsts = np.zeros(0, np.int64)
    for depth, members, starts, ended, figures in shard.nodes():
        counts = figures[0]
        # Which node of this depth each member is in, to find the children's parents.
        of = np.empty(len(shard.convs), np.int64)
        of[members] = np.repeat(np.arange(len(starts)), counts)
        edges: dict[int, list] = {}
        for row, side in ((shard.first, 0), (shard.last, 1)):
            if shard.lengths[row] >= depth:
                edges.setdefault(int(of[row]), [None, False, False])[0] = names[row][depth]
                edges[int(of[row])][1 + side] = True
        least = figures[1].tolist()
        for (rows, is_edge), first in zip(waiting, waiting_firsts.tolist(), strict=True):
            parent = int(of[first])
            if is_edge:
                yield rows
            elif parent in edges:
                yield (*rows[:3], None, *rows[4:12], edges[parent][0], *rows[13:])
            else:
                yield (*rows[:3], least[parent], *rows[4:])
        ends = members[shard.lengths[members] == depth]
        stops = np.cumsum(ended)
        waiting, columns = [], [f.tolist() for f in figures]
        for i, (n, low, row_words, node_words, n_leaves, n_children, own) in enumerate(zip(*columns, strict=True)):
            joined = _joined(shard.convs[ends[stops[i] - ended[i] : stops[i]]]) if ended[i] else b""
            head = (number, low, depth, None, n, row_words, node_words, n_leaves, n_children, own)
            if i in edges:
                name, on_first, on_last = edges[i]
                waiting.append(((*head, None, name, None, on_first, on_last, joined), True))
            else:
                digest = hashlib.sha256(joined).hexdigest() if joined else NO_ENDS
                waiting.append(((*head, digest, None, None, None, None, None), False))
        waiting_firsts = members[starts]
    for rows, _ in waiting:
        yield rows


def _shards(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    convs, lengths, ids, words = [], [], [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        turns = batch.column(1)
        flat = turns.flatten()
        convs.append(batch.column(0).to_numpy())
        lengths.append(np.diff(turns.offsets.to_numpy()))
        ids.append(np.stack([flat.field(k).to_numpy() for k in (0, 1)], axis=1))
        words.append(flat.field(2).to_numpy())
    if convs:
        shard = Shard(*map(np.concatenate, (convs, lengths, ids, words)))
        yield from arrow_batches(shard_parts(shard, TaskContext.get().partitionId()), _PARTS)


# All shards together

def _shared_paths(edges: DataFrame) -> DataFrame:
    """Per node that the last row of a shard and the first row of the next share: what was counted twice."""
    shards = edges.where("depth = 0").select("shard")
    # One number a shard.
    after = shards.select("shard", F.lead("shard").over(Window.orderBy("shard")).alias("next")).where("next IS NOT NULL")
    last = edges.where("on_last").select("shard", "node", "depth", "words")
    first = edges.where("on_first").select(F.col("shard").alias("next"), "node")
    lengths = last.groupBy("shard").agg(F.max("depth").alias("length"))
    both = last.join(after, "shard").join(first, ["next", "node"]).join(lengths, "shard")
    below = Window.partitionBy("shard").orderBy(F.col("depth").desc())
    whole = Window.partitionBy("shard")
    deepest = F.max("depth").over(whole)
    return both.select(
        "node",
        F.sum("words").over(below).alias("node_words"),
        (deepest == F.col("length")).cast("bigint").alias("n_leaves"),
        (F.col("depth") < deepest).cast("bigint").alias("n_children"),
    )


def _digests(edges: DataFrame) -> DataFrame:
    """(node, ends_sha256): the ends of nodes on edges, hashed shard after shard as they stream by."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("ends_sha256", T.StringType())])

    def digests(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def run() -> Iterator[tuple]:
            name = state = None
            for node, ends in batch_rows(batches):
                if node != name:
                    if name is not None:
                        yield name, state.hexdigest()
                    name, state = node, hashlib.sha256(ends)
                else:
                    state.update(b"," + ends)
            if name is not None:
                yield name, state.hexdigest()

        yield from arrow_batches(run(), schema)

    some = edges.where("length(ends) > 0").select("node", "shard", "ends")
    ordered = some.repartition(tasks(edges), "node").sortWithinPartitions("node", "shard")
    return ordered.select("node", "ends").mapInArrow(digests, schema)


def trie(series: DataFrame, n_turns: int) -> DataFrame:
    """All nodes of series (conv_id, turns) of about `n_turns` turns; columns as `op13_prefix_trie`."""
    shards = max(tasks(series), -(-n_turns // SHARD_TURNS))
    names = F.transform("turns", lambda t: F.struct(t["a"], t["b"]))
    dealt = series.withColumn("names", names).repartitionByRange(shards, "names", "conv_id").drop("names")
    parts = stored(dealt.mapInArrow(_shards, _PARTS), "trie-parts")
    edges = parts.where("node IS NOT NULL")
    added = edges.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"),
        *(F.sum(c).alias(c) for c in ("n_convs", "row_words", "node_words", "n_leaves", "n_children")),
    )
    twice = _shared_paths(edges).groupBy("node").agg(
        *(F.sum(c).alias(f"less_{c}") for c in ("node_words", "n_leaves", "n_children"))
    )
    less = lambda c: (F.col(c) - F.coalesce(f"less_{c}", F.lit(0))).alias(c)
    whole = added.join(twice, "node", "left").select(
        "node", "conv_id", "depth", "n_convs", "row_words", less("node_words"), less("n_leaves"), less("n_children")
    )
    whole = stored(whole, "trie-edges")
    # The node above, on the same path of the same shard.
    path = edges.select("shard", "node", "depth", "on_first", "on_last").join(whole.select("node", "conv_id"), "node")
    sides = [path.where(s).select("shard", F.lit(s).alias("side"), "node", "depth", "conv_id") for s in ("on_first", "on_last")]
    up = Window.partitionBy("shard", "side").orderBy("depth")
    linked = sides[0].union(sides[1]).withColumn("parent_conv_id", F.lag("conv_id").over(up))
    parents = linked.groupBy("node").agg(F.min("parent_conv_id").alias("parent_conv_id"))
    outer = whole.join(parents, "node").join(_digests(edges), "node", "left")
    inner = parts.where("node IS NULL AND parent IS NULL")
    known = path.select("shard", F.col("node").alias("parent"), F.col("conv_id").alias("above"))
    below = parts.where("parent IS NOT NULL").join(known, ["shard", "parent"]).withColumn("parent_conv_id", F.col("above"))
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
        (F.col("row_words") - F.col("node_words")).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256"),
    ]
    return outer.select(columns).union(inner.select(columns)).union(below.select(columns))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trie of all conversations, each begun with the first turns of the one whose number 20 divides."""
    rows = table(spark, sf_dir, "conversations")
    family = F.col("conv_id") - F.col("conv_id") % 20
    own = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).cast("int")
    return trie(branched(series(rows), family, own, 3), rows.count())
