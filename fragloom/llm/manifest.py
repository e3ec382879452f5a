"""Merkle manifest of a dataset: a tree of hashes by slot pivots, with a proof for every row.

Rows become leaves, the leaves of a group (a source) form a tree of `FANOUT` children a node
whose top is the group's subroot, and the subroots form one more tree, whose top is the root.

A node is one row of a frame. To go up a level, `pivot` groups nodes by their parent (position
div fanout) and spreads them with conditional aggregates into one column a slot; all columns
concatenated are hashed to the parent. On the way down, a slot's siblings are the same
columns without its own. Levels are few (the logarithm of the largest group, base 16); each
is written once to the shared folder and read again on the way down.

Positions come without a task that sees a whole group: leaves are exchanged by ranges of (group,
id, leaf), sorted in their part and written once with their place there; the rows of each
part and group, summed over the parts before, give the offset. A group of all rows is divided
like any other; only those sums, one row a part and group, are ordered.

Only ids, groups and hashes are shuffled, never texts. Everything is DataFrame functions, no
Python on the executors.

Nulls: a null field is hashed as `-`, which no value is; a null group is a group of its own,
before all others, a null id is before all others in its group. Rows alike in group and id
follow by their leaves, so repeated rows take neighbouring places, each with its own
proof. One row makes a tree without a level: its leaf is the root and its proof is empty. No
rows give no rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fragloom.llm.common import quoted, stored, table, tasks

FANOUT = 16

# monotonically_increasing_id has the partition above this bit, the place below.
_PLACE_BITS = 33

KEY = ["no_group", "group"]


def hashed(*inputs: Column) -> Column:
    """SHA-256 of the inputs put together, in lower-case hexadecimal."""
    return F.sha2(F.concat(*inputs).cast("binary"), 256)


def leaf_of(fields: Sequence[Column]) -> Column:
    """The hash of a row's fields, each `-` or its number of bytes, a colon and its value."""

    def input_of(field: Column) -> Column:
        value = field.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return hashed(*map(input_of, fields))


def numbered(leaves: DataFrame) -> DataFrame:
    """Rows (no_group, group, id, hash, ..) with `place` in their group from 0, and `n`, the group's rows."""
    by = [F.col("no_group").desc(), "group", F.col("id").asc_nulls_first(), "hash"]
    parts = leaves.repartitionByRange(tasks(leaves), *by).sortWithinPartitions(*by)
    placed = stored(parts.withColumn("at", F.monotonically_increasing_id()), "manifest-leaves")
    placed = placed.withColumn("part", F.shiftright("at", _PLACE_BITS))
    counts = placed.groupBy(*KEY, "part").agg(F.count("*").alias("rows"), F.min("at").alias("first"))
    whole = Window.partitionBy(*KEY)
    before = F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select(
        *KEY, "part", (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n")
    )
    return placed.join(counts, [*KEY, "part"]).withColumn("place", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _slots() -> list[str]:
    return [f"slot{k}" for k in range(FANOUT)]


def _text(slot: str) -> Column:
    """The hash in a slot, nothing if it is free."""
    return F.coalesce(F.col(slot)["hash"], F.lit(""))


def pivot(nodes: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """Parents of nodes (no_group, group, n, place, hash): the same columns of the level above, and slots.

    A slot holds a child's hash and payload, or null. Groups of one node have arrived and are left out.
    """
    slot = F.col("place") % FANOUT
    child = F.struct("hash", *payload)
    spread = [F.max(F.when(slot == k, child)).alias(name) for k, name in enumerate(_slots())]
    parents = (
        nodes.where("n > 1")
        .groupBy(*KEY, "n", F.floor(F.col("place") / FANOUT).cast("bigint").alias("place"))
        .agg(*spread)
    )
    above = F.ceil(F.col("n") / FANOUT).cast("bigint").alias("n")
    return parents.select(*KEY, above, "place", hashed(*map(_text, _slots())).alias("hash"), *_slots())


def children(parents: DataFrame, payload: Sequence[str] = ()) -> DataFrame:
    """The nodes in the slots of parents with `path` and `top`: (no_group, group, top, place, hash, payload, path).

    A path is a series of (before, after), the siblings to the left and right, from the
    node's own run up to the root; that of its parent is the column `path`. `top` goes along.
    """

    def child(k: int) -> Column:
        sides = [F.concat(F.lit(""), *map(_text, some)) for some in (_slots()[:k], _slots()[k + 1 :])]
        step = F.struct(sides[0].alias("before"), sides[1].alias("after"))
        kept = [F.col(f"slot{k}")[name].alias(name) for name in ("hash", *payload)]
        path = F.concat(F.array(step), F.col("path")).alias("path")
        place = (F.col("place") * FANOUT + k).alias("place")
        return F.when(F.col(f"slot{k}").isNotNull(), F.struct(place, *kept, path))

    held = F.explode(F.filter(F.array(*map(child, range(FANOUT))), lambda c: c.isNotNull())).alias("child")
    return parents.select(*KEY, "top", held).select(*KEY, "top", "child.*")


def _grow(nodes: DataFrame, payload: Sequence[str]) -> list[DataFrame]:
    """The levels above nodes, lowest first, each written once."""
    levels: list[DataFrame] = []
    most = nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        levels.append(stored(pivot(levels[-1] if levels else nodes, () if levels else payload), "manifest-level"))
        most = -(-most // FANOUT)
    return levels


def _paths(levels: Sequence[DataFrame], tops: DataFrame, payload: Sequence[str]) -> DataFrame:
    """(no_group, group, top, hash, payload, path) of the nodes below the lowest level.

    `tops` has (no_group, group, top, path) of every tree, `top` being its own hash. Trees end at
    different levels: on its way down a level meets the paths from above and the tops that
    begin there.
    """
    down = None
    for height in reversed(range(len(levels))):
        level = levels[height]
        ends = level.where("n = 1").select(*KEY)
        above = tops.join(ends, KEY, "left_semi").select(*KEY, "top", F.lit(0).cast("bigint").alias("place"), "path")
        if down is not None:
            above = above.union(down.select(*KEY, "top", "place", "path"))
        down = children(level.join(above, [*KEY, "place"]), payload if height == 0 else ())
        if height:
            down = stored(down, "manifest-paths")
    return down.select(*KEY, "top", "hash", *payload, "path")


def manifest(
    rows: DataFrame, fields: Sequence[str], group_col: str, id_col: str, payload: Sequence[Column] = ()
) -> DataFrame:
    """Per row: id, leaf, subroot, root, path (see `children`) and the payload as own0, own1, .."""
    group = rows[quoted(group_col)].cast("string")
    names = [f"own{i}" for i in range(len(payload))]
    leaves = numbered(
        rows.select(
            group.isNull().alias("no_group"),
            F.coalesce(group, F.lit("")).alias("group"),
            rows[quoted(id_col)].alias("id"),
            leaf_of([rows[quoted(f)] for f in fields]).alias("hash"),
            *(column.alias(name) for column, name in zip(payload, names, strict=True)),
        )
    )
    carried = ["id", *names]
    levels = _grow(leaves, carried)
    subroots = reduce(DataFrame.union, [frame.where("n = 1").select(*KEY, "hash") for frame in (leaves, *levels)])
    # The subroots are the leaves of one more tree: one group, the null one first in it.
    first = F.struct((~F.col("no_group")).alias("a"), F.col("group").alias("b")).alias("id")
    one = F.lit(False).alias("no_group"), F.lit("").alias("group")
    upper = numbered(subroots.select(*one, first, "hash"))
    upper_levels = _grow(upper, ["id"])
    root = (upper_levels[-1] if upper_levels else upper).select("hash").first()
    root = F.lit(root[0] if root else None).cast("string")
    none = F.array().cast("array<struct<before:string,after:string>>").alias("path")
    if upper_levels:
        tops = _paths(upper_levels, upper_levels[-1].select(*KEY, F.col("hash").alias("top"), none), ["id"])
    else:
        tops = upper.select("id", "hash", none)
    tops = stored(
        tops.select((~F.col("id.a")).alias("no_group"), F.col("id.b").alias("group"), F.col("hash").alias("top"), "path"),
        "manifest-subroots",
    )
    below = leaves.where("n = 1").join(tops, KEY).select("top", "hash", *carried, "path")
    if levels:
        below = below.union(_paths(levels, tops, carried).select("top", "hash", *carried, "path"))
    return below.select("id", F.col("hash").alias("leaf"), F.col("top").alias("subroot"), root.alias("root"), "path", *names)


def proof_hash(path: Column) -> Column:
    """The hash of all siblings of a path, left to right, level by level."""
    return hashed(F.array_join(F.transform(path, lambda s: F.concat(s["before"], s["after"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, s: hashed(s["before"], node, s["after"]))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def op12_slot_pivot_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its proof, folded again from a text in lower case where 5 divides the id's CRC."""
    docs = table(spark, sf_dir, "documents")
    chosen = F.crc32(docs["doc_id"].cast("string").cast("binary")) % 5 == 0
    lowered = F.translate(docs["text"], _UPPER, _UPPER.lower())
    tampered = F.when(chosen, leaf_of([lowered if f == "text" else docs[f] for f in FIELDS]))
    rows = manifest(docs, FIELDS, "source", "doc_id", [tampered])
    fold = folded(F.coalesce("own0", "leaf"), F.col("path"))
    return rows.select(
        F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof_hash(F.col("path")).alias("proof_sha256"),
        fold.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
