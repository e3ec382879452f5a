"""Near copies by the true likeness of their texts: all pairs at or above it, whatever their length.

A text is the set of its five-word shingles, as hashes of 64 bits. Texts are near copies if the
sets have a Jaccard likeness of 0.8 or more; groups are the components of all such pairs.
Texts without words have the empty set, which only equals itself.

The first links come from SimHash: the sets' fingerprints, found by multi-index tables if two bits
apart at most (`simhash`), and confirmed by the complete sets. No Hamming distance includes every
such pair (0.8 gives up to 16 of 64 bits on given tables), so what is not one component by then
goes on to an index that cannot miss a pair. In any order of all
shingles two such sets have a shingle in common among the first fifth of each, plus one. The
order puts those first that few texts hold, by a sketch of counts of a fixed 4 MB: a shared
line or passage comes last and seldom is a key. When the sketch fills up, keys hold more
candidates and results stay the same. Candidates are verified with their complete sets.

Equal sets are one node, known by 64 bits of hash. Where nodes meet at a key, the place that it
has in the order of either set bounds what they can have in common: all of it comes at the key or
behind, and one of their keys is the first. So an entry whose place is too late for even the
smallest set at its key is dropped before any pair is made: texts that share most of a form,
but less than 0.8, have their own shingles first and make no pairs. Rounds compare what is left
with a few nodes of its key only and join what is alike; nodes of a key that are one component
already need no comparison. The first comparison always is such a round, so that a group of near copies
makes no pairs of all its members; every round takes other nodes, as the last may have been unlike the
group around them. When a round does not halve the pairs, the nodes that remain are ranked anew by exact counts among themselves, and pairs that their places allow are compared.

Before complete sets are brought together, a pair must pass by marks of 128 bytes, the parities of
the numbers of shingles in 1,024 parts: two sets differ in at least as many shingles as parities,
so no pair that is alike is lost, and few others are left whose sets must travel. Marks are compared
where nodes meet at a key, so that of a crowd only such pairs become rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.bitmaps import bitmap_of, held, may_hold
from fragloom.llm.common import arrow_batches, batch_rows, quoted, stored, tasks, tidy, utf8
from fragloom.llm.components import connected_components
from fragloom.llm.simhash import SEED, keep_first_of_each, near_fingerprints, shingle_hashes, simhash

SHINGLE_WORDS = 5

# Likeness as a fraction of whole numbers: no rounding decides.
ALIKE, OF = 4, 5

SLOTS = 1 << 20
_PART = 1 << 14

# Shingles after which a Python stage hands a batch back.
ROWS = 1 << 15

# Pairs for each entry of the index that are compared without a round before.
PAIRS = 4

# Nodes of a key with which a round compares the others.
HUBS = 8

# Parities of a mark, in words of 64.
MARK_WORDS = 16

# Pairs of one node that are verified by one copy of its set.
PAIRS_A_COPY = 4096


def shingle_set(text: bytes) -> np.ndarray:
    """The hashes of a text's shingles, each once, in order."""
    return np.unique(shingle_hashes(text, SHINGLE_WORDS))


def node_of(shingles: np.ndarray) -> int:
    """A set's name: 64 bits of its hash, signed."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), SEED)).astype(np.int64))


def prefix_of(size: int) -> int:
    """How many of its first shingles a set must show: alike sets have one in common there."""
    return size - -(-ALIKE * size // OF) + 1 if size else 0


def index_keys(shingles: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """The first shingles of a set, rare ones before others."""
    wanted = prefix_of(len(shingles))
    counts = sketch[(shingles & np.uint64(len(sketch) - 1)).astype(np.int64)]
    return shingles[np.lexsort((shingles, counts))[:wanted]]


def mark_of(shingles: np.ndarray) -> np.ndarray:
    """Whether an odd number of a set's shingles is in each part, as words of 64 bits."""
    odd = np.bincount((shingles & np.uint64(64 * MARK_WORDS - 1)).astype(np.int64), minlength=64 * MARK_WORDS) & 1
    return np.packbits(odd.astype(bool)).view(np.int64)


def count_sketch(texts: DataFrame):
    """A broadcast array of how many texts hold a shingle of each slot, for one column of texts."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(SLOTS, np.uint32)
        for (raw,) in batch_rows(batches):
            np.add.at(counts, (shingle_set(raw) & np.uint64(SLOTS - 1)).astype(np.int64), 1)
        parts = ((at // _PART, counts[at : at + _PART].tobytes()) for at in range(0, SLOTS, _PART))
        yield from arrow_batches((p for p in parts if any(p[1])), schema)

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part, counts in batch_rows(batches):
            sums[part] = sums.get(part, 0) + np.frombuffer(counts, np.uint32).astype(np.uint64)
        rows = ((part, np.minimum(s, 0xFFFFFFFF).astype(np.uint32).tobytes()) for part, s in sums.items())
        yield from arrow_batches(rows, schema)

    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("counts", T.BinaryType())])
    sketch = np.zeros(SLOTS, np.uint32)
    with tidy(texts.sparkSession):
        summed = texts.mapInArrow(run, schema).repartition(tasks(texts), "part").mapInArrow(add, schema).collect()
    for part, counts in summed:
        sketch[part * _PART : (part + 1) * _PART] = np.frombuffer(counts, np.uint32)
    return texts.sparkSession.sparkContext.broadcast(sketch)


def _columns(keys: list[np.ndarray], nodes: list[np.ndarray]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (keys, nodes)], names=["key", "node"])


def index_documents(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, text_hash, node and size; where it may have a candidate, `keys`, their `places` in
    the order of the set, the set's fingerprint `fp` and its `mark`; written once."""
    text = documents[quoted(text_col)]
    texts = documents.select(utf8(quoted(text_col)).alias("text"))
    sketch = count_sketch(texts)
    long = T.LongType()
    pair = T.StructType([T.StructField("key", long), T.StructField("node", long)])
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[id_col].dataType),
            *(T.StructField(name, long) for name in ("text_hash", "node", "size")),
            *(T.StructField(name, T.ArrayType(long)) for name in ("keys", "places")),
            T.StructField("fp", long),
            T.StructField("mark", T.ArrayType(long)),
        ]
    )

    def keys_alone(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, nodes, size = [], [], 0
        for (raw,) in batch_rows(batches):
            shingles = shingle_set(raw)
            keys.append(index_keys(shingles, sketch.value).view(np.int64))
            nodes.append(np.full(len(keys[-1]), node_of(shingles)))
            size += len(keys[-1])
            if size >= ROWS:
                yield _columns(keys, nodes)
                keys, nodes, size = [], [], 0
        if keys:
            yield _columns(keys, nodes)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def found() -> Iterator[tuple]:
            for doc_id, text_hash, raw in batch_rows(batches):
                shingles = shingle_set(raw)
                keys = index_keys(shingles, sketch.value)
                places = np.flatnonzero(held(shared.value, keys))
                more = (keys[places].view(np.int64), places, simhash(shingles), mark_of(shingles)) if len(places) else (None,) * 4
                yield doc_id, text_hash, node_of(shingles), len(shingles), *more

        yield from arrow_batches(found(), schema)

    met = texts.mapInArrow(keys_alone, pair).groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("b"))
    shared = bitmap_of(met.where("a < b").select("key"))
    rows = documents.select(documents[quoted(id_col)].alias("doc_id"), F.xxhash64(text).alias("text_hash"), utf8(quoted(text_col)).alias("text"))
    return stored(rows.mapInArrow(run, schema), "shingle-index")


def _reaches(place: str, size: str, other: Column) -> Column:
    """Whether a set can be alike to one of size `other` that it meets at this place first."""
    # In common are at most the shingles from the place on: size - place >= ALIKE / (ALIKE + OF) of both sizes.
    return (F.col(size) - F.col(place)) * (ALIKE + OF) >= (F.col(size) + other) * ALIKE


def live_entries(entries: DataFrame) -> DataFrame:
    """Entries (key, node, size, place, ..) that some set at their key can be alike to, by places and sizes."""
    least = entries.groupBy("key").agg(F.min("size").alias("least"), F.min("node").alias("a"), F.max("node").alias("b"))
    named = entries.join(least.where("a < b").select("key", "least"), "key")
    # No partner is smaller than the least at the key, nor than ALIKE / OF of the set itself.
    smallest = F.greatest(F.col("least").cast("double"), F.col("size") * (ALIKE / OF))
    return named.where(_reaches("place", "size", smallest - F.lit(1e-6))).drop("least")


def _alike_sizes() -> Column:
    return (F.col("size") * OF >= F.col("v_size") * ALIKE) & (F.col("v_size") * OF >= F.col("size") * ALIKE)


def _near() -> Column:
    return _alike_sizes() & _reaches("place", "size", F.col("v_size")) & _reaches("v_place", "v_size", F.col("size"))


def _sets_of(named: DataFrame, nodes: DataFrame, reps: DataFrame) -> DataFrame:
    """(node, shingles) of some nodes, each once, made anew from the texts (rep, text) that stand for them.

    A few other nodes may come as well.
    """
    shared = bitmap_of(nodes.distinct().join(reps, "node").select("rep"))
    long = T.LongType()
    schema = T.StructType([T.StructField("node", long), T.StructField("shingles", T.ArrayType(long))])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        some: list[tuple] = []
        size = 0
        for _, raw in batch_rows(batches):
            shingles = shingle_set(raw)
            some.append((node_of(shingles), shingles.view(np.int64)))
            # Sets are large beside what arrow_batches counts: a few at a time.
            size += len(shingles)
            if size >= ROWS:
                yield from arrow_batches(some, schema)
                some, size = [], 0
        yield from arrow_batches(some, schema)

    # Repeated rows have the same name: one of them stays.
    return named.where(may_hold(shared, F.col("rep"))).mapInArrow(run, schema).dropDuplicates(["node"])


def _rep() -> Column:
    return F.xxhash64("doc_id", "text_hash")


def _marks_agree(size: str, mark: str, v_size: str, v_mark: str) -> Column:
    odd = reduce(lambda a, b: a + b, (F.bit_count(F.col(mark)[k].bitwiseXOR(F.col(v_mark)[k])) for k in range(MARK_WORDS)))
    # They differ in `odd` shingles at least, and alike ones in (OF - ALIKE) / (OF + ALIKE) of both sizes at most.
    return odd * (ALIKE + OF) <= (F.col(size) + F.col(v_size)) * (OF - ALIKE)


def may_be_alike(pairs: DataFrame, marks: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes that the marks (node, size, mark) do not show to be unlike."""
    sides = [marks.select(F.col("node").alias(n), F.col("size").alias(f"{n}_size"), F.col("mark").alias(f"{n}_mark")) for n in "uv"]
    return pairs.join(sides[0], "u").join(sides[1], "v").where(_marks_agree("u_size", "u_mark", "v_size", "v_mark")).select("u", "v")


def candidates(live: DataFrame, marks: DataFrame, turn: int | None) -> DataFrame:
    """Pairs (u, v) of nodes of other components that meet at a key of `live` and may be alike by places, sizes and marks.

    In a round `turn`, v is one of the first `HUBS` nodes of its key in the order of that round; without, any.
    """
    order = F.xxhash64("node", F.lit(turn or 0))
    live = live.join(marks.select("node", "mark"), "node").withColumn("order", order)
    other = live
    if turn is not None:
        rank = F.row_number().over(Window.partitionBy("key").orderBy("order", "node"))
        other = live.withColumn("rank", rank).where(F.col("rank") <= HUBS)
    columns = ("node", "size", "place", "root", "mark", "order")
    other = other.select("key", *(F.col(c).alias(f"v_{c}") for c in columns))
    # The order is the same at all keys, so a pair is met one way round.
    after = F.struct("v_order", "v_node") < F.struct("order", "node")
    wanted = (F.col("root") != F.col("v_root")) & after & _near() & _marks_agree("size", "mark", "v_size", "v_mark")
    return live.join(other, "key").where(wanted).select(F.col("node").alias("u"), F.col("v_node").alias("v")).distinct()


def _alike(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (u, v) of nodes whose complete sets are alike."""
    one = sets.select(F.col("node").alias("u"), F.col("shingles").alias("a"))
    # A node in many pairs has some copies of its set, to which they are dealt.
    copies = pairs.groupBy("v").agg(F.ceil(F.count("*") / PAIRS_A_COPY).cast("int").alias("copies"))
    other = sets.select(F.col("node").alias("v"), F.col("shingles").alias("b")).join(copies, "v")
    other = other.select("v", "b", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("salt"))
    salted = pairs.join(copies, "v").select("u", "v", F.pmod(F.xxhash64("u"), F.col("copies")).cast("int").alias("salt"))
    both = F.size(F.array_intersect("a", "b"))
    # both / (a + b - both) >= ALIKE / OF
    enough = both * (ALIKE + OF) >= (F.size("a") + F.size("b")) * ALIKE
    return salted.join(one, "u").join(other, ["v", "salt"]).where(enough).select("u", "v")


def ranked_entries(sets: DataFrame) -> DataFrame:
    """The index (key, node, size, place) of sets (node, shingles), in the exact order of how many of them hold a shingle."""
    size = F.size("shingles")
    words = sets.select("node", size.alias("size"), F.explode("shingles").alias("key"))
    counts = words.groupBy("key").agg(F.count("*").alias("texts")).where("texts > 1")
    common = words.join(counts, "key")
    # Shingles of one set only come first and need no entries.
    whole = Window.partitionBy("node")
    order = F.row_number().over(whole.orderBy("texts", "key"))
    place = (F.col("size") - F.count("*").over(whole) + order - 1).alias("place")
    needed = F.col("size") - F.ceil(F.col("size") * ALIKE / OF) + 1
    return common.select("key", "node", "size", place).where(F.col("place") < needed)


def simhash_links(nodes: DataFrame, named: DataFrame, reps: DataFrame) -> DataFrame:
    """Links (u, v) of nodes (node, size, fp, mark) whose fingerprints the multi-index tables find near, if their sets are alike.

    Of nodes with one fingerprint the first stands for it, and the others are compared with that one.
    """
    first = stored(nodes.groupBy("fp").agg(F.min(F.struct("node", "size")).alias("first")), "fingerprint-nodes")
    near = near_fingerprints(first.select("fp")).select(F.least("u", "v").alias("fp"), F.greatest("u", "v").alias("v_fp")).distinct()
    other = first.select(F.col("fp").alias("v_fp"), F.col("first").alias("v_first"))
    sides = [F.col(f"{side}.{name}").alias(to) for side, at in (("first", ""), ("v_first", "v_")) for name, to in (("node", at + "node"), ("size", at + "size"))]
    met = near.where("fp <> v_fp").join(first, "fp").join(other, "v_fp").select(*sides)
    same = nodes.join(first, "fp").select("node", "size", F.col("first.node").alias("v_node"), F.col("first.size").alias("v_size"))
    met = met.union(same.where("node <> v_node")).where(_alike_sizes()).select(F.col("node").alias("u"), F.col("v_node").alias("v"))
    met = stored(may_be_alike(met, nodes), "near-fingerprints")
    sets = _sets_of(named, met.select(F.col("u").alias("node")).union(met.select("v")), reps)
    return stored(_alike(met, sets), "alike-fingerprints")


def alike_components(index: DataFrame, named: DataFrame) -> DataFrame | None:
    """(node, root) of every node of `index_documents` that is alike another; None if there are none.

    `named` has the texts again (rep, text), from which the sets of candidates alone are made.
    """
    some = index.where("keys IS NOT NULL")
    reps = stored(some.groupBy("node").agg(F.min(_rep()).alias("rep")), "set-names")
    once = some.select("node", _rep().alias("rep"), "size", "fp", "mark", F.arrays_zip("keys", "places").alias("at"))
    once = once.join(reps, ["node", "rep"], "left_semi").dropDuplicates(["node"])
    entries = once.select("node", "size", F.explode("at").alias("at")).select(
        F.col("at.keys").alias("key"), "node", "size", F.col("at.places").alias("place")
    )
    entries = stored(live_entries(entries), "set-entries")
    nodes = stored(once.select("node", "size", "fp", "mark"), "set-marks")
    links, found = simhash_links(nodes, named, reps), None
    if not links.isEmpty():
        found = stored(connected_components(links), "alike-components")
    before, ranked = None, False
    for turn in count():
        rooted = entries.withColumn("root", F.col("node"))
        if found is not None:
            rooted = entries.join(found, "node", "left").withColumn("root", F.coalesce("root", "node"))
        # Pairs of a key whose nodes are not one component yet.
        n = F.col("n").cast("double")
        apart = (
            rooted.groupBy("key", "root").agg(F.count("*").alias("n")).groupBy("key")
            .agg(F.sum("n").alias("rows"), ((F.sum(n) * F.sum(n) - F.sum(n * n)) / 2).alias("pairs")).where("pairs > 0")
        )
        apart = stored(apart, "keys-apart")
        rows, pairs = apart.agg(F.sum("rows"), F.sum("pairs")).first()
        if not rows:
            return found
        live = stored(rooted.join(apart.select("key"), "key", "left_semi"), "live-entries")
        crowded = pairs > PAIRS * rows
        stuck = before is not None and 2 * pairs > before
        before = pairs
        if crowded and stuck and not ranked:
            ranked = True
            entries = stored(live_entries(ranked_entries(_sets_of(named, live.select("node"), reps))), "set-entries")
            continue
        last = turn > 0 and (stuck or not crowded)
        met = stored(candidates(live, nodes, None if last else turn), "candidates")
        sets = _sets_of(named, met.select(F.col("u").alias("node")).union(met.select("v")), reps)
        fresh = stored(_alike(met, sets), "alike")
        links = links.union(fresh)
        found = stored(connected_components(links), "alike-components")
        if last:
            return found


def keep_one_of_alike(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the smallest id of their group, with all their columns; of repeated rows, one."""
    index = index_documents(documents, id_col, text_col)
    named = index.select("doc_id", "text_hash", "node")
    text = documents[quoted(text_col)]
    rep = F.xxhash64(documents[quoted(id_col)], F.xxhash64(text))
    found = alike_components(index, documents.select(rep.alias("rep"), utf8(quoted(text_col)).alias("text")))
    if found is not None:
        named = named.join(found, "node", "left").select("doc_id", "text_hash", F.coalesce("root", "node").alias("node"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("first")
    keepers = named.groupBy("node").agg(first).select("first.doc_id", "first.text_hash")
    return keep_first_of_each(documents, keepers, id_col, text_col)
