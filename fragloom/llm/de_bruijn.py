"""Substring dedup of words by De Bruijn compaction.

Every window of 20 consecutive words is an edge of the De Bruijn graph of the corpus, from its
first 19 words to its last 19. Only edges that occur again matter. Compaction has two steps:

* Where they lie: edges that follow each other in a document and share an anchor are one run. A
  run that occurs as a whole again stays one row for all its edges, known by a hash.
* Across runs, by Spark joins: a node between two runs branches unless every occurrence of the
  one is followed by the other and every occurrence of the other preceded by the one. Degrees are
  aggregated over all occurrences; runs that meet at nodes that do not branch are linked, and
  pointer jumping, one self-join a round and as many rounds as the logarithm of the longest
  chain, gives each its path and its place in it.

A path is read off with its number of occurrences; the source coordinates of its first one, the
smallest (doc_id, start), tell it from the others, whose words go. Where an anchor has several
different runs, so that they branch within, single edges are compared, by another join.

Paths may be as hot as the passages: counts are summed before any shuffle, joins on
hot keys are split by adaptive execution, and no bucket is gathered.

Hashes of a run are 64 bits for its anchor and 64 for its content, those of an edge
likewise. A null text has no words. Texts of fewer than 20 words are never cut. Rows of one
id and text are the same document, which is not earlier than itself; a null id is
smaller than all others. Repeated rows give as many rows. Other columns play no part.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.bitmaps import bitmap_of, may_hold
from fragloom.llm.common import arrow_batches, stored, table, tasks
from fragloom.llm.repeats import RepeatedRuns, Runs, WordText, _long, as_texts, covered, with_spans


def _edges(text: WordText, paths: Runs) -> Sequence:
    """Every edge of some paths: anchor, edge, start."""
    at = paths.windows()
    if not len(at):
        return [at] * 3
    return [np.repeat(paths.anchors, paths.counts), text.stretch(at, text.size), at]


RUN = ("anchor", "content")


def occurrences(paths: RepeatedRuns) -> DataFrame:
    """(doc, key, start, n, anchor, content, after, before): every place of a run that occurs again, once.

    `after` and `before` are the runs (anchor, content) that follow and precede it without a gap, or null.
    """
    again = paths.runs.where("times > 1").select(*RUN)
    places = paths.places.join(again, list(RUN), "left_semi")
    # Rows of one id and text are one document: its places count once.
    places = places.repartition(tasks(places), "doc", "key").dropDuplicates(["doc", "key", "start"])
    order = Window.partitionBy("doc", "key").orderBy("start")
    run = F.struct(*RUN)
    end = F.col("start") + F.col("n")
    meets = [F.lead("start").over(order) == end, F.lag(end).over(order) == F.col("start")]
    near = [F.lead(run).over(order), F.lag(run).over(order)]
    return places.select(
        "doc", "key", "start", "n", *RUN, F.when(meets[0], near[0]).alias("after"), F.when(meets[1], near[1]).alias("before")
    )


def nonbranching_links(places: DataFrame) -> DataFrame:
    """(run, head, ahead): runs with the only run before them, and how many edges that has.

    Both sides agree: all occurrences of the run come after `head`, all those of `head` before the run.
    """

    def only(name: str) -> Column:
        # By the numbers of a run, as Spark can keep those up to date in place, but not the least struct.
        same = F.count(name) == F.count("*")
        for part in RUN:
            same &= F.min(f"{name}.{part}") == F.max(f"{name}.{part}")
        return F.when(same, F.struct(*(F.min(f"{name}.{part}").alias(part) for part in RUN))).alias(name)

    degrees = places.groupBy(F.struct(*RUN).alias("run")).agg(only("after"), only("before"), F.min("n").alias("n"))
    degrees = stored(degrees, "run-degrees")
    head = degrees.select(F.col("run").alias("head"), F.col("after").alias("run"), F.col("n").alias("ahead")).where("run IS NOT NULL")
    linked = degrees.where("before IS NOT NULL").select("run", F.col("before").alias("head"))
    return linked.join(head, ["run", "head"])


def compact(links: DataFrame) -> DataFrame:
    """The links with `head` as the first run of the whole path, and `ahead` as all edges before the run.

    A path cannot be a ring: each of its occurrences would have one more after it in its document.
    """
    links = stored(links, "path-links")
    while True:
        far = links.select(F.col("run").alias("head"), F.col("head").alias("further"), F.col("ahead").alias("more"))
        jumped = links.join(far, "head", "left")
        links = stored(
            jumped.select(
                "run", F.coalesce("further", "head").alias("head"), (F.col("ahead") + F.coalesce("more", F.lit(0))).alias("ahead"),
                F.col("further").isNotNull().alias("moved"),
            ),
            "path-links",
        )
        if links.where("moved").isEmpty():
            return links.drop("moved")
        links = links.drop("moved")


def path_places(paths: RepeatedRuns) -> DataFrame:
    """(doc, key, start, n, first): every occurrence of a path of repeated edges, and the path's first place."""
    places = stored(occurrences(paths).withColumn("run", F.struct(*RUN)).drop(*RUN), "run-occurrences")
    links = compact(nonbranching_links(places.select("run.*", "n", "after", "before")))
    lengths = places.select("run", "n").distinct().join(links, "run").groupBy("head").agg(F.max(F.col("ahead") + F.col("n")).alias("edges"))
    # Only the first run of a path stands for it.
    heads = places.select("doc", "key", "start", "n", "run").join(links.select("run"), "run", "left_anti")
    named = paths.runs.where("times > 1").select(F.struct(*RUN).alias("run"), "first")
    named = named.join(lengths.withColumnRenamed("head", "run"), "run", "left")
    return heads.join(named, "run").select("doc", "key", "start", F.coalesce("edges", "n").alias("n"), "first")


def repeated_spans(texts: DataFrame) -> DataFrame:
    """(doc, key, start, n): n edges from start on that start earlier somewhere else."""
    paths = RepeatedRuns(texts, WordText)
    later = (F.col("doc").eqNullSafe(F.col("first.doc")) & (F.col("start") == F.col("first.start"))) == F.lit(False)
    whole = path_places(paths).where(later).select("doc", "key", "start", "n")
    edges = stored(paths.open(F.lit(True), _long("anchor", "edge", "start"), _edges), "branching-edges")
    firsts = (
        edges.groupBy("anchor", "edge")
        .agg(F.count("*").alias("times"), F.min(F.struct("doc", "start")).alias("first"))
        .where("times > 1")
    )
    firsts = stored(firsts.select("anchor", "edge", "first"), "repeated-edges")
    # Most edges within branching anchors occur once: few others than those that occur again are shuffled.
    again = bitmap_of(firsts.select(F.xxhash64("anchor", "edge")))
    edges = edges.where(may_hold(again, F.xxhash64("anchor", "edge")))
    single = edges.join(firsts, ["anchor", "edge"]).where(later).select("doc", "key", "start", F.lit(1).cast("bigint").alias("n"))
    return whole.union(single)


def remove_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_removed, kept (the words that stay, one space between them)."""
    texts = as_texts(documents, id_col, text_col)
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("n_removed", T.LongType()),
            T.StructField("kept", T.StringType()),
        ]
    )

    def run(rows: Iterable[tuple]) -> Iterator[pa.RecordBatch]:
        def kept() -> Iterator[tuple]:
            for doc, _, text, starts, counts in rows:
                words = text.split()
                gone = covered(len(words), starts, counts, WordText.size).tolist() if starts else []
                left = [w for w, cut in zip(words, gone, strict=True) if not cut] if gone else words
                yield doc, len(words), len(words) - len(left), b" ".join(left).decode()

        yield from arrow_batches(kept(), schema)

    return with_spans(texts, repeated_spans(texts), run, schema)


def op4_de_bruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 20-word windows that start earlier."""
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


