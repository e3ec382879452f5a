"""A quality classifier: kernel ridge regression in random Fourier features, calibrated.

A text is described by statistics of its characters, words and lines. Random Fourier
features of the standardised statistics approximate a Gaussian kernel; every partition
sums its share of the normal equations, whose size depends on the number of features
alone, and the driver solves them. Ridge predictions of other labelled rows, counted on a
fixed grid, are fitted by isotonic regression, which turns a prediction into the share of
good documents among those predicted like it.

Labels are learned from rows with crc32(doc_id as text) mod 4 in 0, 1 (ridge) and 3
(calibration); rows with 2 are held out. Texts are read once, their statistics written to
the shared folder. Only a text's statistics enter its score: not labels, id, language or source.

A null text counts as empty, and an empty text has the statistics of no characters. A
null id is not held out and has no label. Labels that are null are left out; several
labels of one id each count. Repeated rows are scored alike, once each. Without any
label to learn from, every score is 1: nothing speaks against a document. Without
calibration rows, predictions are cut to 0 and 1. Other columns play no part.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.llm.common import arrow_batches, batch_rows, quoted, stored, table, utf8

FOURIER_FEATURES = 192
RIDGE = 1e-3
# Texts that are Python objects at a time.
SLICE = 256

THRESHOLD = 0.7

# Cells of the calibration grid between predictions 0 and 1; as many lie beyond on either side.
GRID = 512

_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "stop": b".?!",
    "comma": b",;:",
    "symbol": b"#$%&*+=@^_~|<>/\\[]{}",
    "beyond_ascii": range(128, 256),
}
_OF_CLASS = np.array([[b in members for b in range(256)] for members in _CLASSES.values()], float).T

STATISTICS = (
    "log_bytes",
    *_CLASSES,
    "entropy",
    "word_length",
    "word_length_spread",
    "distinct_words",
    "commonest_word",
    "plain_words",
    "capital_words",
    "log_line_bytes",
    "repeated_lines",
    "stopped_lines",
)


def statistics_of(text: bytes) -> list[float]:
    """The statistics of a text, none of which grows faster than the logarithm of its length."""
    size = len(text)
    if not size:
        return [0.0] * len(STATISTICS)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    inked = max(1, size - int(counts[_SPACE].sum()))
    shares = counts[counts > 0] / size
    words = text.split()
    seen = Counter(words)
    n = max(1, len(words))
    lengths = np.fromiter(map(len, words), float, len(words)) if words else np.zeros(1)
    lines = [line for line in text.split(b"\n") if line.strip()]
    repeated = sum(len(line) * (times - 1) for line, times in Counter(lines).items())
    held = sum(map(len, lines))
    return [
        math.log1p(size),
        *np.sqrt(counts @ _OF_CLASS / inked).tolist(),
        float(-(shares * np.log2(shares)).sum()),
        math.log1p(float(lengths.mean())),
        math.log1p(float(lengths.std())),
        # A long text repeats its words more: compare with the root of its length.
        math.log(max(1, len(seen)) / math.sqrt(n)),
        seen.most_common(1)[0][1] / n if words else 0.0,
        sum(times for word, times in seen.items() if word.strip(b".,;:?!").isalpha() or not word.isascii()) / n,
        sum(times for word, times in seen.items() if word.isupper()) / n,
        math.log1p(held / max(1, len(lines))),
        repeated / max(1, held),
        sum(line.rstrip().endswith((b".", b"?", b"!")) for line in lines) / max(1, len(lines)),
    ]


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, mod 4; null ids as no text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4


def describe(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id and its statistics, written once to the shared folder."""
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema[id_col].dataType),
            T.StructField("stats", T.ArrayType(T.DoubleType(), False)),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from arrow_batches(((doc_id, statistics_of(text)) for doc_id, text in batch_rows(batches)), schema)

    rows = documents.select(documents[quoted(id_col)].alias("doc_id"), utf8(quoted(text_col)).alias("text"))
    return stored(rows.mapInArrow(run, schema), "statistics")


@dataclass(frozen=True)
class FourierMap:
    """Standardised statistics to random Fourier features of a Gaussian kernel, and a constant."""

    mean: np.ndarray
    spread: np.ndarray
    directions: np.ndarray
    phases: np.ndarray

    @classmethod
    def draw(cls, mean: list[float], spread: list[float], features: int) -> FourierMap:
        random = np.random.default_rng(3)
        width = math.sqrt(len(mean) / 2)  # of the kernel, in standard deviations
        directions = random.normal(size=(len(mean), features)) / width
        phases = random.uniform(0, 2 * math.pi, features)
        return cls(np.array(mean), np.maximum(np.array(spread), 1e-3), directions, phases)

    def __call__(self, stats: np.ndarray) -> np.ndarray:
        # Far outliers would all look alike to the kernel; keep them at its edge.
        scaled = np.clip((stats - self.mean) / self.spread, -4, 4)
        waves = np.cos(scaled @ self.directions + self.phases) * math.sqrt(2 / len(self.phases))
        return np.hstack([waves, np.ones((len(stats), 1))])


@dataclass(frozen=True)
class Scorer:
    """What is learned: the feature map, ridge weights and the calibration's steps."""

    features: FourierMap
    weights: np.ndarray
    steps: tuple[np.ndarray, np.ndarray] | None = None

    def predict(self, stats: np.ndarray) -> np.ndarray:
        return self.features(stats) @ self.weights

    def score(self, stats: np.ndarray) -> np.ndarray:
        predicted = self.predict(stats)
        if self.steps is not None:
            predicted = np.interp(predicted, *self.steps)
        return np.clip(predicted, 0.0, 1.0)


def _stats_of(batch: pa.RecordBatch, column: int, width: int) -> np.ndarray:
    return np.asarray(batch.column(column).flatten()).reshape(batch.num_rows, width)


def normal_equations(labelled: DataFrame, features: FourierMap) -> tuple[np.ndarray, np.ndarray, int]:
    """Sums over all rows (stats, label) of z z', z y and 1, one partial sum a partition."""
    n = len(features.phases) + 1
    shared = labelled.sparkSession.sparkContext.broadcast(features)
    schema = T.StructType([T.StructField("cell", T.LongType()), T.StructField("value", T.DoubleType())])
    row, column = np.triu_indices(n + 1)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n + 1, n + 1))
        for batch in batches:
            z = shared.value(_stats_of(batch, 0, len(STATISTICS)))
            z = np.hstack([z, np.asarray(batch.column(1), float)[:, None]])
            total += z.T @ z
        if total[n - 1, n - 1]:
            cells = [pa.array(row * (n + 1) + column), pa.array(total[row, column])]
            yield pa.RecordBatch.from_arrays(cells, names=schema.names)

    sums = labelled.select("stats", "label").mapInArrow(run, schema).groupBy("cell").agg(F.sum("value"))
    total = np.zeros((n + 1) ** 2)
    for cell, value in sums.collect():  # a fixed number of cells
        total[cell] = value
    total = total.reshape(n + 1, n + 1)
    total = total + np.triu(total, 1).T
    return total[:n, :n], total[:n, n], int(total[n - 1, n - 1])


def isotonic(groups: list[tuple[float, float, int]]) -> tuple[np.ndarray, np.ndarray]:
    """(prediction, sum of labels, rows) in ascending order to the best ascending steps."""
    pools: list[list[float]] = []
    for at, labels, rows in groups:
        pools.append([at, at, labels, rows])
        while len(pools) > 1 and pools[-2][2] * pools[-1][3] >= pools[-1][2] * pools[-2][3]:
            _, end, labels, rows = pools.pop()
            pools[-1][1] = end
            pools[-1][2] += labels
            pools[-1][3] += rows
    at = [x for start, end, _, _ in pools for x in (start, end)]
    level = [labels / rows for _, _, labels, rows in pools for _ in range(2)]
    return np.array(at), np.array(level)


def _calibrate(labelled: DataFrame, scorer: Scorer) -> Scorer:
    shared = labelled.sparkSession.sparkContext.broadcast(scorer)
    schema = T.StructType([T.StructField("cell", T.LongType()), T.StructField("label", T.LongType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            predicted = shared.value.predict(_stats_of(batch, 0, len(STATISTICS)))
            cells = np.clip(np.floor(predicted * GRID), -GRID, 2 * GRID).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cells), batch.column(1)], names=schema.names)

    cells = labelled.select("stats", "label").mapInArrow(run, schema).groupBy("cell").agg(F.sum("label"), F.count("*"))
    groups = sorted(((cell + 0.5) / GRID, labels, rows) for cell, labels, rows in cells.collect())
    return Scorer(scorer.features, scorer.weights, isotonic(groups)) if groups else scorer


def learn(described: DataFrame, labels: DataFrame, features: int = FOURIER_FEATURES) -> Scorer | None:
    """Fit a scorer to labels (doc_id, quality) of described documents; None without labels."""
    known = labels.select("doc_id", F.col("quality").cast("bigint").alias("label")).where("label is not null")
    fold = fold_of(F.col("doc_id"))
    known = known.where(fold != 2)
    labelled = stored(described.join(known, "doc_id").withColumn("fold", fold), "labelled-statistics")
    train = labelled.where(F.col("fold").isin(0, 1))
    columns = [F.get("stats", F.lit(i)) for i in range(len(STATISTICS))]
    moments = train.agg(*map(F.avg, columns), *map(F.stddev_pop, columns)).first()
    if moments[0] is None:
        return None
    half = len(STATISTICS)
    fourier = FourierMap.draw(list(moments[:half]), list(moments[half:]), features)
    gram, target, rows = normal_equations(train, fourier)
    penalty = RIDGE * rows * np.eye(len(gram)) / len(fourier.phases)
    penalty[-1, -1] = 0
    weights = np.linalg.solve(gram + penalty, target)
    return _calibrate(labelled.where("fold = 3"), Scorer(fourier, weights))


def score_documents(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    described = describe(documents)
    scorer = learn(described, labels)
    shared = documents.sparkSession.sparkContext.broadcast(scorer)
    schema = T.StructType([described.schema["doc_id"], T.StructField("score", T.DoubleType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = shared.value
        for batch in batches:
            stats = _stats_of(batch, 1, len(STATISTICS))
            scores = np.ones(len(stats)) if scorer is None else scorer.score(stats)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores)], names=schema.names)

    return described.mapInArrow(run, schema).select(
        "doc_id",
        (fold_of(F.col("doc_id")) == 2).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(documents: DataFrame, labels: DataFrame, text_col: str = "text") -> DataFrame:
    """The documents that the learned scorer predicts to be good, with all their columns.

    Only texts reach Python, once, and some hundred at a time become objects there.
    """
    scorer = documents.sparkSession.sparkContext.broadcast(learn(describe(documents), labels))

    @F.arrow_udf("boolean")
    def good(texts: pa.Array) -> pa.Array:
        if scorer.value is None:
            return pa.array(np.ones(len(texts), bool))
        kept = []
        for at in range(0, len(texts), SLICE):
            stats = list(map(statistics_of, texts.slice(at, SLICE).to_pylist()))
            kept.append(scorer.value.score(np.array(stats).reshape(len(stats), len(STATISTICS))) >= THRESHOLD)
        return pa.array(np.concatenate(kept) if kept else np.zeros(0, bool))

    return documents.where(good(utf8(quoted(text_col))))


def op3_fourier_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, as the labels mark it."""
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
