"""The stages of the corpus pipeline: operators whose decisions take effect on documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fragloom.llm.byte_bpe import token_digests
from fragloom.llm.common import table
from fragloom.llm.decontaminate import drop_leaks
from fragloom.llm.near_copies import keep_one_of_alike
from fragloom.llm.quality import keep_good
from fragloom.llm.suffix_array import cut_repeats


#: Rows of one Arrow batch between Spark and Python, where the session has Spark's own number of 10,000.
ROWS_A_BATCH = 1000


def _small_batches(spark: SparkSession) -> None:
    """Let texts go to Python in smaller batches, as documents are longer than the rows that Spark's number is for.

    The session keeps the setting, as a stage's frame is only run when it is written.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(name)) == 10_000:
        spark.conf.set(name, str(ROWS_A_BATCH))


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier learned from the given labels predicts to be good, unchanged."""
    _small_batches(spark)
    return keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id, unchanged.

    Near-duplicates have 0.8 or more of their five-word shingles in common (Jaccard).
    """
    _small_batches(spark)
    return keep_one_of_alike(docs)


def cut_repeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; from their texts go the 400-byte strings that start elsewhere too.

    Nothing is cut below a whole character, and n_chars follows the text. A text that is
    all repeats stays as an empty one.
    """
    _small_batches(spark)
    return cut_repeats(docs)


def remove_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of the benchmark, unchanged."""
    _small_batches(spark)
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def to_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per document its number of tokens and the digests of its ids and of the bytes they decode to."""
    _small_batches(spark)
    import public_tokenizers

    return token_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
