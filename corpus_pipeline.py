"""From raw documents to token ids: each stage works on all that the one before it kept.

A stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet and
read again as the docs of the next. Documents are rejected or cut as each stage's
docstring says; all but the last return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from fragloom.llm import stages
from fragloom.llm.common import stored, table

STAGES = [
    ("quality", stages.keep_quality),
    ("near_duplicates", stages.drop_near_duplicates),
    ("repeated_bytes", stages.cut_repeated_bytes),
    ("decontamination", stages.remove_leaks),
    ("tokens", stages.to_tokens),
]

# Learning, hashing of shingles and merging of byte pairs are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
