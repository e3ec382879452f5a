"""The catalog of stored tables and splits.

One small snapshot table, a row per stored table or split. Publishing writes the
next snapshot, so whatever it names appears at once and only after its data is
complete. A store has one writer at a time; a second one is refused when it
publishes a change to something that is no longer as it found it.
"""

from __future__ import annotations

import json
import re
from dataclasses import asdict, dataclass, field, replace

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.errors import ConflictError, NotFragmentedError
from fragloom.functions.ranges import DEFAULT_COLUMN, DEFAULT_HI, DEFAULT_LO, RangeSpec
from fragloom.operators.splits import last_fragment
from fragloom.session import remove_path

BASE, RANGE, ROUND_ROBIN = "base", "range", "round_robin"

# The names fragments are known by.
FRAGMENT_PREFIX = {RANGE: "range_part", ROUND_ROBIN: "rrobin_part"}

# Snapshots that stay for readers that began before a change; so many folders are listed.
KEPT_SNAPSHOTS = 8

SNAPSHOT_SCHEMA = T.StructType(
    [
        T.StructField("table_name", T.StringType(), False),
        T.StructField("kind", T.StringType(), False),
        T.StructField("partition_count", T.IntegerType(), False),
        T.StructField("column", T.StringType()),
        T.StructField("lo", T.DoubleType()),
        T.StructField("hi", T.DoubleType()),
        T.StructField("out_of_range", T.StringType()),
        T.StructField("path", T.StringType(), False),
        T.StructField("data_schema", T.StringType(), False),
        T.StructField("last_commit", T.IntegerType(), False),
        T.StructField("n_rows", T.LongType(), False),
        T.StructField("dealt", T.LongType(), False),
        T.StructField("streams", T.MapType(T.StringType(), T.LongType())),
    ]
)


@dataclass(frozen=True)
class Entry:
    """What is known about a stored table (kind ``base``) or one of its splits."""

    table_name: str
    kind: str
    path: str
    data_schema: str
    partition_count: int = 0
    column: str | None = None
    lo: float | None = None
    hi: float | None = None
    out_of_range: str | None = None
    last_commit: int = -1
    n_rows: int = 0
    # Round-robin turns taken so far; the next row goes to fragment dealt % n.
    dealt: int = 0
    # Last micro-batch each streaming query has committed.
    streams: dict[str, int] = field(default_factory=dict)

    @property
    def spec(self) -> RangeSpec:
        return RangeSpec(
            self.partition_count,
            self.column or DEFAULT_COLUMN,
            DEFAULT_LO if self.lo is None else self.lo,
            DEFAULT_HI if self.hi is None else self.hi,
            self.out_of_range or "drop",
        )

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromJson(json.loads(self.data_schema))

    @property
    def last_partition_index(self) -> int:
        """The round-robin cursor: fragment of the last row, -1 when empty."""
        return (self.dealt - 1) % self.partition_count if self.dealt else -1

    def after(self, added: int, start: int | None = None, stream: tuple[str, int] | None = None) -> Entry:
        """The entry once one more commit, of `added` rows dealt from `start`, is in place."""
        return replace(
            self,
            last_commit=self.last_commit + 1,
            n_rows=self.n_rows + added,
            dealt=(self.dealt if start is None else start) + added,
            streams={**self.streams, stream[0]: stream[1]} if stream else self.streams,
        )


class Catalog:
    """Lookups and publishing."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._path = f"{root}/_catalog"
        # Snapshots never change once published, so entries found stay valid for their version.
        self._found: dict[tuple[int, str, str], Entry | None] = {}

    def _read(self, path: str) -> DataFrame:
        return self._spark.read.schema(SNAPSHOT_SCHEMA).parquet(path)

    def _version(self) -> int:
        try:
            files = self._read(self._path).inputFiles()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            files = []
        return max((int(m[1]) for f in files if (m := re.search(r"/version=(\d+)/", f))), default=-1)

    def snapshot(self) -> DataFrame:
        """All entries as a DataFrame."""
        return self._at(self._version())

    def _at(self, version: int) -> DataFrame:
        if version < 0:
            return self._spark.createDataFrame([], SNAPSHOT_SCHEMA)
        return self._read(f"{self._path}/version={version}")

    def find(self, table: str, kind: str) -> Entry | None:
        """The entry, or None."""
        version = self._version()
        if version < 0:
            return None
        key = (version, table, kind)
        if key not in self._found:
            row = self._at(version).where((F.col("table_name") == table) & (F.col("kind") == kind)).first()
            self._found = {k: e for k, e in self._found.items() if k[0] == version}
            self._found[key] = _entry(row) if row else None
        return self._found[key]

    def get(self, table: str, kind: str) -> Entry:
        """The entry, or an error that says what is missing."""
        entry = self.find(table, kind)
        if entry is None:
            raise NotFragmentedError(
                f"table {table!r} is not loaded" if kind == BASE else f"table {table!r} has no {kind} split"
            )
        return entry

    def publish(self, *changes: tuple[Entry | None, Entry | None]) -> None:
        """Add, replace or remove entries, all at once.

        A change is the entry it was made from, None for a new one, and its
        successor, None to remove it. If an entry is no longer the former, nothing is
        published. Snapshots but for the last `KEPT_SNAPSHOTS` are removed.
        """
        named = [before or after for before, after in changes]
        for (before, _), one in zip(changes, named):
            if self.find(one.table_name, one.kind) != before:
                raise ConflictError(f"{one.kind} of table {one.table_name!r} was changed by another writer")
        entries = [after for _, after in changes if after is not None]
        version = self._version()
        following = self._spark.createDataFrame([], SNAPSHOT_SCHEMA)
        if entries:
            following = self._spark.range(1).select(F.inline(F.array(*[_literal(e) for e in entries])))
        if version >= 0:
            kept = self._at(version)
            for e in named:
                kept = kept.where((F.col("table_name") != e.table_name) | (F.col("kind") != e.kind))
            following = kept.unionByName(following)
        target = f"{self._path}/version={version + 1}"
        try:
            following.coalesce(1).write.mode("errorifexists").parquet(target)
        except AnalysisException as error:
            # A publish that died leaves an empty folder; a rival leaves a snapshot.
            if error.getCondition() != "PATH_ALREADY_EXISTS" or self._version() != version:
                raise
            following.coalesce(1).write.mode("overwrite").parquet(target)
        # What was not replaced is as before.
        known = {k[1:]: e for k, e in self._found.items() if k[0] == version}
        known |= {(one.table_name, one.kind): after for one, (_, after) in zip(named, changes)}
        self._found = {(version + 1, *k): e for k, e in known.items()}
        if version + 1 >= KEPT_SNAPSHOTS:
            remove_path(self._spark, f"{self._path}/version={version + 1 - KEPT_SNAPSHOTS}")

    def entries(self) -> DataFrame:
        """One row per table and split: fragments, rows, and the round-robin cursor."""
        cursor = F.when(F.col("kind") == ROUND_ROBIN, last_fragment(F.col("dealt"), F.col("partition_count")))
        return self.snapshot().select(
            "table_name", "kind", "partition_count", "n_rows", cursor.alias("last_partition_index")
        )

    def fragments(self) -> DataFrame:
        """One row per fragment of every split, empty ones included."""
        prefix = F.create_map(*[F.lit(x) for pair in FRAGMENT_PREFIX.items() for x in pair])
        return (
            self.snapshot()
            .where(F.col("kind") != BASE)
            .select(
                "table_name",
                "kind",
                prefix[F.col("kind")].alias("_prefix"),
                F.explode(F.sequence(F.lit(0), F.col("partition_count") - 1)).alias("fragment_id"),
            )
            .select(
                "table_name",
                "kind",
                "fragment_id",
                F.concat("_prefix", F.col("fragment_id").cast("string")).alias("fragment_name"),
            )
        )


def _entry(row: Row) -> Entry:
    return Entry(**{**row.asDict(), "streams": dict(row["streams"] or {})})


def _literal(entry: Entry) -> Column:
    """The entry as one struct literal, which needs no Python worker."""
    values = asdict(entry)
    streams = [F.lit(x) for pair in values["streams"].items() for x in pair]
    values["streams"] = F.create_map(*streams)
    return F.struct(*[F.lit(values[f.name]).cast(f.dataType).alias(f.name) for f in SNAPSHOT_SCHEMA])
