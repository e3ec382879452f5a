"""A store of base tables and their splits, as parquet below one shared folder.

Layout::

    <root>/<table>/base-<generation>/commit=<k>/*.parquet
    <root>/<table>/range-<generation>/commit=<k>/fragment_id=<i>/*.parquet
    <root>/_catalog/version=<v>/*.parquet

Every load and append writes one commit directory and then publishes it in the
catalog. Readers take the commits the catalog names, so a failed write is never
seen; its directory is overwritten by the next attempt.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import ExitStack, contextmanager
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fragloom.errors import AlreadyExistsError, ConflictError
from fragloom.functions.ranges import (
    DEFAULT_COLUMN,
    DEFAULT_HI,
    DEFAULT_LO,
    FRAGMENT_ID,
    RangeSpec,
    assign_range,
    check_fragment_count,
    fragment_span,
)
from fragloom.operators.bagprints import PRINT, add_prints, bag_print, bag_prints
from fragloom.operators.checks import tuple_count
from fragloom.operators.counts import fragment_profile, fragment_sizes
from fragloom.operators.intervals import interval_join, interval_totals
from fragloom.operators.numbering import free_name, number_rows, number_stored_rows
from fragloom.operators.sketches import merge_sketches, sketch_figures, sketch_fragments
from fragloom.operators.splits import assign_round_robin
from fragloom.plans.catalog import BASE, FRAGMENT_PREFIX, RANGE, ROUND_ROBIN, Catalog, Entry
from fragloom.plans.layout import FILE_BYTES, stored_bytes, write_batch, write_split
from fragloom.session import remove_path

_COMMIT = "commit"
# Beside the commits; readers pass over folders that begin with an underscore.
_PRINTS = "_prints"
_SKETCHES = "_sketches"
# Mark of a column, with its place in their order, that files are made to look up by.
_LOOKUP = "fragloom.lookup"
# Types whose least and greatest value a file's footer gives.
_IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType, T.BooleanType)
_TABLE_NAME = re.compile(r"\w[\w.-]*")
# Names that base tables cannot have: those of the store's own folders.
_OWN_FOLDERS = ("_catalog", "_staging")


class FragmentStore:
    """Load tables, split them, append to the splits and read them back."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")
        self.catalog = Catalog(spark, self.root)

    # -- base tables ---------------------------------------------------------

    def load(self, table: str, rows: DataFrame, mode: str = "append") -> None:
        """Append rows to a table, creating it if missing.

        With mode ``errorifexists`` the table must not exist yet.
        """
        if mode not in ("append", "errorifexists"):
            raise ValueError(f"mode must be append or errorifexists, got {mode!r}")
        if reserved := {_COMMIT, FRAGMENT_ID} & {name.lower() for name in rows.columns}:
            raise ValueError(f"column names {sorted(reserved)} are used by the store itself")
        if not _TABLE_NAME.fullmatch(table) or table in _OWN_FOLDERS:
            raise ValueError(f"{table!r} cannot be the name of a table")
        entry = self.catalog.find(table, BASE)
        if entry is not None and mode == "errorifexists":
            raise AlreadyExistsError(f"table {table!r} exists")
        loaded = self._write_base(entry or self._new_entry(table, BASE, rows.schema), rows)
        self.catalog.publish((entry, loaded))

    def base(self, table: str) -> DataFrame:
        """The rows of a loaded table."""
        return self._read(self.catalog.get(table, BASE))

    # -- splits --------------------------------------------------------------

    def split_range(
        self,
        table: str,
        n: int,
        column: str = DEFAULT_COLUMN,
        lo: float = DEFAULT_LO,
        hi: float = DEFAULT_HI,
        out_of_range: str = "drop",
        if_exists: str = "error",
        lookup_by: Sequence[str] = (),
    ) -> None:
        """Split a table into n equal-width ranges of a column: one scan, one write.

        Files of this split and its appends are made for finding single values of `lookup_by`.
        """
        spec = RangeSpec(n, column, float(lo), float(hi), out_of_range)
        base = self.catalog.get(table, BASE)
        replaced = self._replaced(table, RANGE, if_exists)
        entry = self._new_entry(
            table,
            RANGE,
            _marked(base.schema, lookup_by),
            partition_count=n,
            column=column,
            lo=spec.lo,
            hi=spec.hi,
            out_of_range=out_of_range,
        )
        split = assign_range(self._read(base), spec)
        entry = self._write_split(entry, split, stored_bytes(self.spark, base.path))
        self._publish((replaced, entry))

    def split_round_robin(
        self,
        table: str,
        n: int,
        order_by: str | Sequence[str] | None = None,
        if_exists: str = "error",
        lookup_by: Sequence[str] = (),
    ) -> None:
        """Deal the rows of a table out to n fragments in turn.

        Without `order_by` rows are taken in storage order and none is shuffled.
        With it they are taken in key order, ties in any order. `lookup_by` is as in `split_range`.
        """
        check_fragment_count(n)
        base = self.catalog.get(table, BASE)
        replaced = self._replaced(table, ROUND_ROBIN, if_exists)
        entry = self._new_entry(table, ROUND_ROBIN, _marked(base.schema, lookup_by), partition_count=n)
        size = stored_bytes(self.spark, base.path)
        with self._dealt(self._read(base), size, order_by, n) as split:
            entry = self._write_split(entry, split, size, _even(base.n_rows, n))
        self._publish((replaced, entry))

    # -- appends -------------------------------------------------------------

    def append_range(
        self,
        table: str,
        rows: DataFrame,
        also_base: bool = False,
        stream: tuple[str, int] | None = None,
    ) -> None:
        """Send a batch of rows to the fragments of a range split.

        The fragment depends on the row alone, so the batch is read once and written once, straight
        into its commit; with `also_base` the split is written from the base's new files.
        """
        entry = self.catalog.get(table, RANGE)
        if _is_committed(entry, stream):
            return
        changes = []
        rows = _conform(rows, entry)
        if also_base:
            base = self.catalog.get(table, BASE)
            grown = self._write_base(base, rows)
            changes.append((base, grown))
            path = _commit_path(grown)
            split = assign_range(self._stored(path, entry), entry.spec)
            grown = self._write_split(entry, split, stored_bytes(self.spark, path), stream=stream)
        else:
            path = _commit_path(entry, 1)
            write_batch(assign_range(rows, entry.spec), path, entry.partition_count, _lookup(entry))
            grown = entry.after(self._stored_rows(path, entry), stream=stream)
        self.catalog.publish(*changes, (entry, grown))

    def append_round_robin(
        self,
        table: str,
        rows: DataFrame,
        order_by: str | Sequence[str] | None = None,
        also_base: bool = False,
        stream: tuple[str, int] | None = None,
    ) -> None:
        """Deal a batch of rows out, continuing after the last row dealt.

        The cursor is the number of rows dealt so far. With `also_base` the batch is
        appended to the base table first and the cursor is the base's row count
        before it. The batch is stored once before it is numbered, and that copy
        removed when the split is written.
        """
        entry = self.catalog.get(table, ROUND_ROBIN)
        if _is_committed(entry, stream):
            return
        rows = _conform(rows, entry)
        changes = []
        start = entry.dealt
        with ExitStack() as scratch:
            if also_base:
                base = self.catalog.get(table, BASE)
                start = base.n_rows
                grown = self._write_base(base, rows)
                changes.append((base, grown))
                path = _commit_path(grown)
            else:
                path = scratch.enter_context(self._staged(rows, entry))
            stored, size = self._stored(path, entry), stored_bytes(self.spark, path)
            dealt = _even(stored.count(), entry.partition_count, start)
            split = scratch.enter_context(self._dealt(stored, size, order_by, entry.partition_count, start))
            grown = self._write_split(entry, split, size, dealt, start, stream)
        self.catalog.publish(*changes, (entry, grown))

    # -- upkeep --------------------------------------------------------------

    def compact(self, table: str, kind: str) -> None:
        """Rewrite all commits of a table or split as one; rows, cursor and streams stay.

        Readers that began before may fail, as the old files are removed.
        """
        entry = self.catalog.get(table, kind)
        rows, size = self._read(entry), stored_bytes(self.spark, entry.path)
        fresh = replace(entry, path=self._new_path(table, kind), last_commit=-1, n_rows=0)
        if kind == BASE:
            fresh = self._write_base(fresh, rows.coalesce(max(1, size // FILE_BYTES)) if size else rows)
        else:
            fresh = self._write_split(fresh, rows, size)
        if fresh.n_rows != entry.n_rows:
            raise ConflictError(f"{kind} of table {table!r} has {fresh.n_rows} rows, not {entry.n_rows}")
        self._publish((entry, replace(fresh, dealt=entry.dealt)))

    def drop(self, table: str, kind: str) -> None:
        """Forget a table or split and remove its files."""
        self._publish((self.catalog.get(table, kind), None))

    # -- reading -------------------------------------------------------------

    def split(self, table: str, kind: str) -> DataFrame:
        """All fragments of a split, with their ``fragment_id``."""
        return self._read(self.catalog.get(table, kind))

    def fragment(self, table: str, kind: str, fragment: int) -> DataFrame:
        """The rows of one fragment; other fragments are not read."""
        return self.split(table, kind).where(F.col(FRAGMENT_ID) == fragment).drop(FRAGMENT_ID)

    def rows_between(self, table: str, low: float, high: float) -> DataFrame:
        """Rows of a range split with ``low <= column <= high``.

        Only fragments whose range meets the interval are read; inside them the
        column filter reaches the scan.
        """
        entry = self.catalog.get(table, RANGE)
        rows = self._read(entry)
        span = fragment_span(entry.spec, low, high)
        if span is None:
            return rows.where(F.lit(False))
        return rows.where(F.col(FRAGMENT_ID).between(*span)).where(
            F.col(entry.column).between(F.lit(float(low)), F.lit(float(high)))
        )

    def count_tuple(self, table: str, kind: str, fragment: int, **values: object) -> DataFrame:
        """How often a tuple occurs in one fragment."""
        return tuple_count(self.split(table, kind), fragment, **values)

    def sizes(self, table: str, kind: str) -> DataFrame:
        """Rows per fragment, empty fragments included."""
        entry = self.catalog.get(table, kind)
        return fragment_sizes(self._read(entry), entry.partition_count)

    def prints(self, table: str, kind: str) -> DataFrame:
        """The print of every commit, and of every fragment in it for a split.

        A commit never changes, so it is hashed once, the first time it is asked for; its prints
        stay beside it and later calls read those few rows.
        """
        entry = self.catalog.get(table, kind)
        return self._by_commit(entry, _PRINTS, bag_print if kind == BASE else lambda rows: bag_prints(rows, FRAGMENT_ID))

    def sketches(self, table: str, kind: str, column: str) -> DataFrame:
        """Sketches of a column per commit and fragment of a split, each commit sketched once."""
        entry = self.catalog.get(table, kind)
        label = f"{_SKETCHES}/{column.encode().hex()}"
        return self._by_commit(entry, label, lambda rows: sketch_fragments(rows, FRAGMENT_ID, column))

    def quantiles(self, table: str, kind: str, column: str, ranks: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
        """Per fragment that has rows: n_rows, n_values, distinct_values and quantiles, by merged sketches."""
        merged = merge_sketches(self.sketches(table, kind, column), [FRAGMENT_ID])
        return sketch_figures(merged, [FRAGMENT_ID], ranks)

    def _by_commit(self, entry: Entry, label: str, make: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """What `make` finds in the rows of each commit, with ``commit``; kept in a folder beside them."""
        fragments = entry.kind != BASE
        for commit in range(entry.last_commit + 1):
            path = f"{entry.path}/{label}/{_COMMIT}={commit}"
            if not self._is_complete(path):
                made = make(self._read(entry, commit))
                # One row a fragment at most.
                made.coalesce(1).write.mode("overwrite").parquet(path)
        shape = make(self._read(entry)).schema
        if entry.last_commit < 0:
            return self.spark.createDataFrame([], shape.add(_COMMIT, T.IntegerType()))
        stored = self.spark.read.schema(shape.add(_COMMIT, T.IntegerType())).parquet(f"{entry.path}/{label}")
        found = stored.where(F.col(_COMMIT) <= entry.last_commit)
        return found.select(_COMMIT, *([FRAGMENT_ID] if fragments else []), *(f.name for f in shape if f.name not in (_COMMIT, FRAGMENT_ID)))

    def verify(self, table: str, kind: str) -> DataFrame:
        """One row: whether a split holds exactly the rows of its base, by prints alone."""
        sides = [add_prints(self.prints(table, k)).select(F.struct(*PRINT).alias(k), F.lit(0).alias("on")) for k in (BASE, kind)]
        both = sides[0].join(F.broadcast(sides[1]), "on")
        return both.select(
            F.col(f"{BASE}.n_rows").alias("base_rows"),
            F.col(f"{kind}.n_rows").alias("split_rows"),
            (F.col(BASE) == F.col(kind)).alias("reconstructs"),
        )

    def profile(self, table: str, kind: str, column: str = DEFAULT_COLUMN) -> DataFrame:
        """Per fragment: rows, value range, and the bounds of a range split."""
        entry = self.catalog.get(table, kind)
        spec = entry.spec if kind == RANGE else None
        column = entry.column if kind == RANGE else column
        return fragment_profile(self._read(entry), column, entry.partition_count, spec)

    def footer_profile(self, table: str, kind: str, column: str = DEFAULT_COLUMN) -> DataFrame:
        """Per fragment: n_rows, min_value and max_value, from file footers alone where they can tell.

        The figures of all files are added up by the scan itself (aggregate pushdown); no column is
        read. Footers give no figures of a column with NaN, and of strings, timestamps and decimals
        none that are exact; then the columns are scanned. NaN counts as greater than all numbers.
        """
        entry = self.catalog.get(table, kind)
        column = entry.column if kind == RANGE and column == DEFAULT_COLUMN else column
        kind_of = entry.schema[column].dataType
        found = None
        if isinstance(kind_of, _IN_FOOTERS):
            found = self._from_footers(entry, column)
        if found is None:
            return fragment_profile(self._read(entry), column, entry.partition_count).select(
                FRAGMENT_ID, "n_rows", "min_value", "max_value"
            )
        rows = [(i, *found.get(i, (0, None, None))) for i in range(entry.partition_count)]
        schema = T.StructType(
            [
                T.StructField(FRAGMENT_ID, T.IntegerType()),
                T.StructField("n_rows", T.LongType()),
                T.StructField("min_value", kind_of),
                T.StructField("max_value", kind_of),
            ]
        )
        return self.spark.createDataFrame(rows, schema)

    def footer_counts(self, entry: Entry, column: str) -> DataFrame:
        """n_rows, least and greatest value per commit and fragment, aggregated in the scan.

        Only the second reader of parquet files does so; a session of its own keeps that setting.
        """
        session = self.spark.newSession()
        session.conf.set("spark.sql.sources.useV1SourceList", "")
        session.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        schema = entry.schema.add(_COMMIT, T.IntegerType()).add(FRAGMENT_ID, T.IntegerType())
        stored = session.read.schema(schema).parquet(entry.path).where(F.col(_COMMIT) <= entry.last_commit)
        value = F.col("`" + column.replace("`", "``") + "`")
        return stored.groupBy(_COMMIT, FRAGMENT_ID).agg(F.count("*").alias("n"), F.min(value).alias("lo"), F.max(value).alias("hi"))

    def _from_footers(self, entry: Entry, column: str) -> dict[int, tuple] | None:
        """n_rows, least and greatest value by fragment; None if a footer does not tell."""
        if entry.last_commit < 0:
            return {}
        per_fragment = self.footer_counts(entry, column).groupBy(FRAGMENT_ID).agg(F.sum("n"), F.min("lo"), F.max("hi"))
        try:
            rows = per_fragment.collect()
        except Exception as error:  # The reader says so by an error of no class of its own.
            if "No min/max found" not in str(error):
                raise
            return None
        # Footers widen zero to both signs.
        plain = lambda v: v + 0.0 if isinstance(v, float) else v
        return {r[0]: (r[1], plain(r[2]), plain(r[3])) for r in rows}

    def join_intervals(self, table: str, intervals: DataFrame, low: str, high: str) -> DataFrame:
        """Rows of a range split with the intervals that hold their value; see `interval_join`."""
        entry = self.catalog.get(table, RANGE)
        return interval_join(self._read(entry), intervals, entry.spec, low, high)

    def interval_totals(self, table: str, intervals: DataFrame, low: str, high: str, column: str) -> DataFrame:
        """Per interval the rows of a range split that it holds and the least of a column; see `interval_totals`."""
        entry = self.catalog.get(table, RANGE)
        parts = stored_bytes(self.spark, entry.path) // FILE_BYTES
        return interval_totals(self._read(entry), intervals, entry.spec, low, high, column, parts)

    def partition_count(self, table: str, kind: str) -> int:
        """Number of fragments, 0 if the table has no such split."""
        entry = self.catalog.find(table, kind)
        return entry.partition_count if entry else 0

    def cursor(self, table: str) -> tuple[int, int]:
        """Fragments and last fragment dealt to; (0, -1) without a round-robin split."""
        entry = self.catalog.find(table, ROUND_ROBIN)
        return (entry.partition_count, entry.last_partition_index) if entry else (0, -1)

    def fragment_names(self, prefix: str = "") -> DataFrame:
        """Fragments whose name starts with the prefix, taken literally."""
        return self.catalog.fragments().where(F.col("fragment_name").startswith(prefix))

    def register_views(self, table: str, kind: str) -> None:
        """Temporary views of the fragments, such as ``range_part0``, for SQL."""
        entry = self.catalog.get(table, kind)
        rows = self._read(entry)
        for i in range(entry.partition_count):
            one = rows.where(F.col(FRAGMENT_ID) == i).drop(FRAGMENT_ID)
            one.createOrReplaceTempView(f"{FRAGMENT_PREFIX[kind]}{i}")

    # -- internals -----------------------------------------------------------

    def _new_path(self, table: str, kind: str) -> str:
        return f"{self.root}/{table}/{kind}-{uuid.uuid4().hex}"

    def _new_entry(self, table: str, kind: str, schema: T.StructType, **settings: object) -> Entry:
        return Entry(table, kind, self._new_path(table, kind), schema.json(), **settings)

    def _publish(self, change: tuple[Entry | None, Entry | None]) -> None:
        """Publish a change that puts an entry out of use, then remove its files."""
        self.catalog.publish(change)
        if change[0] is not None:
            remove_path(self.spark, change[0].path)

    def _replaced(self, table: str, kind: str, if_exists: str) -> Entry | None:
        """The split a new one takes the place of, if that is allowed."""
        if if_exists not in ("error", "overwrite"):
            raise ValueError(f"if_exists must be error or overwrite, got {if_exists!r}")
        entry = self.catalog.find(table, kind)
        if entry is not None and if_exists == "error":
            raise AlreadyExistsError(f"table {table!r} has a {kind} split")
        return entry

    @contextmanager
    def _scratch(self, label: str) -> Iterator[str]:
        """A fresh path, in the cluster's scratch folder if it names one; what is there goes afterwards."""
        folder = self.spark.conf.get("spark.checkpoint.dir", None) or f"{self.root}/_staging"
        path = f"{folder.rstrip('/')}/{label}-{uuid.uuid4().hex}"
        try:
            yield path
        finally:
            remove_path(self.spark, path)

    @contextmanager
    def _staged(self, rows: DataFrame, entry: Entry) -> Iterator[str]:
        """Where a copy of the rows is stored for a while."""
        with self._scratch(entry.table_name) as path:
            rows.write.parquet(path)
            yield path

    @contextmanager
    def _dealt(
        self, rows: DataFrame, size: int, order_by: str | Sequence[str] | None, n: int, start: int = 0
    ) -> Iterator[DataFrame]:
        """The rows with their fragment, by the order or, without one, as they are stored."""
        number = free_name(rows)
        with self._scratch("numbered") as path:
            if order_by is None:
                numbered = number_stored_rows(rows, number)
            else:
                numbered = number_rows(rows, order_by, number, path, size // FILE_BYTES)
            yield assign_round_robin(numbered, n, start, number)

    def _is_complete(self, path: str) -> bool:
        target = self.spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        return target.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(target)

    def _read(self, entry: Entry, commit: int | None = None) -> DataFrame:
        """All commits, or one."""
        schema = entry.schema.add(_COMMIT, T.IntegerType())
        if entry.kind != BASE:
            schema = schema.add(FRAGMENT_ID, T.IntegerType())
        stored = self.spark.read.schema(schema).parquet(entry.path)
        wanted = F.col(_COMMIT) <= entry.last_commit if commit is None else F.col(_COMMIT) == commit
        return stored.where(wanted).drop(_COMMIT)

    def _stored(self, path: str, entry: Entry) -> DataFrame:
        return self.spark.read.schema(entry.schema).parquet(path)

    def _write_base(self, entry: Entry, rows: DataFrame) -> Entry:
        path = _commit_path(entry, 1)
        _conform(rows, entry).write.mode("overwrite").parquet(path)
        return entry.after(self._stored_rows(path, entry))

    def _write_split(
        self,
        entry: Entry,
        assigned: DataFrame,
        in_bytes: int,
        rows: Sequence[int] | None = None,
        start: int | None = None,
        stream: tuple[str, int] | None = None,
    ) -> Entry:
        path = _commit_path(entry, 1)
        write_split(assigned, path, entry.partition_count, in_bytes, rows, _lookup(entry))
        return entry.after(self._stored_rows(path, entry), start, stream)

    def _stored_rows(self, path: str, entry: Entry) -> int:
        """Rows of a finished commit, from the file footers.

        Counting what was written stays exact when tasks were re-run; metrics
        gathered on the way would not.
        """
        return self._stored(path, entry).count()


def _commit_path(entry: Entry, ahead: int = 0) -> str:
    return f"{entry.path}/{_COMMIT}={entry.last_commit + ahead}"


def _marked(schema: T.StructType, lookup_by: Sequence[str]) -> T.StructType:
    """The schema with the mark of lookup columns, by which appends know them too."""
    if missing := set(lookup_by) - set(schema.names):
        raise ValueError(f"no columns {sorted(missing)} to look up by")
    order = {name: i for i, name in enumerate(lookup_by)}
    return T.StructType(
        [
            T.StructField(f.name, f.dataType, f.nullable, {**f.metadata, _LOOKUP: order[f.name]} if f.name in order else f.metadata)
            for f in schema
        ]
    )


def _lookup(entry: Entry) -> list[str]:
    marked = [f for f in entry.schema if _LOOKUP in f.metadata]
    return [f.name for f in sorted(marked, key=lambda f: f.metadata[_LOOKUP])]


def _even(rows: int, n: int, start: int = 0) -> list[int]:
    """Rows per fragment when so many are dealt out to n in turn, from position `start` on."""
    return [rows // n + ((i - start) % n < rows % n) for i in range(n)]


def _column(rows: DataFrame, name: str) -> Column:
    return rows["`" + name.replace("`", "``") + "`"]


def _conform(rows: DataFrame, entry: Entry) -> DataFrame:
    """The rows in the column order and types of the stored table."""
    return rows.select(*[_column(rows, f.name).cast(f.dataType).alias(f.name) for f in entry.schema])


def _is_committed(entry: Entry, stream: tuple[str, int] | None) -> bool:
    """Whether a replayed micro-batch is in place already."""
    return stream is not None and entry.streams.get(stream[0], -1) >= stream[1]
