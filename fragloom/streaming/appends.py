"""Streaming appends to splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from fragloom.functions.ranges import FRAGMENT_ID, RangeSpec, assign_range
from fragloom.plans.catalog import RANGE, ROUND_ROBIN
from fragloom.plans.store import FragmentStore

_QUERY_ID = "sql.streaming.queryId"


def range_file_stream(rows: DataFrame, spec: RangeSpec, path: str, checkpoint: str) -> DataStreamWriter:
    """Route a stream to range fragments through the file sink.

    Stateless: no shuffle, no state store, and the sink's log makes it exactly
    once. Read the folder back as one table partitioned by ``fragment_id``.
    """
    return (
        assign_range(rows, spec)
        .writeStream.format("parquet")
        .partitionBy(FRAGMENT_ID)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def store_stream(
    rows: DataFrame,
    store: FragmentStore,
    table: str,
    kind: str,
    checkpoint: str,
    order_by: str | Sequence[str] | None = None,
    name: str | None = None,
) -> DataStreamWriter:
    """Append every micro-batch of a stream to a split in the store.

    A batch is committed under `name` or else the streaming query's id, which
    lives in the checkpoint, and its batch id. A name must stay with one checkpoint. A replayed batch that is in the catalog is
    skipped; one that failed before it got there starts from the same cursor
    and overwrites its own folder.
    """
    if kind not in (RANGE, ROUND_ROBIN):
        raise ValueError(f"kind must be {RANGE} or {ROUND_ROBIN}, got {kind!r}")

    def append(batch: DataFrame, batch_id: int) -> None:
        query = name or batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
        if not query:
            raise ValueError("this session does not tell the query's id; give the stream a name")
        target = FragmentStore(batch.sparkSession, store.root)
        if kind == RANGE:
            target.append_range(table, batch, stream=(query, batch_id))
        else:
            target.append_round_robin(table, batch, order_by, stream=(query, batch_id))

    return rows.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).outputMode("append")
