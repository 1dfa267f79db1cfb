"""Keyed updates arriving as a stream, applied in micro-batches.

The original operations update one row each time a user types a change. The
streaming form of that is a change feed: change rows land in a folder (or any
Structured Streaming source), and each micro-batch is applied to the
versioned table by kernel K through ``foreachBatch``:

* within a batch, the latest ``seq`` per key wins (K's collapse);
* across batches, with ``seq_column`` (a column of the stored table, see
  :func:`with_seq_column`) a change applies only if it is newer than the seq
  already applied to the row, so a late file with old changes cannot undo a
  newer one; without it, later batches apply over earlier ones;
* every batch is committed with the entry ID ``<name>:<batch_id>``; a batch
  replayed after a failure (Structured Streaming re-runs the last uncommitted
  batch with the same ID) finds its entry applied and is skipped, so the
  table changes exactly once per batch;
* the rejects of each batch are written to ``rejects_path`` (if given) with
  their batch ID.

The stream's checkpoint location must be a shared folder on a cluster.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.changeset import ChangeSetResult
from ..plans.snapshots import SnapshotStore
from ..plans.versioned import commit_changes


def change_batch_writer(
    store: SnapshotStore,
    keys: list[str],
    column: str,
    op: str,
    name: str,
    rejects_path: str | None = None,
    prepare: Callable[[DataFrame, DataFrame], ChangeSetResult] | None = None,
    seq_column: str | None = None,
) -> Callable[[DataFrame, int], None]:
    """The ``foreachBatch`` function applying one micro-batch of changes."""

    def apply_batch(batch: DataFrame, batch_id: int) -> None:
        entry_id = f"{name}:{batch_id}"

        def write_rejects(result: ChangeSetResult) -> None:
            # Before the commit, into the batch's own folder: a replay overwrites it.
            result.rejects.write.mode("overwrite").parquet(f"{rejects_path}/feed={name}/batch_id={batch_id}")

        commit_changes(
            store, batch, keys, column, op, entry_id, prepare, seq_column=seq_column,
            before_commit=write_rejects if rejects_path is not None else None,
        )

    return apply_batch


def start_change_feed(
    spark: SparkSession,
    source_path: str,
    schema: T.StructType,
    store: SnapshotStore,
    keys: list[str],
    column: str,
    checkpoint_location: str,
    name: str = "change_feed",
    op: str = "apply_changes",
    rejects_path: str | None = None,
    max_files_per_trigger: int | None = None,
    available_now: bool = False,
    prepare: Callable[[DataFrame, DataFrame], ChangeSetResult] | None = None,
    seq_column: str | None = None,
) -> StreamingQuery:
    """Start applying parquet change files under ``source_path`` to ``store``."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(source_path)
    writer = (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", checkpoint_location)
        .foreachBatch(
            change_batch_writer(
                store, keys, column, op, name, rejects_path, prepare, seq_column
            )
        )
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def with_seq_column(table: DataFrame, seq_type: T.DataType | str, name: str = "_seq") -> DataFrame:
    """``table`` plus an empty applied-seq column, for a store fed with ``seq_column``."""
    return table.withColumn(name, F.lit(None).cast(seq_type))
