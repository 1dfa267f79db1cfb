"""S5: number result rows from 1 in a stated order.

Two forms (:func:`number` takes the one that a checked bound allows):

* :func:`number_small` - ``row_number()`` over a global window. The window puts
  every row in one task, so it is only for results whose size is bounded by a
  checked dimension (U1: at most one row per territory).
* :func:`number_rows` - distributed, for results whose size is not bounded
  (U4, which grows with the data; U2, whose tied winners have no bound):

  1. ``orderBy`` range-partitions and sorts; right after the sort each row gets
     its partition index and ``monotonically_increasing_id()`` (partition index
     in the upper bits, position within the partition in the lower 33);
  2. the tagged rows are checkpointed to the session's checkpoint folder, so
     both passes read the same rows in the same order, the lineage is cut, and
     a lost executor recomputes nothing upstream;
  3. a count per partition (one row per partition) gives each partition's
     offset by a running sum over that tiny table;
  4. the offsets (bounded by the partition count) are broadcast back and
     ``n = offset + position + 1``.

  No row moves to a single task; only per-partition counts are combined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

_PID = "_pid"
_MID = "_mid"
_OFF = "_off"
_LOW_BITS = 33  # monotonically_increasing_id keeps the in-partition position here


def _cols(order_by: list[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order_by]


def number_small(df: DataFrame, order_by: list[str | Column], name: str = "n") -> DataFrame:
    """``row_number()`` over the whole (small, bounded) result."""
    window = Window.orderBy(*_cols(order_by))
    return df.withColumn(name, F.row_number().over(window).cast("bigint"))


def number_rows(
    df: DataFrame,
    order_by: list[str | Column],
    name: str = "n",
    num_partitions: int | None = None,
    scratch: Scratch | None = None,
) -> DataFrame:
    """Distributed ``row_number()`` over ``order_by`` (which should be a total order).

    Runs one job eagerly (the checkpoint of the sorted, tagged rows) and
    returns a lazy DataFrame with the column ``name`` added. The checkpoint is removed
    with ``scratch`` (without one, when the application ends).
    """
    scratch = scratch or Scratch(df.sparkSession)
    cols = _cols(order_by)
    if num_partitions:
        ordered = df.repartitionByRange(num_partitions, *cols).sortWithinPartitions(*cols)
    else:
        ordered = df.orderBy(*cols)
    tagged = scratch.checkpointed(
        ordered.select("*", F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID))
    )

    counts = tagged.groupBy(_PID).agg(F.count(F.lit(1)).alias("_cnt"))
    # One row per partition: a global window here is bounded by the partition count.
    before = Window.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        _PID, F.coalesce(F.sum("_cnt").over(before), F.lit(0)).cast("bigint").alias(_OFF)
    )
    position = F.col(_MID) - F.shiftleft(F.col(_PID).cast("bigint"), _LOW_BITS)
    return (
        tagged.join(F.broadcast(offsets), _PID)
        .withColumn(name, (F.col(_OFF) + position + F.lit(1)).cast("bigint"))
        .drop(_PID, _MID, _OFF)
    )


def number(
    df: DataFrame, order_by: list[str | Column], bounded: bool, name: str = "n", scratch: Scratch | None = None
) -> DataFrame:
    """:func:`number_small` where a check has proven the result ``bounded``, else
    :func:`number_rows`."""
    return number_small(df, order_by, name) if bounded else number_rows(df, order_by, name, scratch=scratch)
