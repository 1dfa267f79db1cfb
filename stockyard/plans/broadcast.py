"""Broadcast only behind a size check, with the planner's choice beyond it.

Two kinds of join input exist in this engine:

* Dimensions whose size does not grow with the data: ``region`` (5 rows),
  ``nation`` (25), the ship-method list (5), the per-partition offsets of the
  distributed numbering (one row per partition).
  They are hinted with ``broadcast()`` *after* a bounded count proves they are
  small: ``limit(max_rows + 1).count()`` stops reading once the bound is
  passed, so for a stored table the check costs at most ``max_rows + 1`` rows. A derived
  dimension (the ship-method list, an aggregate of ``orders``) has to be derived for it first:
  one column scanned and aggregated in its map tasks. Giving the list (``methods``) spares that.
* Everything that grows with the data (``supplier``, ``part``, ``customer``,
  ``orders``, change sets). They are never hinted. The planner broadcasts them
  only when their estimated size is under ``spark.sql.autoBroadcastJoinThreshold``
  and AQE only when the measured shuffle output is; otherwise they are
  sort-merge (or shuffled-hash) joined, with AQE splitting skewed partitions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A dimension larger than this is not broadcast by hint.
DIMENSION_MAX_ROWS = 10_000


def row_count_at_most(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows; takes at most max_rows + 1 of them."""
    return df.limit(max_rows + 1).count() <= max_rows


def bounded_broadcast(
    df: DataFrame,
    max_rows: int = DIMENSION_MAX_ROWS,
    cache: dict[str, bool] | None = None,
    key: str | None = None,
) -> DataFrame:
    """``broadcast(df)`` if it has at most ``max_rows`` rows, else ``df`` unhinted.

    ``cache``/``key`` memoise the check for a table loaded once and joined often.
    """
    if cache is not None and key is not None and key in cache:
        small = cache[key]
    else:
        small = row_count_at_most(df, max_rows)
        if cache is not None and key is not None:
            cache[key] = small
    return F.broadcast(df) if small else df
