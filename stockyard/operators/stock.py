"""U3: change the stock of one category at one location by a percentage.

A predicate update over the inventory table (product_id, location_id,
quantity): rows whose product is in ``category`` and whose location is
``location`` get ``quantity + round(quantity * pct / 100)``; all other rows are
kept. The output is the full new snapshot.

* ``pct`` defaults to +5 (the operation's label gives an unsigned 5 %);
  negative values decrease.
* ``rounding``: ``floor`` (default; with +5 % stock under 20 does not move),
  ``ceil`` or ``half_up``. The arithmetic is exact decimal, so the result does
  not depend on floating point.
* The update is not idempotent; :func:`stockyard.plans.versioned.adjust_stock_once`
  names its version after an adjustment ID and skips a repeated one.

Plan: one pass. Inventory is left-joined to the category's part keys (a
marker column); the planner broadcasts those keys while their statistics are
small and sort-merges beyond. No row leaves its group and nothing is
collected.
"""

from __future__ import annotations

from dataclasses import dataclass

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import fixture
from ..sources.tables import Tables
from .changeset import HIT, OUTCOME_COLUMNS

ROUNDING = ("floor", "ceil", "half_up")


def exact_percentage(pct: int | float | str | Decimal) -> Decimal:
    """``pct`` as a decimal of at most 8 digits before and 4 after the point; refused if
    it doesn't fit (a float counts as the number it prints)."""
    value = Decimal(str(pct))
    if not value.is_finite() or value != value.quantize(Decimal("0.0001")) or abs(value) >= 10**8:
        raise ValueError(f"percentage {pct!r} has more than 8 digits before or 4 after the point")
    return value


def adjusted_quantity(quantity: Column, pct: int | float | str | Decimal, rounding: str = "floor") -> Column:
    """quantity + rounding(quantity * pct / 100), exact, as bigint."""
    if rounding not in ROUNDING:
        raise ValueError(f"rounding must be one of {ROUNDING}, got {rounding!r}")
    delta = quantity.cast("decimal(20,0)") * F.lit(str(exact_percentage(pct))).cast("decimal(12,4)") / F.lit(100)
    if rounding == "floor":
        rounded = F.floor(delta)
    elif rounding == "ceil":
        rounded = F.ceil(delta)
    else:
        rounded = F.round(delta, 0)  # HALF_UP on decimals
    return (quantity + rounded.cast("bigint")).cast("bigint")


@dataclass
class StockAdjustment:
    op: str
    table: DataFrame  # product_id, location_id, quantity, _hit
    matched: DataFrame  # the rows the adjustment changes (the _hit rows of table)

    @property
    def updated(self) -> DataFrame:
        return self.table.drop(HIT)

    @property
    def outcome(self) -> DataFrame:
        """One row: op, changes=1, applied (1 if any row matched), superseded=0, rejected
        (1 if none did), rows_matched.

        Counted over :attr:`matched`, whose location filter reaches the scan
        below the inventory (the supplier nation), so only that location's
        rows are built, instead of flagging every row of the new table."""
        return self.matched.agg(
            F.lit(self.op).alias("op"),
            F.lit(1).cast("bigint").alias("changes"),
            (F.count(F.lit(1)) > 0).cast("bigint").alias("applied"),
            F.lit(0).cast("bigint").alias("superseded"),
            (F.count(F.lit(1)) == 0).cast("bigint").alias("rejected"),
            F.count(F.lit(1)).cast("bigint").alias("rows_matched"),
        )


def outcome_row(spark: SparkSession, op: str, rows_matched: int) -> DataFrame:
    """The outcome of one adjustment from the rows that its write has counted."""
    applied = int(rows_matched > 0)
    kinds = "op string, " + ", ".join(f"{c} bigint" for c in OUTCOME_COLUMNS[1:])
    return spark.createDataFrame([(op, 1, applied, 0, 1 - applied, rows_matched)], kinds)


def adjust_stock(
    t: Tables,
    category: int,
    location: int,
    pct: int | float | str | Decimal = 5,
    rounding: str = "floor",
    inventory: DataFrame | None = None,
) -> StockAdjustment:
    """U3. New snapshot of ``inventory`` (default: derived from the fixture)."""
    inv = fixture.inventory(t) if inventory is None else inventory
    in_category = (
        fixture.product(t)
        .filter(F.col("category_id") == F.lit(category))
        .select(F.col("product_id").alias("_pid"), F.lit(True).alias("_in_cat"))
        .distinct()  # a product listed twice must not double its stock rows
    )
    joined = inv.join(in_category, inv.product_id == in_category._pid, "left")
    hit = F.coalesce(F.col("_in_cat"), F.lit(False)) & (F.col("location_id") == F.lit(location))
    hit = F.coalesce(hit, F.lit(False))
    table = joined.select(
        *[
            (
                F.when(hit, adjusted_quantity(F.col(c), pct, rounding))
                .otherwise(F.col(c))
                .alias(c)
                if c == "quantity"
                else F.col(c)
            )
            for c in inv.columns
        ],
        hit.alias(HIT),
    )
    matched = inv.filter(F.col("location_id") == F.lit(location)).join(
        in_category, inv.product_id == in_category._pid, "left_semi"
    )
    return StockAdjustment(op="adjust_stock", table=table, matched=matched)
