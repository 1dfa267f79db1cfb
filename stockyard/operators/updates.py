"""U5-U7: keyed updates, each a whole table of changes applied by kernel K.

The original operations update one row per call. Here each takes a table of
changes (by default derived from ``events``) and applies all of it in one
distributed job; the single-row case is a one-row change table.

* U5 ``set_order_quantity``: key (order, product) of ``lineitem``, column
  ``l_quantity``. No range check unless ``min_quantity`` is given.
* U6 ``set_ship_method``: key order; the method ID is checked against the
  ship-method dimension first (unknown -> ``no_such_method``), then applied,
  and the order's ``o_orderpriority`` becomes that method's name, which is looked up
  for the collapsed changes only.
* U7 ``set_email``: key person, column ``email``; latest (ts, event_id) wins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast
from ..sources import fixture
from ..sources.tables import Tables
from .changeset import ChangeSetResult, apply_changes

# Reasons found before the kernel runs.
NO_SUCH_METHOD = "no_such_method"
BELOW_MIN_QUANTITY = "below_min_quantity"

ORDER_LINE_KEYS = ["l_orderkey", "l_partkey"]
ORDER_KEYS = ["o_orderkey"]
PERSON_KEYS = ["person_id"]


def set_order_quantity(
    t: Tables,
    changes: DataFrame | None = None,
    min_quantity: float | None = None,
    seq_column: str | None = None,
) -> ChangeSetResult:
    """U5 over ``lineitem``; changes: l_orderkey, l_partkey, new_value, seq.

    ``seq_column``: applied-seq column of ``lineitem`` (see ``apply_changes``)."""
    changes = fixture.quantity_changes(t) if changes is None else changes
    if min_quantity is not None:
        low = F.col("new_value") < F.lit(min_quantity)
        changes = changes.withColumn("reason", F.when(low, F.lit(BELOW_MIN_QUANTITY)))
    return apply_changes(
        t["lineitem"], changes, ORDER_LINE_KEYS, "l_quantity", op="set_order_quantity", seq_column=seq_column
    )


def set_ship_method(
    t: Tables,
    changes: DataFrame | None = None,
    seq_column: str | None = None,
    methods: DataFrame | None = None,
) -> ChangeSetResult:
    """U6 over ``orders``; changes: o_orderkey, new_value (method ID), seq.

    ``methods``: the method dimension (ship_method_id, name); a method that no order uses
    yet is then accepted too. By default the methods found in ``orders``.
    ``seq_column``: applied-seq column of ``orders`` (see ``apply_changes``)."""
    changes = fixture.ship_method_changes(t) if changes is None else changes
    # The method list is a dimension of a handful of rows: checked, then broadcast.
    methods = fixture.ship_method_dim(t) if methods is None else bounded_broadcast(methods)
    known_ids = methods.select(F.col("ship_method_id").alias("_known_id"), F.lit(True).alias("_known"))
    checked = changes.join(known_ids, changes.new_value == known_ids._known_id, "left")
    unknown = F.col("new_value").isNotNull() & F.col("_known").isNull()
    checked = checked.select(
        *ORDER_KEYS, "new_value", "seq", F.when(unknown, F.lit(NO_SUCH_METHOD)).alias("reason")
    )

    names = methods.select(F.col("ship_method_id").alias("_method"), F.col("name").alias("_name"))

    def resolve(winners: DataFrame) -> DataFrame:
        named = winners.join(names, winners._new == names._method, "left")
        return named.withColumn("_new", F.col("_name")).drop("_method", "_name")

    return apply_changes(
        t["orders"], checked, ORDER_KEYS, "o_orderpriority", op="set_ship_method",
        seq_column=seq_column, resolve=resolve,
    )


def set_email(t: Tables, changes: DataFrame | None = None) -> ChangeSetResult:
    """U7 over the person-email table; changes: person_id, new_value, seq."""
    changes = fixture.email_changes(t) if changes is None else changes
    return apply_changes(fixture.person_email(t), changes, PERSON_KEYS, "email", op="set_email")
