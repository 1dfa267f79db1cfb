"""U4: customers (or orders) shipped to a territory other than their own.

Output ``id bigint, order_territory string, ship_territory string``, distinct.

* order territory: the nation of the order's customer;
* ship territory: the nation of the supplier of each line (the fixture has
  no ship-to address, so every line is a shipment);
* ``grain``: ``customer`` (the default; the operation speaks of clients) or
  ``order``;
* territory *keys* are compared and names attached after the distinct; a null
  on either side never counts as different.

This is the one result that grows with the data, so it stays distributed to
the end. Lines are first reduced to one row per order with the set of its
supplier nations as bits (``bit_or``, a hash aggregate, partial in each map task: an order
with a third of all lines collapses to one row per task); that aggregate's
partitioning on the order key serves the join to the order's own territory
without another exchange. The sets are or-ed again per (id, own territory), which
makes the rows distinct before they are spread out: what crosses that shuffle is at most
one row per id and task, and for the order grain nothing does. The own
territory's bit is taken out, the others become rows, and names come from the
dimension by broadcast. Territory keys that don't fit 512 bits are
held as ``collect_set`` arrays instead and made distinct after they are spread.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import fixture
from ..sources.tables import Tables

GRAINS = ("customer", "order")


def cross_territory_keys(t: Tables, grain: str = "customer") -> DataFrame:
    """id, order_territory_id, ship_territory_id: distinct, the two keys differ."""
    if grain not in GRAINS:
        raise ValueError(f"grain must be one of {GRAINS}, got {grain!r}")
    ship = fixture.order_ship_territories(t)
    origin = fixture.order_territory(t)
    id_col = F.col("customer_id" if grain == "customer" else "order_id").alias("id")
    words = fixture.territory_words(t)
    if words is None:
        # array_remove drops the order's own territory; with a null origin it
        # returns null and explode yields nothing, so a null never counts as different.
        others = F.explode(F.array_remove("ship_territory_ids", F.col("territory_id"))).alias("ship_territory_id")
        return ship.join(origin, "order_id").select(id_col, F.col("territory_id").alias("order_territory_id"), others).distinct()
    bits = [f"w{w}" for w in range(words)]
    # The id goes by the join's key for the order grain, so its partitioning is kept.
    rows = ship.join(origin, "order_id").select(id_col, F.col("territory_id").alias("order_territory_id"), *bits)
    sets = rows.groupBy("id", "order_territory_id").agg(*[F.bit_or(w).alias(w) for w in bits])
    others = F.explode(fixture.keys_of_bits(words, without="order_territory_id")).alias("ship_territory_id")
    return sets.select("id", "order_territory_id", others)


def cross_territory(t: Tables, grain: str = "customer") -> DataFrame:
    """U4. id, order_territory, ship_territory (names), distinct."""
    keys = cross_territory_keys(t, grain)
    dim = fixture.territory_dim(t)
    origin = dim.select(
        F.col("territory_id").alias("order_territory_id"),
        F.col("territory").alias("order_territory"),
    )
    dest = dim.select(
        F.col("territory_id").alias("ship_territory_id"),
        F.col("territory").alias("ship_territory"),
    )
    return (
        keys.join(origin, "order_territory_id")
        .join(dest, "ship_territory_id")
        .select("id", "order_territory", "ship_territory")
    )
