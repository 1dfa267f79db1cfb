"""U2: the most requested product of a region (or of each of its territories).

Output ``product string, requests bigint, region string, product_id bigint``.

* ``measure``: ``lines`` (order lines, the default: "requests" counts
  requests, not units), ``units`` (sum of quantities) or ``orders`` (distinct
  orders).
* ``per``: ``region`` gives the winners of the region; ``territory`` gives the
  winners of each nation of the region, with the nation in column ``region``.
* Ties are all kept (the semantics of ``rank() = 1``, never ``limit 1``).
  Products are grouped by key: product names are not unique.

Plan: the region's nations (a bounded dimension, broadcast) pick its
customers without a shuffle of ``customer``; their orders and lines follow by
equi-joins the planner sizes (AQE splits a skewed order key). The count per
(group, product) is a partial + final aggregation; the best count per group
is a second, tiny aggregation over it (Spark reuses the first one's
exchange), broadcast back as a semi-join filter, so no step gathers a group in
one task however many products tie. Product names are attached to the
winners last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import fixture
from ..sources.tables import Tables

MEASURES = ("lines", "units", "orders")
GRAINS = ("region", "territory")


def requests_per_product(
    t: Tables, region: str = fixture.NORTH_AMERICA, measure: str = "lines", per: str = "region"
) -> DataFrame:
    """grp string, product_id bigint, requests bigint for every product sold in the region."""
    if measure not in MEASURES:
        raise ValueError(f"measure must be one of {MEASURES}, got {measure!r}")
    if per not in GRAINS:
        raise ValueError(f"per must be one of {GRAINS}, got {per!r}")

    group_col = "region" if per == "region" else "territory"
    nations = (
        fixture.territory_dim(t)
        .filter(F.col("region") == F.lit(region))
        .select("territory_id", F.col(group_col).alias("grp"))
    )
    customer = t["customer"].select("c_custkey", "c_nationkey")
    orders = t["orders"].select("o_orderkey", "o_custkey")
    if per == "region":
        # The group is the region itself: plain semi-joins filter customers and
        # orders. (A semi-join's size estimate is its left side's, so the
        # planner keeps choosing the right build side for the lines join.)
        customers = customer.join(
            nations, customer.c_nationkey == nations.territory_id, "left_semi"
        )
        region_orders = orders.join(
            customers, orders.o_custkey == customers.c_custkey, "left_semi"
        ).select("o_orderkey", F.lit(region).alias("grp"))
    else:
        customers = customer.join(
            nations, customer.c_nationkey == nations.territory_id
        ).select("c_custkey", "grp")
        region_orders = orders.join(customers, orders.o_custkey == customers.c_custkey).select(
            "o_orderkey", "grp"
        )
    lines = t["lineitem"].select("l_orderkey", "l_partkey", "l_quantity")
    region_lines = lines.join(region_orders, lines.l_orderkey == region_orders.o_orderkey)

    if measure == "lines":
        value = F.count(F.lit(1))
    elif measure == "units":
        value = F.sum(F.col("l_quantity").cast(fixture.QUANTITY_TYPE))
    else:
        value = F.count_distinct("l_orderkey")
    return region_lines.groupBy("grp", F.col("l_partkey").alias("product_id")).agg(
        value.alias("requests")
    )


def top_requested_product(
    t: Tables, region: str = fixture.NORTH_AMERICA, measure: str = "lines", per: str = "region"
) -> DataFrame:
    """U2. product, requests, region, product_id; every tied winner is kept.

    Same result as ``rank() over (partition by grp order by requests desc) = 1``,
    computed without a window: the best count per group is a partial
    aggregation (one row per group), broadcast back and matched by equality.
    A window would send every candidate of the region to one task, and when
    many products tie even a partial ``WindowGroupLimit`` keeps them all.
    """
    counts = requests_per_product(t, region, measure, per)
    # One row per group; groups are territories or the region, so this table is
    # as small as the territory dimension. It is hinted only when that
    # dimension passed its size check; otherwise the planner decides.
    best = counts.groupBy("grp").agg(F.max("requests").alias("_best"))
    if t.bounded_cache.get("territory", False):
        best = F.broadcast(best)
    winners = counts.join(
        best,
        (counts.grp == best.grp) & (counts.requests == best._best),
        "left_semi",
    )
    names = fixture.product(t).select("product_id", "product")
    # Units are compared exactly and shown whole.
    return winners.join(names, "product_id", "left").select(
        "product", F.col("requests").cast("bigint").alias("requests"), F.col("grp").alias("region"), "product_id"
    )
