"""U1: total sales of the products of one category, per territory.

Output ``total_sales double, territory string, territory_id int``, one row per
territory that sold the category (inner joins: a territory without such sales
does not appear).

Plan, chosen for scale (eager aggregation along the join chain):

1. lines of the category: ``lineitem`` semi-joined to the category's part keys
   (1/25 of ``part``; broadcast by the planner while small, sort-merge beyond);
2. sum per order -> join ``orders`` on the same key (the aggregate's hash
   partitioning on the order key is reused by the join: no extra exchange);
3. sum per customer -> join ``customer`` on the same key;
4. sum per nation -> attach names from the 25-row territory dimension.

Every join is preceded by a partial (map-side) aggregation, so the rows that
cross each shuffle are at most one per key, and a key holding a third of all
rows (one hot order, one hot customer) collapses in its map task instead of
landing in a single reducer. Sums are exact decimals; only the final value is
turned into a double.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources import fixture
from ..sources.tables import Tables


def category_sales_by_nation(t: Tables, category: int) -> DataFrame:
    """territory_id int, amount decimal: exact sales of the category per nation."""
    parts = fixture.product(t).filter(F.col("category_id") == F.lit(category)).select(
        "product_id"
    )
    lines = t["lineitem"].select(
        "l_orderkey", "l_partkey", fixture.line_amount().alias("amount")
    )
    per_order = (
        lines.join(parts, lines.l_partkey == parts.product_id, "left_semi")
        .groupBy("l_orderkey")
        .agg(F.sum("amount").alias("amount"))
    )
    orders = t["orders"].select("o_orderkey", "o_custkey")
    per_customer = (
        per_order.join(orders, per_order.l_orderkey == orders.o_orderkey)
        .groupBy("o_custkey")
        .agg(F.sum("amount").alias("amount"))
    )
    customer = t["customer"].select("c_custkey", "c_nationkey")
    return (
        per_customer.join(customer, per_customer.o_custkey == customer.c_custkey)
        .groupBy(F.col("c_nationkey").alias("territory_id"))
        .agg(F.sum("amount").alias("amount"))
    )


def sales_by_territory_exact(t: Tables, category: int) -> DataFrame:
    """total_sales (exact decimal), territory, territory_id."""
    per_nation = category_sales_by_nation(t, category)
    terr = fixture.territory_dim(t).select("territory_id", "territory")
    return per_nation.join(terr, "territory_id").select(
        F.col("amount").alias("total_sales"), "territory", "territory_id"
    )


def sales_by_territory(t: Tables, category: int) -> DataFrame:
    """U1. total_sales double, territory string, territory_id int."""
    return sales_by_territory_exact(t, category).select(
        F.col("total_sales").cast("double").alias("total_sales"),
        "territory",
        "territory_id",
    )
