"""S3: call an operation by name with bound, typed parameters, from SQL.

The original client calls server-side procedures (``{call name(?)}`` with
``setInt``/``setString``). Here the read operations are SQL table functions
(``CREATE TEMPORARY FUNCTION ... RETURNS TABLE``), so a SQL user runs

    SELECT * FROM sales_by_territory(7)
    SELECT * FROM top_requested_product('AMERICA')
    SELECT * FROM top_requested_product('AMERICA', 'units', 'territory')
    SELECT * FROM cross_territory('order')
    SELECT * FROM cross_territory_customers()

and Catalyst plans the body like any other query (pushdown, pruning, AQE).
The bodies have the shape of the DataFrame operators: U1 aggregates along
its join chain, U2 keeps its ties without a window, U4 reduces lines to one
row per order before the order-key shuffle; the nation and region
dimensions are broadcast only behind the same size check. Parameters are bound as typed arguments,
never spliced into SQL text. The bodies read the temporary views registered by
:meth:`Tables.register_views`; temporary functions are used because a
permanent function may not refer to temporary views.
"""

from __future__ import annotations

import itertools
import re

from pyspark.sql import DataFrame, SparkSession

from ..sources import fixture
from ..sources.tables import Tables

_AMOUNT = "CAST(l.l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2)))"

def _cross_territory_body(words: int | None, grain: str) -> str:
    """U4: lines reduced to one row per order with the set of its supplier nations (as
    bits where the territory keys allow it, see ``fixture.territory_words``), joined to the
    order's own nation, or-ed per (id, own nation) and spread out. ``grain``: an
    expression; as a literal of a call it folds away."""
    origin = "SELECT o.o_orderkey AS order_id, o.o_custkey AS customer_id, c.c_nationkey AS ot FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey"
    # For the order grain the id is the join's key, so its partitioning serves the grouping.
    own = f"""CASE {grain} WHEN 'customer' THEN origin.customer_id WHEN 'order' THEN ship.order_id
                   ELSE raise_error('grain must be customer or order') END AS id, origin.ot"""
    lines = "FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey GROUP BY l.l_orderkey"
    if words is None:
        keys = f"""
            SELECT DISTINCT {own}, e.st
            FROM (SELECT l.l_orderkey AS order_id, collect_set(s.s_nationkey) AS sts {lines}) ship
            JOIN origin ON ship.order_id = origin.order_id
            LATERAL VIEW explode(array_remove(ship.sts, origin.ot)) e AS st
        """
    else:
        names = [f"w{w}" for w in range(words)]
        sets = ", ".join(
            f"coalesce(bit_or(CASE WHEN s.s_nationkey div 64 = {w} THEN shiftleft(1L, CAST(s.s_nationkey AS INT) & 63) END), 0L) AS w{w}" for w in range(words)
        )
        others = fixture.BITS_SQL.format(last=64 * words - 1, words=", ".join(names), without="ot")
        keys = f"""
            SELECT m.id, m.ot, e.st
            FROM (
                SELECT j.id, j.ot, {", ".join(f"bit_or(j.{w}) AS {w}" for w in names)}
                FROM (
                    SELECT {own}, {", ".join(f"ship.{w}" for w in names)}
                    FROM (SELECT l.l_orderkey AS order_id, {sets} {lines}) ship
                    JOIN origin ON ship.order_id = origin.order_id
                ) j
                GROUP BY j.id, j.ot
            ) m
            LATERAL VIEW explode({others}) e AS st
        """
    return f"""
        WITH origin AS ({origin}), k AS ({keys})
        SELECT /*+ DIMS(no, ns) */ k.id, no.n_name, ns.n_name
        FROM k
        JOIN nation no ON k.ot = no.n_nationkey
        JOIN nation ns ON k.st = ns.n_nationkey
    """


def _cross_territory_functions(words: int | None) -> dict[str, str]:
    out = "RETURNS TABLE (id BIGINT, order_territory STRING, ship_territory STRING) RETURN"
    new = "CREATE OR REPLACE TEMPORARY FUNCTION"
    return {
        "cross_territory": f"{new} cross_territory(grain STRING DEFAULT 'customer') {out} {_cross_territory_body(words, 'cross_territory.grain')}",
        "cross_territory_customers": f"{new} cross_territory_customers() {out} {_cross_territory_body(words, repr('customer'))}",
    }


FUNCTIONS = {
    # U1, aggregating along the join chain as the DataFrame operator does:
    # the category's lines summed per order, then per customer, then per
    # nation, each join meeting an aggregate on the key it is partitioned by.
    "sales_by_territory": f"""
        CREATE OR REPLACE TEMPORARY FUNCTION sales_by_territory(category BIGINT)
        RETURNS TABLE (total_sales DOUBLE, territory STRING, territory_id INT)
        RETURN
        WITH per_order AS (
            SELECT l.l_orderkey, SUM({_AMOUNT}) AS amount
            FROM lineitem l
            LEFT SEMI JOIN part p
              ON l.l_partkey = p.p_partkey
             AND {fixture.CATEGORY_SQL} = sales_by_territory.category
            GROUP BY l.l_orderkey
        ), per_customer AS (
            SELECT o.o_custkey, SUM(po.amount) AS amount
            FROM per_order po JOIN orders o ON po.l_orderkey = o.o_orderkey
            GROUP BY o.o_custkey
        ), per_nation AS (
            SELECT c.c_nationkey, SUM(pc.amount) AS amount
            FROM per_customer pc JOIN customer c ON pc.o_custkey = c.c_custkey
            GROUP BY c.c_nationkey
        )
        SELECT /*+ DIMS(n) */ CAST(pn.amount AS DOUBLE), n.n_name, n.n_nationkey
        FROM per_nation pn JOIN nation n ON pn.c_nationkey = n.n_nationkey
    """,
    # U2 without a window: a window over the region would gather all its
    # candidate products in one task. The best count per group is a small
    # aggregate matched by equality; every tie is kept. measure and per are
    # literals in a call, so the branches not asked for fold away.
    "top_requested_product": f"""
        CREATE OR REPLACE TEMPORARY FUNCTION top_requested_product(
            region_name STRING, measure STRING DEFAULT 'lines', per STRING DEFAULT 'region')
        RETURNS TABLE (product STRING, requests BIGINT, region STRING, product_id BIGINT)
        RETURN
        WITH region_nations AS (
            SELECT /*+ DIMS(r) */ n.n_nationkey,
                   CASE top_requested_product.per WHEN 'region' THEN r.r_name WHEN 'territory' THEN n.n_name
                        ELSE raise_error('per must be region or territory') END AS grp
            FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
            WHERE r.r_name = top_requested_product.region_name
        ), region_orders AS (
            SELECT o.o_orderkey, rc.grp
            FROM orders o
            JOIN (
                SELECT /*+ DIMS(rn) */ c.c_custkey, rn.grp
                FROM customer c JOIN region_nations rn ON c.c_nationkey = rn.n_nationkey
            ) rc ON o.o_custkey = rc.c_custkey
        ), counts AS (
            SELECT ro.grp, l.l_partkey AS pid,
                   CASE top_requested_product.measure
                       WHEN 'lines' THEN CAST(COUNT(*) AS DECIMAL(38,6))
                       WHEN 'units' THEN CAST(SUM(CAST(l.l_quantity AS {fixture.QUANTITY_TYPE})) AS DECIMAL(38,6))
                       WHEN 'orders' THEN CAST(COUNT(DISTINCT l.l_orderkey) AS DECIMAL(38,6))
                       ELSE raise_error('measure must be lines, units or orders') END AS requests
            FROM lineitem l JOIN region_orders ro ON l.l_orderkey = ro.o_orderkey
            GROUP BY ro.grp, l.l_partkey
        ), best AS (
            SELECT grp, MAX(requests) AS best FROM counts GROUP BY grp
        )
        SELECT /*+ DIMS(b) */ p.p_name, CAST(w.requests AS BIGINT), w.grp, w.pid
        FROM counts w
        LEFT SEMI JOIN best b ON w.grp = b.grp AND w.requests = b.best
        LEFT JOIN part p ON p.p_partkey = w.pid
    """,
} | _cross_territory_functions(1)


VIEWS = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


# ``/*+ DIMS(aliases) */`` marks a join input that is the nation or region
# dimension (or a subset of it). It becomes a BROADCAST hint only when those
# dimensions passed their size check; otherwise it is removed and the planner
# decides from statistics.
_DIM_HINT = re.compile(r"/\*\+ DIMS\(([^)]*)\) \*/")


def with_dimension_hints(ddl: str, dimensions_small: bool) -> str:
    """``ddl`` with each DIMS marker turned into a BROADCAST hint, or removed."""
    return _DIM_HINT.sub(
        lambda m: f"/*+ BROADCAST({m.group(1)}) */" if dimensions_small else "", ddl
    )


_VIEW = re.compile(r"\b(FROM|JOIN) (" + "|".join(VIEWS) + r")\b")
_NUMBERS = itertools.count()


def register(t: Tables, prefix: str = "") -> None:
    """Register the views the bodies read, then the three table functions.

    The views get names of this catalog alone, so a user's own view ``orders`` and
    the functions of other catalogs stay as they are. ``prefix`` goes before the
    functions' names, to keep those of several catalogs apart.

    The dimension size check runs once per catalog (it is shared with the
    DataFrame operators) and decides whether the bodies carry broadcast hints.
    """
    own = t.derived("view_prefix", lambda: f"stockyard_{next(_NUMBERS)}_")
    t.register_views(VIEWS, own)
    fixture.territory_dim(t)  # runs (or reuses) the bounded checks of nation and region
    small = t.bounded_cache.get("territory", False) and t.bounded_cache.get("region", False)
    for name, ddl in (FUNCTIONS | _cross_territory_functions(fixture.territory_words(t))).items():
        ddl = _VIEW.sub(rf"\1 {own}\2", with_dimension_hints(ddl, small))
        t.spark.sql(re.sub(rf"\b{name}\b", prefix + name, ddl))


def call(spark: SparkSession, name: str, *args, prefix: str = "") -> DataFrame:
    """``SELECT * FROM name(:a0, :a1, ...)`` with typed, bound parameters."""
    if name not in FUNCTIONS:
        raise KeyError(f"unknown table function {name!r}")
    params = {f"a{i}": v for i, v in enumerate(args)}
    placeholders = ", ".join(f":a{i}" for i in range(len(args)))
    return spark.sql(f"SELECT * FROM {prefix}{name}({placeholders})", args=params)
