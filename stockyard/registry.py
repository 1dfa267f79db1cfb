"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operation,
and for each the equivalent SQL that DuckDB runs on the same parquet tables.

Every query reads the whole given tables; parameters are the defaults of the
operations (category 7, location 8, region AMERICA, +5 %).
"""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from functools import reduce

from .functions import report, table_functions
from .operators import cross_territory, ranking, sales, stock, updates
from .plans.scratch import Scratch
from .session import checkpoint_dir
from .sources import fixture
from .sources.bucketed import store_bucketed
from .sources.tables import Tables

CATEGORY = 7
LOCATION = 8
PCT = 5
REGION = "AMERICA"
NO_CATEGORY = 999_999  # no part has it


def _tables(spark: SparkSession, sf_dir: str) -> Tables:
    """A fresh catalog per query: it sees files added since the last one, and its
    size checks hold for what it reads."""
    return Tables.from_parquet(spark, sf_dir)


def q_sales_by_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_by_territory(_tables(spark, sf_dir), CATEGORY)


def q_top_product_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_requested_product(_tables(spark, sf_dir), REGION, "lines", "region")


def q_top_product_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_requested_product(_tables(spark, sf_dir), REGION, "units", "region")


def q_top_product_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_requested_product(_tables(spark, sf_dir), REGION, "orders", "region")


def q_top_product_by_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_requested_product(_tables(spark, sf_dir), REGION, "units", "territory")


def q_cross_territory_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_territory.cross_territory(_tables(spark, sf_dir), "customer")


def q_cross_territory_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_territory.cross_territory(_tables(spark, sf_dir), "order")


def q_stock_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock.adjust_stock(_tables(spark, sf_dir), CATEGORY, LOCATION, PCT).updated


def q_stock_adjusted_half_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock.adjust_stock(_tables(spark, sf_dir), CATEGORY, LOCATION, PCT, "half_up").updated


def q_stock_decreased(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock.adjust_stock(_tables(spark, sf_dir), CATEGORY, LOCATION, -PCT, "floor").updated


def q_order_quantity_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.set_order_quantity(_tables(spark, sf_dir)).updated


def q_ship_method_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.set_ship_method(_tables(spark, sf_dir)).updated


def q_ship_method_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.set_ship_method(_tables(spark, sf_dir)).rejects


def q_email_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return updates.set_email(_tables(spark, sf_dir)).updated


def _together(spark: SparkSession, *outcomes: Callable[[], DataFrame]) -> DataFrame:
    """The rows of several updates' outcomes. Their changes are collapsed by jobs that
    don't depend on each other, so these run side by side."""
    checkpoint_dir(spark)  # settled before several ask for it
    with ThreadPoolExecutor(len(outcomes)) as pool:
        return reduce(DataFrame.unionByName, pool.map(lambda outcome: outcome(), outcomes))


def q_update_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return _together(
        spark,
        lambda: stock.adjust_stock(t, CATEGORY, LOCATION, PCT).outcome,
        lambda: updates.set_order_quantity(t).outcome,
        lambda: updates.set_ship_method(t).outcome,
        lambda: updates.set_email(t).outcome,
    )


def q_stock_adjusted_ceil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stock.adjust_stock(_tables(spark, sf_dir), CATEGORY, LOCATION, PCT, "ceil").updated


def _nulls_as_text(rejects: DataFrame) -> DataFrame:
    """Keys and values as text, with ``null`` for nulls; seq and reason as they are."""
    return rejects.select(*[c if c in ("seq", "reason") else report.as_text(F.col(c)).alias(c) for c in rejects.columns])


def q_order_quantity_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return _nulls_as_text(updates.set_order_quantity(t, fixture.mixed_quantity_changes(t)).rejects)


def q_email_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return _nulls_as_text(updates.set_email(t, fixture.mixed_email_changes(t)).rejects)


def q_email_mixed_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return updates.set_email(t, fixture.mixed_email_changes(t)).updated


def q_mixed_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _tables(spark, sf_dir)
    return _together(
        spark,
        lambda: stock.adjust_stock(t, NO_CATEGORY, LOCATION, PCT).outcome,
        lambda: updates.set_order_quantity(t, fixture.mixed_quantity_changes(t)).outcome,
        lambda: updates.set_email(t, fixture.mixed_email_changes(t)).outcome,
    )


def q_cross_territory_order_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cross_territory_report(_tables(spark, sf_dir), "order")


def q_sales_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.sales_report(_tables(spark, sf_dir), CATEGORY)


def q_top_product_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_product_report(_tables(spark, sf_dir), region=REGION, measure="lines")


def q_cross_territory_report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.cross_territory_report(_tables(spark, sf_dir), "customer")


def _with_functions(spark: SparkSession, sf_dir: str) -> None:
    table_functions.register(_tables(spark, sf_dir))


def q_sales_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_functions(spark, sf_dir)
    return table_functions.call(spark, "sales_by_territory", CATEGORY)


def q_top_product_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_functions(spark, sf_dir)
    return table_functions.call(spark, "top_requested_product", REGION)


def q_cross_territory_table_function(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_functions(spark, sf_dir)
    return table_functions.call(spark, "cross_territory_customers")


def q_top_product_function_by_territory(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_functions(spark, sf_dir)
    return table_functions.call(spark, "top_requested_product", REGION, "units", "territory")


def q_top_product_function_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_functions(spark, sf_dir)
    return table_functions.call(spark, "top_requested_product", REGION, "orders")


def q_cross_territory_function_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    _with_functions(spark, sf_dir)
    return table_functions.call(spark, "cross_territory", "order")


#: What the reports read of the two large tables, to be stored bucketed.
_REPORT_COLUMNS = {
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount"],
    "orders": ["o_orderkey", "o_custkey"],
}


def _bucketed_tables(spark: SparkSession, sf_dir: str) -> Tables:
    return store_bucketed(_tables(spark, sf_dir), Scratch(spark).path("bucketed"), columns=_REPORT_COLUMNS)


def q_sales_by_territory_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.sales_by_territory(_bucketed_tables(spark, sf_dir), CATEGORY)


def q_cross_territory_orders_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_territory.cross_territory(_bucketed_tables(spark, sf_dir), "order")


def q_written_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new tables of U5 and U7 stored, with the counts taken from those writes."""
    t, scratch = _tables(spark, sf_dir), Scratch(spark)
    changes = [
        updates.set_order_quantity(t, fixture.mixed_quantity_changes(t)),
        updates.set_email(t, fixture.mixed_email_changes(t)),
    ]
    return _together(spark, *(lambda c=c: c.write(scratch.path(c.op)) for c in changes))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "sales_by_territory": q_sales_by_territory,
    "top_product_lines": q_top_product_lines,
    "top_product_units": q_top_product_units,
    "top_product_orders": q_top_product_orders,
    "top_product_by_territory": q_top_product_by_territory,
    "cross_territory_customers": q_cross_territory_customers,
    "cross_territory_orders": q_cross_territory_orders,
    "stock_adjusted": q_stock_adjusted,
    "stock_adjusted_half_up": q_stock_adjusted_half_up,
    "stock_decreased": q_stock_decreased,
    "order_quantity_updated": q_order_quantity_updated,
    "ship_method_updated": q_ship_method_updated,
    "ship_method_rejects": q_ship_method_rejects,
    "email_updated": q_email_updated,
    "update_outcomes": q_update_outcomes,
    "sales_report_lines": q_sales_report_lines,
    "top_product_report_lines": q_top_product_report_lines,
    "cross_territory_report_lines": q_cross_territory_report_lines,
    "sales_table_function": q_sales_table_function,
    "top_product_table_function": q_top_product_table_function,
    "cross_territory_table_function": q_cross_territory_table_function,
    "stock_adjusted_ceil": q_stock_adjusted_ceil,
    "order_quantity_rejects": q_order_quantity_rejects,
    "email_rejects": q_email_rejects,
    "email_mixed_updated": q_email_mixed_updated,
    "mixed_outcomes": q_mixed_outcomes,
    "cross_territory_order_report_lines": q_cross_territory_order_report_lines,
    "top_product_function_by_territory": q_top_product_function_by_territory,
    "top_product_function_orders": q_top_product_function_orders,
    "cross_territory_function_orders": q_cross_territory_function_orders,
    "sales_by_territory_bucketed": q_sales_by_territory_bucketed,
    "cross_territory_orders_bucketed": q_cross_territory_orders_bucketed,
    "written_outcomes": q_written_outcomes,
}


# -- oracle SQL (DuckDB) --------------------------------------------------------

# Exact line amount, as in fixture.line_amount.
_AMOUNT = "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))"
_CATEGORY = "TRY_CAST(substr(p_brand, 7) AS BIGINT)"



def _top_product_sql(measure_sql: str, group_sql: str) -> str:
    return f"""
        WITH counts AS (
            SELECT {group_sql} AS grp, l.l_partkey AS product_id,
                   CAST({measure_sql} AS BIGINT) AS requests
            FROM lineitem l
            JOIN orders o ON l.l_orderkey = o.o_orderkey
            JOIN customer c ON o.o_custkey = c.c_custkey
            JOIN nation n ON c.c_nationkey = n.n_nationkey
            JOIN region r ON n.n_regionkey = r.r_regionkey
            WHERE r.r_name = '{REGION}'
            GROUP BY 1, 2
        ), ranked AS (
            SELECT *, rank() OVER (PARTITION BY grp ORDER BY requests DESC) AS rk FROM counts
        )
        SELECT p.p_name AS product, requests, grp AS region, product_id
        FROM ranked LEFT JOIN part p ON p.p_partkey = ranked.product_id
        WHERE rk = 1
    """


def _cross_territory_sql(id_sql: str) -> str:
    return f"""
        SELECT DISTINCT {id_sql} AS id, no.n_name AS order_territory,
               ns.n_name AS ship_territory
        FROM lineitem l
        JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation no ON c.c_nationkey = no.n_nationkey
        JOIN nation ns ON s.s_nationkey = ns.n_nationkey
        WHERE c.c_nationkey <> s.s_nationkey
    """


# Inventory, the category's parts, and the three change tables, as CTEs.
_INVENTORY = """
    inv AS (
        SELECT l.l_partkey AS product_id, s.s_nationkey AS location_id,
               CAST(SUM(l.l_quantity) AS BIGINT) AS quantity
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        GROUP BY 1, 2
    ), cat AS (
        SELECT p_partkey FROM part WHERE """ + _CATEGORY + f""" = {CATEGORY}
    ), hit AS (
        SELECT inv.*, (location_id = {LOCATION}
                       AND product_id IN (SELECT p_partkey FROM cat)) AS is_hit
        FROM inv
    )"""

_QTY_CHANGES = """
    ch AS (
        SELECT DISTINCT l.l_orderkey, l.l_partkey,
               CAST(1 + l.l_orderkey % 50 AS DOUBLE) AS new_value, e.event_id AS seq
        FROM lineitem l JOIN events e ON l.l_orderkey = e.event_id
        WHERE e.event_type = 'purchase' AND l.l_linenumber = 1
    ), ok AS (
        SELECT * FROM ch WHERE EXISTS (
            SELECT 1 FROM lineitem b
            WHERE b.l_orderkey = ch.l_orderkey AND b.l_partkey = ch.l_partkey)
    ), w AS (
        SELECT l_orderkey, l_partkey, new_value FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_partkey
                                         ORDER BY seq DESC, new_value DESC) AS rn
            FROM ok) WHERE rn = 1
    )"""

_METHOD_CHANGES = """
    methods AS (
        SELECT TRY_CAST(regexp_extract(o_orderpriority, '^([0-9]+)', 1) AS INTEGER) AS id,
               min(o_orderpriority) AS name
        FROM orders GROUP BY 1
    ), ch AS (
        SELECT event_id AS o_orderkey, CAST(1 + event_id % 6 AS INTEGER) AS new_value,
               event_id AS seq
        FROM events WHERE event_type = 'click'
    ), known AS (
        SELECT * FROM ch WHERE new_value IN (SELECT id FROM methods)
    ), ok AS (
        SELECT * FROM known WHERE o_orderkey IN (SELECT o_orderkey FROM orders)
    ), w AS (
        SELECT o_orderkey, new_value FROM (
            SELECT *, row_number() OVER (PARTITION BY o_orderkey
                                         ORDER BY seq DESC, new_value DESC) AS rn
            FROM ok) WHERE rn = 1
    )"""

_EMAIL_CHANGES = """
    ch AS (
        SELECT user_id AS person_id,
               'u' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR)
                   || '@example.com' AS new_value,
               ts, event_id
        FROM events WHERE event_type = 'signup'
    ), ok AS (
        SELECT * FROM ch WHERE person_id IN (SELECT c_custkey FROM customer)
    ), w AS (
        SELECT person_id, new_value FROM (
            SELECT *, row_number() OVER (PARTITION BY person_id
                                         ORDER BY ts DESC, event_id DESC, new_value DESC) AS rn
            FROM ok) WHERE rn = 1
    )"""


def _lines_sql(source_sql: str, order_sql: str, parts: list[str]) -> str:
    rn = f"row_number() OVER (ORDER BY {order_sql})"
    line = " || ".join([f"CAST({rn} AS VARCHAR)", *parts])
    return f"""
        WITH u AS ({source_sql})
        SELECT {rn} AS n, {line} AS line FROM u
    """


_SALES_EXACT_SQL = f"""
        SELECT CAST(SUM({_AMOUNT}) AS DECIMAL(38,4)) AS total_sales,
               n.n_name AS territory, n.n_nationkey AS territory_id
        FROM lineitem l
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE {_CATEGORY} = {CATEGORY}
        GROUP BY n.n_name, n.n_nationkey
"""


ORACLE: dict[str, str] = {
    "sales_by_territory": f"""
        SELECT CAST(SUM({_AMOUNT}) AS DOUBLE) AS total_sales,
               n.n_name AS territory, n.n_nationkey AS territory_id
        FROM lineitem l
        JOIN part p ON l.l_partkey = p.p_partkey
        JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN customer c ON o.o_custkey = c.c_custkey
        JOIN nation n ON c.c_nationkey = n.n_nationkey
        WHERE {_CATEGORY} = {CATEGORY}
        GROUP BY n.n_name, n.n_nationkey
    """,
    "top_product_lines": _top_product_sql("COUNT(*)", "r.r_name"),
    "top_product_units": _top_product_sql("SUM(l.l_quantity)", "r.r_name"),
    "top_product_orders": _top_product_sql("COUNT(DISTINCT l.l_orderkey)", "r.r_name"),
    "top_product_by_territory": _top_product_sql("SUM(l.l_quantity)", "n.n_name"),
    "cross_territory_customers": _cross_territory_sql("c.c_custkey"),
    "cross_territory_orders": _cross_territory_sql("o.o_orderkey"),
    "stock_adjusted": f"""
        WITH {_INVENTORY}
        SELECT product_id, location_id,
               CASE WHEN is_hit THEN quantity + (quantity * {PCT}) // 100
                    ELSE quantity END AS quantity
        FROM hit
    """,
    # Stock is never negative, so integer forms of the roundings are exact:
    # half-up of q*5/100 = (q*5 + 50) // 100; floor of -q*5/100 = -((q*5 + 99) // 100).
    "stock_adjusted_half_up": f"""
        WITH {_INVENTORY}
        SELECT product_id, location_id,
               CASE WHEN is_hit THEN quantity + (quantity * {PCT} + 50) // 100
                    ELSE quantity END AS quantity
        FROM hit
    """,
    "stock_decreased": f"""
        WITH {_INVENTORY}
        SELECT product_id, location_id,
               CASE WHEN is_hit THEN quantity - (quantity * {PCT} + 99) // 100
                    ELSE quantity END AS quantity
        FROM hit
    """,
    "order_quantity_updated": f"""
        WITH {_QTY_CHANGES}
        SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber,
               COALESCE(w.new_value, l.l_quantity) AS l_quantity,
               l.l_extendedprice, l.l_discount, l.l_tax, l.l_returnflag,
               l.l_linestatus, l.l_shipdate
        FROM lineitem l
        LEFT JOIN w ON l.l_orderkey = w.l_orderkey AND l.l_partkey = w.l_partkey
    """,
    "ship_method_updated": f"""
        WITH {_METHOD_CHANGES}
        SELECT o.o_orderkey, o.o_custkey, o.o_orderstatus, o.o_totalprice, o.o_orderdate,
               COALESCE(m.name, o.o_orderpriority) AS o_orderpriority
        FROM orders o
        LEFT JOIN w ON o.o_orderkey = w.o_orderkey
        LEFT JOIN methods m ON m.id = w.new_value
    """,
    "ship_method_rejects": f"""
        WITH {_METHOD_CHANGES}
        SELECT o_orderkey, new_value, seq, 'no_such_method' AS reason
        FROM ch WHERE new_value NOT IN (SELECT id FROM methods)
        UNION ALL
        SELECT o_orderkey, new_value, seq, 'no_such_key' AS reason
        FROM known WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)
    """,
    "email_updated": f"""
        WITH {_EMAIL_CHANGES}
        SELECT c.c_custkey AS person_id,
               COALESCE(w.new_value, 'c' || CAST(c.c_custkey AS VARCHAR) || '@example.com')
                   AS email
        FROM customer c LEFT JOIN w ON c.c_custkey = w.person_id
    """,
    "update_outcomes": f"""
        WITH {_INVENTORY}
        SELECT 'adjust_stock' AS op, CAST(1 AS BIGINT) AS changes,
               (SELECT CAST(COUNT(*) > 0 AS BIGINT) FROM hit WHERE is_hit) AS applied,
               CAST(0 AS BIGINT) AS superseded,
               (SELECT CAST(COUNT(*) = 0 AS BIGINT) FROM hit WHERE is_hit) AS rejected,
               (SELECT COUNT(*) FROM hit WHERE is_hit) AS rows_matched
        UNION ALL (
        WITH {_QTY_CHANGES}
        SELECT 'set_order_quantity', (SELECT COUNT(*) FROM ch),
               (SELECT COUNT(*) FROM w),
               (SELECT COUNT(*) FROM ok) - (SELECT COUNT(*) FROM w),
               (SELECT COUNT(*) FROM ch) - (SELECT COUNT(*) FROM ok),
               (SELECT COUNT(*) FROM lineitem l WHERE EXISTS (
                    SELECT 1 FROM w WHERE w.l_orderkey = l.l_orderkey
                                      AND w.l_partkey = l.l_partkey)))
        UNION ALL (
        WITH {_METHOD_CHANGES}
        SELECT 'set_ship_method', (SELECT COUNT(*) FROM ch),
               (SELECT COUNT(*) FROM w),
               (SELECT COUNT(*) FROM ok) - (SELECT COUNT(*) FROM w),
               (SELECT COUNT(*) FROM ch) - (SELECT COUNT(*) FROM ok),
               (SELECT COUNT(*) FROM orders WHERE o_orderkey IN (SELECT o_orderkey FROM w)))
        UNION ALL (
        WITH {_EMAIL_CHANGES}
        SELECT 'set_email', (SELECT COUNT(*) FROM ch),
               (SELECT COUNT(*) FROM w),
               (SELECT COUNT(*) FROM ok) - (SELECT COUNT(*) FROM w),
               (SELECT COUNT(*) FROM ch) - (SELECT COUNT(*) FROM ok),
               (SELECT COUNT(*) FROM customer WHERE c_custkey IN (SELECT person_id FROM w)))
    """,
    "sales_report_lines": _lines_sql(
        _SALES_EXACT_SQL,
        "territory_id",
        [
            "' Total Ventas:'", "CAST(total_sales AS VARCHAR)",
            "' Territorio:'", "territory",
            "' IDTerritorio:'", "CAST(territory_id AS VARCHAR)",
        ],
    ),
    "top_product_report_lines": _lines_sql(
        _top_product_sql("COUNT(*)", "r.r_name"),
        "region, product_id",
        [
            "' Producto:'", "product",
            "' Solicitudes:'", "CAST(requests AS VARCHAR)",
            "' Region:'", "region",
        ],
    ),
    "cross_territory_report_lines": _lines_sql(
        _cross_territory_sql("c.c_custkey"),
        "id, order_territory, ship_territory",
        [
            "' ID: '", "CAST(id AS VARCHAR)",
            "' TeritorioPedido:'", "order_territory",
            "' TerritorioMandado:'", "ship_territory",
        ],
    ),
}
ORACLE["sales_table_function"] = ORACLE["sales_by_territory"]
ORACLE["top_product_table_function"] = ORACLE["top_product_lines"]
ORACLE["cross_territory_table_function"] = ORACLE["cross_territory_customers"]
ORACLE["cross_territory_order_report_lines"] = _lines_sql(
    _cross_territory_sql("o.o_orderkey"),
    "id, order_territory, ship_territory",
    ["' ID: '", "CAST(id AS VARCHAR)", "' TeritorioPedido:'", "order_territory", "' TerritorioMandado:'", "ship_territory"],
)
# ceil of q*5/100 = (q*5 + 99) // 100.
ORACLE["stock_adjusted_ceil"] = f"""
    WITH {_INVENTORY}
    SELECT product_id, location_id,
           CASE WHEN is_hit THEN quantity + (quantity * {PCT} + 99) // 100 ELSE quantity END AS quantity
    FROM hit
"""

_MIXED_QTY = """
    ch AS (
        SELECT CASE WHEN e.event_id % 11 <> 0 THEN e.event_id END AS l_orderkey,
               CASE WHEN e.event_id % 7 = 0 OR l.l_partkey IS NULL THEN 0 ELSE l.l_partkey END AS l_partkey,
               CASE WHEN e.event_id % 13 <> 0 THEN CAST(1 + e.event_id % 50 AS DOUBLE) END AS new_value,
               e.event_id AS seq
        FROM events e LEFT JOIN lineitem l ON l.l_orderkey = e.event_id AND l.l_linenumber = 1
        WHERE e.event_type = 'purchase'
    ), judged AS (
        SELECT *, CASE WHEN l_orderkey IS NULL THEN 'null_key' WHEN new_value IS NULL THEN 'null_value'
                       WHEN NOT EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = ch.l_orderkey
                                                                   AND b.l_partkey = ch.l_partkey)
                       THEN 'no_such_key' END AS reason
        FROM ch
    ), w AS (SELECT DISTINCT l_orderkey, l_partkey FROM judged WHERE reason IS NULL)"""

_MIXED_EMAIL = """
    ch AS (
        SELECT CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 7 = 0 THEN -user_id - 1
                    ELSE user_id END AS person_id,
               CASE WHEN event_id % 13 <> 0 THEN
                   'u' || CAST(user_id AS VARCHAR) || '.' || CAST(event_id AS VARCHAR) || '@example.com'
               END AS new_value,
               event_id AS seq
        FROM events
    ), judged AS (
        SELECT *, CASE WHEN person_id IS NULL THEN 'null_key' WHEN new_value IS NULL THEN 'null_value'
                       WHEN person_id NOT IN (SELECT c_custkey FROM customer) THEN 'no_such_key' END AS reason
        FROM ch
    ), w AS (
        SELECT person_id, new_value FROM (
            SELECT *, row_number() OVER (PARTITION BY person_id ORDER BY seq DESC, new_value DESC) AS rn
            FROM judged WHERE reason IS NULL) WHERE rn = 1
    )"""



def _rejects_sql(ctes: str, keys: list[str]) -> str:
    texts = ", ".join(f"COALESCE(CAST({c} AS VARCHAR), 'null') AS {c}" for c in [*keys, "new_value"])
    return f"WITH {ctes} SELECT {texts}, seq, reason FROM judged WHERE reason IS NOT NULL"


ORACLE["order_quantity_rejects"] = _rejects_sql(_MIXED_QTY, ["l_orderkey", "l_partkey"])
ORACLE["email_rejects"] = _rejects_sql(_MIXED_EMAIL, ["person_id"])
ORACLE["email_mixed_updated"] = f"""
    WITH {_MIXED_EMAIL}
    SELECT c.c_custkey AS person_id,
           COALESCE(w.new_value, 'c' || CAST(c.c_custkey AS VARCHAR) || '@example.com') AS email
    FROM customer c LEFT JOIN w ON c.c_custkey = w.person_id
"""


def _mixed_outcome_sql(op: str, ctes: str, matched: str) -> str:
    return f"""
        SELECT * FROM (
            WITH {ctes}
            SELECT '{op}' AS op, (SELECT COUNT(*) FROM ch) AS changes, (SELECT COUNT(*) FROM w) AS applied,
                   (SELECT COUNT(*) FROM judged WHERE reason IS NULL) - (SELECT COUNT(*) FROM w) AS superseded,
                   (SELECT COUNT(*) FROM judged WHERE reason IS NOT NULL) AS rejected,
                   ({matched}) AS rows_matched)
    """


ORACLE["written_outcomes"] = " UNION ALL ".join(
    [
        _mixed_outcome_sql(
            "set_order_quantity", _MIXED_QTY,
            "SELECT COUNT(*) FROM lineitem l WHERE EXISTS (SELECT 1 FROM w WHERE w.l_orderkey = l.l_orderkey"
            " AND w.l_partkey = l.l_partkey)",
        ),
        _mixed_outcome_sql(
            "set_email", _MIXED_EMAIL, "SELECT COUNT(*) FROM customer WHERE c_custkey IN (SELECT person_id FROM w)"
        ),
    ]
)
ORACLE["mixed_outcomes"] = (
    "SELECT 'adjust_stock' AS op, 1::BIGINT AS changes, 0::BIGINT AS applied, 0::BIGINT AS superseded,"
    " 1::BIGINT AS rejected, 0::BIGINT AS rows_matched UNION ALL " + ORACLE["written_outcomes"]
)
ORACLE["top_product_function_by_territory"] = ORACLE["top_product_by_territory"]
ORACLE["top_product_function_orders"] = ORACLE["top_product_orders"]
ORACLE["cross_territory_function_orders"] = ORACLE["cross_territory_orders"]
ORACLE["sales_by_territory_bucketed"] = ORACLE["sales_by_territory"]
ORACLE["cross_territory_orders_bucketed"] = ORACLE["cross_territory_orders"]
