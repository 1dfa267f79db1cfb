"""U1-U4, U5-U7 wrappers on hand-made rows with known answers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from conftest import make_tables
from stockyard.operators import cross_territory, ranking, sales, stock, updates

D = dt.datetime(2000, 1, 1)


def _world(spark, lines, orders=None, customers=None, parts=None, suppliers=None):
    return make_tables(
        spark,
        region=[(0, "AFRICA"), (1, "AMERICA")],
        nation=[(0, "N0", 0), (1, "N1", 1), (2, "N2", 1), (3, "N3", 0)],
        customer=customers
        or [(10, "c10", 1, 0.0, "X"), (11, "c11", 2, 0.0, "X"), (12, "c12", 0, 0.0, "X")],
        supplier=suppliers or [(100, "s100", 1, 0.0), (101, "s101", 0, 0.0)],
        part=parts
        or [
            (1, "widget", "Brand#7", "T", 1, 1.0),
            (2, "widget", "Brand#7", "T", 1, 1.0),  # same name, other part
            (3, "bolt", "Brand#3", "T", 1, 1.0),
        ],
        orders=orders
        or [
            (1000, 10, "O", 0.0, D, "1-URGENT"),
            (1001, 11, "O", 0.0, D, "2-HIGH"),
            (1002, 12, "O", 0.0, D, "3-MEDIUM"),
        ],
        lineitem=lines,
    )


def _line(order, part, supp, qty=1.0, price=100.0, disc=0.0, num=1):
    return (order, part, supp, num, qty, price, disc, 0.0, "N", "O", D)


# -- U1 ---------------------------------------------------------------------


def test_sales_by_territory_exact_and_inner(spark):
    lines = [
        _line(1000, 1, 100, price=0.1, disc=0.0),
        _line(1000, 2, 100, price=0.2, disc=0.0),  # 0.1 + 0.2 must be exactly 0.3
        _line(1001, 1, 100, price=50.0, disc=0.1),
        _line(1002, 3, 100, price=999.0),  # other category: territory N0 absent
    ]
    t = _world(spark, lines)
    got = {r.territory_id: (r.total_sales, r.territory) for r in sales.sales_by_territory(t, 7).collect()}
    assert got == {1: (0.3, "N1"), 2: (45.0, "N2")}


def test_sales_all_categories_sum_to_total(spark, small_tables):
    t = small_tables
    total = (
        t["lineitem"]
        .join(t["orders"], t["lineitem"].l_orderkey == t["orders"].o_orderkey)
        .agg(F.sum(F.col("l_extendedprice").cast("decimal(12,2)")
                   * (1 - F.col("l_discount").cast("decimal(4,2)"))).alias("s"))
        .first()
        .s
    )
    parts = 0
    for cat in range(1, 26):
        for r in sales.sales_by_territory_exact(t, cat).collect():
            parts += r.total_sales
    assert parts == total


# -- U2 ---------------------------------------------------------------------


def test_top_product_keeps_ties_and_groups_by_key(spark):
    lines = [
        _line(1000, 1, 100),
        _line(1000, 2, 100),
        _line(1001, 1, 100),
        _line(1001, 2, 100),
        _line(1002, 3, 100),  # AFRICA customer: not counted
        _line(1002, 3, 100),
        _line(1002, 3, 100),
    ]
    t = _world(spark, lines)
    got = sorted(
        (r.product_id, r.product, r.requests, r.region)
        for r in ranking.top_requested_product(t, "AMERICA", "lines").collect()
    )
    assert got == [(1, "widget", 2, "AMERICA"), (2, "widget", 2, "AMERICA")]


def test_top_product_measures_and_territory_grain(spark):
    lines = [
        _line(1000, 1, 100, qty=5.0),
        _line(1000, 1, 100, qty=5.0, num=2),  # same order twice
        _line(1001, 2, 100, qty=20.0),
        _line(1001, 1, 100, qty=1.0),
    ]
    t = _world(spark, lines)
    lines_top = {(r.product_id, r.requests) for r in ranking.top_requested_product(t, measure="lines").collect()}
    units_top = {(r.product_id, r.requests) for r in ranking.top_requested_product(t, measure="units").collect()}
    orders_top = {(r.product_id, r.requests) for r in ranking.top_requested_product(t, measure="orders").collect()}
    assert lines_top == {(1, 3)}
    assert units_top == {(2, 20)}
    assert orders_top == {(1, 2)}
    per_nation = {
        (r.region, r.product_id, r.requests)
        for r in ranking.top_requested_product(t, measure="units", per="territory").collect()
    }
    assert per_nation == {("N1", 1, 10), ("N2", 2, 20)}


def test_top_product_rejects_bad_arguments(spark):
    t = _world(spark, [])
    with pytest.raises(ValueError):
        ranking.top_requested_product(t, measure="weight")
    with pytest.raises(ValueError):
        ranking.top_requested_product(t, per="planet")


# -- U4 ---------------------------------------------------------------------


def test_cross_territory_distinct_and_nulls(spark):
    lines = [
        _line(1000, 1, 100),  # customer N1, supplier N1: same
        _line(1000, 2, 101),  # supplier N0: differs
        _line(1000, 3, 101),  # duplicate pair
        _line(1001, 1, 101),  # customer N2 -> N0
        _line(1002, 1, 102),  # supplier with null nation
    ]
    suppliers = [(100, "s", 1, 0.0), (101, "s", 0, 0.0), (102, "s", None, 0.0)]
    t = _world(spark, lines, suppliers=suppliers)
    got = sorted(tuple(r) for r in cross_territory.cross_territory(t, "customer").collect())
    assert got == [(10, "N1", "N0"), (11, "N2", "N0")]
    by_order = sorted(tuple(r) for r in cross_territory.cross_territory(t, "order").collect())
    assert by_order == [(1000, "N1", "N0"), (1001, "N2", "N0")]


# -- U3 ---------------------------------------------------------------------


@pytest.mark.parametrize(
    "qty,pct,rounding,want",
    [
        (19, 5, "floor", 19),
        (20, 5, "floor", 21),
        (21, 5, "floor", 22),
        (19, 5, "ceil", 20),
        (10, 5, "half_up", 11),  # 0.5 rounds up
        (9, 5, "half_up", 9),  # 0.45 rounds down
        (19, -5, "floor", 18),  # -0.95 floors to -1
        (0, 5, "floor", 0),
    ],
)
def test_adjusted_quantity(spark, qty, pct, rounding, want):
    df = spark.createDataFrame([(qty,)], "q bigint")
    got = df.select(stock.adjusted_quantity(F.col("q"), pct, rounding).alias("x")).first().x
    assert got == want


def test_adjust_stock_only_category_and_location(spark):
    t = _world(spark, [])
    inv = spark.createDataFrame(
        [(1, 8, 100), (1, 9, 100), (3, 8, 100), (2, 8, 19), (2, 8, 40)],
        "product_id bigint, location_id int, quantity bigint",
    )
    adj = stock.adjust_stock(t, 7, 8, inventory=inv)
    got = sorted(tuple(r) for r in adj.updated.collect())
    assert got == sorted([(1, 8, 105), (1, 9, 100), (3, 8, 100), (2, 8, 19), (2, 8, 42)])
    assert adj.outcome.first().rows_matched == 3


# -- U5-U7 wrappers --------------------------------------------------------


def test_ship_method_rejects_unknown_method(spark):
    t = _world(spark, [])
    changes = spark.createDataFrame(
        [(1000, 3, 1), (1001, 6, 2), (5555, 2, 3)], "o_orderkey bigint, new_value int, seq bigint"
    )
    res = updates.set_ship_method(t, changes)
    got = {r.o_orderkey: r.o_orderpriority for r in res.updated.collect()}
    assert got == {1000: "3-MEDIUM", 1001: "2-HIGH", 1002: "3-MEDIUM"}
    assert {(r.o_orderkey, r.reason) for r in res.rejects.collect()} == {
        (1001, "no_such_method"),
        (5555, "no_such_key"),
    }
    o = res.outcome.first()
    assert (o.changes, o.applied, o.rejected, o.rows_matched) == (3, 1, 2, 1)


def test_order_quantity_min_quantity(spark):
    t = _world(spark, [_line(1000, 1, 100, qty=4.0), _line(1000, 1, 100, qty=6.0, num=2)])
    changes = spark.createDataFrame(
        [(1000, 1, 0.0, 1), (1000, 1, 9.0, 0)], "l_orderkey bigint, l_partkey bigint, new_value double, seq bigint"
    )
    res = updates.set_order_quantity(t, changes, min_quantity=1)
    assert sorted(r.l_quantity for r in res.updated.collect()) == [9.0, 9.0]
    assert [r.reason for r in res.rejects.collect()] == ["below_min_quantity"]
    no_check = updates.set_order_quantity(t, changes)
    assert sorted(r.l_quantity for r in no_check.updated.collect()) == [0.0, 0.0]


def test_email_latest_signup(spark):
    events = [
        (1, dt.datetime(2024, 1, 1), 10, "signup", 0.0, "{}"),
        (2, dt.datetime(2024, 1, 2), 10, "signup", 0.0, "{}"),
        (3, dt.datetime(2024, 1, 1, 12), 10, "signup", 0.0, "{}"),
        (4, dt.datetime(2024, 1, 1), 10, "click", 0.0, "{}"),
    ]
    t = make_tables(
        spark,
        customer=[(10, "c", 1, 0.0, "X"), (11, "c", 1, 0.0, "X")],
        events=events,
    )
    res = updates.set_email(t)
    got = {r.person_id: r.email for r in res.updated.collect()}
    assert got == {10: "u10.2@example.com", 11: "c11@example.com"}


def test_ship_method_seq_column_across_runs(spark, small_tables):
    """U6 with an applied-seq column on orders: a second run carrying older
    changes to the same orders (other methods) leaves the newer methods in
    place, so two runs equal one run over all changes."""
    from stockyard.sources import fixture
    from stockyard.streaming.change_feed import with_seq_column

    newer = fixture.ship_method_changes(small_tables)
    older = newer.select(
        "o_orderkey",
        (F.lit(1) + F.col("new_value") % 5).alias("new_value"),  # always another method
        (F.col("seq") - 1).alias("seq"),
    )
    orders = with_seq_column(small_tables["orders"], "bigint")
    run1 = updates.set_ship_method(
        small_tables.with_table("orders", orders), newer, seq_column="_seq"
    ).updated
    run2 = updates.set_ship_method(
        small_tables.with_table("orders", run1), older, seq_column="_seq"
    ).updated.drop("_seq")
    want = updates.set_ship_method(small_tables, newer.unionByName(older)).updated
    assert run2.count() == want.count()
    assert run2.exceptAll(want).count() == 0
    untracked = updates.set_ship_method(
        small_tables.with_table("orders", updates.set_ship_method(small_tables, newer).updated),
        older,
    ).updated
    assert untracked.exceptAll(want).count() > 0
