"""The logical tables of the seven operations, built from the driver's tables.

The operations speak of territories, products with categories, orders with an
origin and a ship-to territory, stock per product and location, ship methods
and person emails. The test data is a TPC-H-like star schema, so each logical
table is a projection (or a small derivation) over it:

==================  ===================================================
territory           ``nation`` joined to ``region``
product             ``part``; category = the integer after ``Brand#``
order territory     ``orders.o_custkey`` -> ``customer.c_nationkey``
ship territory      per line: ``l_suppkey`` -> ``supplier.s_nationkey``
line amount         ``l_extendedprice * (1 - l_discount)``, exact decimal
inventory           ``lineitem`` x ``supplier`` summed per (part, nation)
ship method         distinct ``o_orderpriority``; ID = its leading digit
person email        ``c<custkey>@example.com`` per customer
==================  ===================================================

Change tables for the keyed updates are derived from ``events`` (see
:func:`quantity_changes`, :func:`ship_method_changes`, :func:`email_changes`),
so their size grows with the data like everything else.

Everything here is a lazy DataFrame; nothing is collected.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.broadcast import bounded_broadcast
from .tables import Tables

# Fixed values of the fixture mapping.
NORTH_AMERICA = "AMERICA"  # region name standing for "North America"
EMAIL_DOMAIN = "@example.com"
PRICE_TYPE = "decimal(12,2)"  # l_extendedprice carries cents
RATE_TYPE = "decimal(4,2)"  # l_discount carries hundredths
QUANTITY_TYPE = "decimal(28,6)"


def per_catalog(build: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
    """Build a derived view once per :class:`Tables` (DataFrames are immutable plans)."""

    @functools.wraps(build)
    def view(t: Tables) -> DataFrame:
        return t.derived(build.__name__, lambda: build(t))

    return view


def line_amount(price: str = "l_extendedprice", discount: str = "l_discount") -> Column:
    """Net line amount as an exact decimal: price * (1 - discount).

    Each input is cast to decimal *before* the arithmetic, so sums are exact
    and independent of the order in which partitions are added up.
    """
    return F.col(price).cast(PRICE_TYPE) * (F.lit(1) - F.col(discount).cast(RATE_TYPE))


#: ``Brand#7`` -> 7; null where no number follows. Shared with the SQL table function.
CATEGORY_SQL = "try_cast(substring(p_brand, 7) as bigint)"


def category_of() -> Column:
    return F.expr(CATEGORY_SQL)


@per_catalog
def territory(t: Tables) -> DataFrame:
    """territory_id, territory, region_id, region (25 rows; a fixed dimension)."""
    nation = t["nation"]
    region = bounded_broadcast(t["region"], cache=t.bounded_cache, key="region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey, "left").select(
        F.col("n_nationkey").alias("territory_id"),
        F.col("n_name").alias("territory"),
        F.col("n_regionkey").alias("region_id"),
        F.col("r_name").alias("region"),
    )


def territory_dim(t: Tables) -> DataFrame:
    """:func:`territory` behind the bounded broadcast check (built once per catalog)."""
    return t.derived(
        "territory_dim",
        lambda: bounded_broadcast(territory(t), cache=t.bounded_cache, key="territory"),
    )


@per_catalog
def product(t: Tables) -> DataFrame:
    """product_id, product, category_id."""
    return t["part"].select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product"),
        category_of().alias("category_id"),
    )


@per_catalog
def order_territory(t: Tables) -> DataFrame:
    """order_id, customer_id, territory_id (the customer's nation)."""
    orders = t["orders"].select("o_orderkey", "o_custkey")
    customer = t["customer"].select("c_custkey", "c_nationkey")
    return orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("c_nationkey").alias("territory_id"),
    )


@per_catalog
def line_ship_territory(t: Tables) -> DataFrame:
    """order_id, ship_territory_id per line (the supplier's nation).

    ``supplier`` grows with the data, so it is left to the planner: broadcast
    while its statistics are under the threshold, sort-merge beyond.
    """
    lines = t["lineitem"].select("l_orderkey", "l_suppkey")
    supplier = t["supplier"].select("s_suppkey", "s_nationkey")
    return lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).select(
        F.col("l_orderkey").alias("order_id"),
        F.col("s_nationkey").alias("ship_territory_id"),
    )


#: Territory keys from 0 up to this are held as bits of words; beyond, as a set.
MOST_BITS = 512


def territory_words(t: Tables) -> int | None:
    """How many 64-bit words hold one bit for each territory key; None if the keys of the
    territory dimension don't lie in 0 .. MOST_BITS - 1 (one row, once per catalog)."""
    if "territory_words" not in t.facts:
        low, high = t["nation"].agg(F.min("n_nationkey"), F.max("n_nationkey")).first()
        fits = low is None or (low >= 0 and high < MOST_BITS)
        t.facts["territory_words"] = (0 if high is None else high // 64) + 1 if fits else None
    return t.facts["territory_words"]


def bit_words(key: str, words: int) -> list[Column]:
    """The set of the keys in a group as ``words`` 64-bit words: ``bit_or`` has a buffer of one
    long, so the aggregate stays a hash aggregate of fixed width (a ``collect_set`` is an
    object aggregate, which falls back to sorting past a few groups)."""
    bit = F.expr(f"shiftleft(1L, cast({key} as int) & 63)")
    return [F.coalesce(F.bit_or(F.when(F.floor(F.col(key) / 64) == w, bit)), F.lit(0).cast("bigint")).alias(f"w{w}") for w in range(words)]


#: The keys of the bits of some words, without one key; shared with the SQL table functions.
BITS_SQL = (
    "CASE WHEN {without} IS NOT NULL THEN filter(sequence(0, {last}), k -> "
    "(shiftright(element_at(array({words}), CAST(k div 64 AS INT) + 1), CAST(k AS INT) & 63) & 1) = 1 AND k <> {without}) END"
)


def keys_of_bits(words: int, without: str) -> Column:
    """The keys whose bits are set in ``w0``, ``w1``, ..., except the key in column ``without``
    (null there: none at all), as an array."""
    return F.expr(BITS_SQL.format(last=64 * words - 1, words=", ".join(f"w{w}" for w in range(words)), without=without))


@per_catalog
def order_ship_territories(t: Tables) -> DataFrame:
    """order_id and the distinct supplier nations of each order's lines (nulls dropped): as
    bits of ``w0``, ``w1``, ... (see :func:`territory_words`), else as array
    ``ship_territory_ids``.

    Either aggregates partially in each map task, so an order with a third of all lines
    leaves every task as one row, and the result comes out hash-partitioned on
    ``order_id``, ready for a join on that key without another exchange.
    """
    words = territory_words(t)
    sets = [F.collect_set("ship_territory_id").alias("ship_territory_ids")] if words is None else bit_words("ship_territory_id", words)
    return line_ship_territory(t).groupBy("order_id").agg(*sets)


@per_catalog
def inventory(t: Tables) -> DataFrame:
    """product_id bigint, location_id int, quantity bigint.

    Stock of a part at a location = the units of it supplied from that nation.
    The group-by pre-aggregates map-side, so a part sold everywhere does not
    put all its lines in one task.
    """
    lines = t["lineitem"].select("l_partkey", "l_suppkey", "l_quantity")
    supplier = t["supplier"].select("s_suppkey", "s_nationkey")
    return (
        lines.join(supplier, lines.l_suppkey == supplier.s_suppkey)
        .groupBy(
            F.col("l_partkey").alias("product_id"),
            F.col("s_nationkey").alias("location_id"),
        )
        # Decimals add up alike in any order; stock counts whole units.
        .agg(F.sum(F.col("l_quantity").cast(QUANTITY_TYPE)).cast("bigint").alias("quantity"))
    )


@per_catalog
def ship_methods(t: Tables) -> DataFrame:
    """ship_method_id int, name string: one row per leading number of the order
    priorities (5 rows). A partial aggregation over one column of ``orders``."""
    return (
        t["orders"]
        .groupBy(ship_method_of().alias("ship_method_id"))
        .agg(F.min("o_orderpriority").alias("name"))
        .filter(F.col("ship_method_id").isNotNull())
    )


def ship_method_dim(t: Tables) -> DataFrame:
    """:func:`ship_methods` behind the bounded broadcast check (built once per catalog)."""
    return t.derived(
        "ship_method_dim",
        lambda: bounded_broadcast(ship_methods(t), cache=t.bounded_cache, key="ship_methods"),
    )


def ship_method_of(priority: str = "o_orderpriority") -> Column:
    """``12-NAME`` -> 12; null where no number leads."""
    return F.regexp_extract(F.col(priority), "^([0-9]+)", 1).try_cast("int")


@per_catalog
def person_email(t: Tables) -> DataFrame:
    """person_id bigint, email string: one address per customer."""
    return t["customer"].select(
        F.col("c_custkey").alias("person_id"),
        F.concat(F.lit("c"), F.col("c_custkey").cast("string"), F.lit(EMAIL_DOMAIN)).alias(
            "email"
        ),
    )


# -- change tables ------------------------------------------------------------


@per_catalog
def quantity_changes(t: Tables) -> DataFrame:
    """U5 changes: l_orderkey, l_partkey, new_value double, seq bigint.

    A ``purchase`` event whose ID is an order sets the quantity of the part on
    that order's line number 1 to ``1 + order % 50``.
    """
    events = t["events"].filter(F.col("event_type") == "purchase").select("event_id")
    first_lines = t["lineitem"].filter(F.col("l_linenumber") == 1).select(
        "l_orderkey", "l_partkey"
    )
    return (
        first_lines.join(events, first_lines.l_orderkey == events.event_id)
        .select(
            "l_orderkey",
            "l_partkey",
            (F.lit(1) + F.col("l_orderkey") % 50).cast("double").alias("new_value"),
            F.col("event_id").alias("seq"),
        )
        .distinct()
    )


@per_catalog
def ship_method_changes(t: Tables) -> DataFrame:
    """U6 changes: o_orderkey, new_value int (method ID), seq bigint.

    A ``click`` event sets the method of the order with its ID to
    ``1 + event % 6``; method 6 does not exist and must be rejected.
    """
    return (
        t["events"]
        .filter(F.col("event_type") == "click")
        .select(
            F.col("event_id").alias("o_orderkey"),
            (F.lit(1) + F.col("event_id") % 6).cast("int").alias("new_value"),
            F.col("event_id").alias("seq"),
        )
    )


@per_catalog
def email_changes(t: Tables) -> DataFrame:
    """U7 changes: person_id, new_value string, seq struct<ts, event_id>.

    A ``signup`` event sets the user's email; customers sign up repeatedly,
    and the latest (ts, event_id) wins.
    """
    return (
        t["events"]
        .filter(F.col("event_type") == "signup")
        .select(
            F.col("user_id").alias("person_id"),
            F.concat(
                F.lit("u"),
                F.col("user_id").cast("string"),
                F.lit("."),
                F.col("event_id").cast("string"),
                F.lit(EMAIL_DOMAIN),
            ).alias("new_value"),
            F.struct(F.col("ts"), F.col("event_id")).alias("seq"),
        )
    )


# -- change tables with every reason a change is set aside ---------------------


def _unless(divisor: int, value: Column) -> Column:
    """``value``, but null where the event's ID is divisible by ``divisor``."""
    return F.when(F.col("event_id") % divisor != 0, value)


@per_catalog
def mixed_quantity_changes(t: Tables) -> DataFrame:
    """U5 changes from every ``purchase`` event, also those whose order is unknown; with
    null orders (IDs divisible by 11), unknown parts (7) and null quantities (13)."""
    events = t["events"].filter(F.col("event_type") == "purchase").select("event_id")
    first_lines = t["lineitem"].filter(F.col("l_linenumber") == 1).select("l_orderkey", "l_partkey")
    part = F.coalesce(_unless(7, F.col("l_partkey")), F.lit(0))
    return events.join(first_lines, events.event_id == first_lines.l_orderkey, "left").select(
        _unless(11, F.col("event_id")).alias("l_orderkey"),
        part.cast("bigint").alias("l_partkey"),
        _unless(13, (F.lit(1) + F.col("event_id") % 50).cast("double")).alias("new_value"),
        F.col("event_id").alias("seq"),
    )


@per_catalog
def mixed_email_changes(t: Tables) -> DataFrame:
    """U7 changes from every event, so persons repeat; with null persons (event IDs
    divisible by 11), unknown ones (7: the negated ID) and null addresses (13)."""
    user = F.col("user_id")
    person = F.when(F.col("event_id") % 7 == 0, -user - 1).otherwise(user)
    email = F.concat(F.lit("u"), user.cast("string"), F.lit("."), F.col("event_id").cast("string"), F.lit(EMAIL_DOMAIN))
    return t["events"].select(
        _unless(11, person).cast("bigint").alias("person_id"),
        _unless(13, email).alias("new_value"),
        F.col("event_id").alias("seq"),
    )
