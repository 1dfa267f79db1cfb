"""Results stay whole and updates safe: fresh catalogs, exact numbers, lost updates."""

from __future__ import annotations

import shutil

import pytest
from pyspark.sql import functions as F

from stockyard import registry
from stockyard.functions import report, table_functions
from stockyard.operators import stock, updates
from stockyard.operators.changeset import apply_changes
from stockyard.plans.snapshots import ConcurrentCommitError, SnapshotStore
from stockyard.plans.versioned import commit_changes
from stockyard.sources import fixture
from stockyard.sources.tables import Tables

SF = "/root/testdata/sf0.001"
KEYS = ["k"]


def _total(df):
    return df.agg(F.sum("total_sales")).first()[0]


def test_a_query_sees_files_added_since_the_last_one(spark, tmp_path):
    for name in ("region", "nation", "customer", "supplier", "part", "orders"):
        shutil.copy(f"{SF}/{name}.parquet", tmp_path / f"{name}.parquet")
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    query = registry.QUERIES["sales_by_territory"]
    before = _total(query(spark, str(tmp_path)))
    lines.write.mode("append").parquet(str(tmp_path / "lineitem.parquet"))
    assert _total(query(spark, str(tmp_path))) == pytest.approx(2 * before)


def test_category_and_method_numbers_of_any_length(spark):
    brands = spark.createDataFrame([("Brand#7",), ("Brand#12345678901",), ("Brand#x",), (None,)], "p_brand string")
    assert [r[0] for r in brands.select(fixture.category_of()).collect()] == [7, 12345678901, None, None]
    methods = spark.createDataFrame([("1-URGENT",), ("12-SLOW",), ("none",)], "o_orderpriority string")
    assert [r[0] for r in methods.select(fixture.ship_method_of()).collect()] == [1, 12, None]


def test_large_totals_render(spark):
    big = spark.sql("SELECT cast('12345678901234567890.1234' AS decimal(38,4)) AS x")
    assert big.select(F.col("x").cast(report.MONEY_TEXT).cast("string")).first()[0] == "12345678901234567890.1234"


@pytest.mark.parametrize("pct", [0.00004, "0.00005", 10**9, float("nan")])
def test_percentages_that_do_not_fit_are_refused(pct):
    with pytest.raises(ValueError):
        stock.exact_percentage(pct)


def test_stock_adjustment_without_a_match_is_rejected(spark):
    t = Tables.from_parquet(spark, SF)
    row = stock.adjust_stock(t, 999, 8, 5).outcome.first()
    assert (row.applied, row.rejected, row.rows_matched) == (0, 1, 0)


def test_products_listed_twice_do_not_double_the_stock(spark):
    t = Tables.from_parquet(spark, SF)
    twice = t.with_table("part", t["part"].unionByName(t["part"]))
    assert stock.adjust_stock(twice, 7, 8, 5).updated.count() == stock.adjust_stock(t, 7, 8, 5).updated.count()


def test_the_second_of_two_writers_from_one_version_fails(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    store.initialize(spark.createDataFrame([(1, 1), (2, 2)], "k int, v int"))
    change = lambda k, v: spark.createDataFrame([(k, v, 1)], "k int, new_value int, seq int")

    def slow(result):  # another writer commits between this one's read and its commit
        commit_changes(store, change(2, 20), KEYS, "v", "other")

    with pytest.raises(ConcurrentCommitError):
        commit_changes(store, change(1, 111), KEYS, "v", "late", before_commit=slow)
    assert sorted(map(tuple, store.read().collect())) == [(1, 1), (2, 20)]


def test_a_failed_rejects_write_leaves_nothing_committed(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"))
    store.initialize(spark.createDataFrame([(1, 1)], "k int, v int"))
    change = spark.createDataFrame([(1, 5, 1), (9, 9, 1)], "k int, new_value int, seq int")
    kept = []

    def fail(result):
        raise OSError("no space")

    with pytest.raises(OSError):
        commit_changes(store, change, KEYS, "v", "op", "id-1", before_commit=fail)
    commit, _ = commit_changes(store, change, KEYS, "v", "op", "id-1", before_commit=lambda r: kept.extend(r.rejects.collect()))
    assert not commit.skipped and [r.k for r in kept] == [9]


def test_wide_values_are_not_broadcast_and_hot_base_keys_collapse_first(spark, monkeypatch):
    from stockyard.operators import changeset

    base = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("k"), F.lit("a").alias("v"))
    change = spark.range(0, 3000, 2).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 50).alias("new_value"), F.lit(1).alias("seq"))
    small = apply_changes(base, change, KEYS, "v")
    assert small.is_small()
    monkeypatch.setattr(changeset, "CHANGES_BROADCAST_MAX_BYTES", 10_000)
    wide = apply_changes(base, change, KEYS, "v")
    assert not wide.is_small()
    assert wide.outcome.first() == small.outcome.first()
    # Below every shuffle of the base its rows are counted per key already.
    plan = wide.per_key._jdf.queryExecution().executedPlan().toString()
    for part in plan.split("Exchange hashpartitioning")[1:]:
        assert "partial_count(1)" in part or "Range" not in part.split("Exchange")[0]
    assert "partial_count(1)" in plan and "LeftSemi" not in plan


def test_table_functions_of_two_catalogs(spark):
    spark.range(3).createOrReplaceTempView("orders")
    one = Tables.from_parquet(spark, SF)
    two = one.with_table("lineitem", one["lineitem"].unionByName(one["lineitem"]))
    table_functions.register(one, "a_")
    table_functions.register(two, "b_")
    a = _total(table_functions.call(spark, "sales_by_territory", 7, prefix="a_"))
    b = _total(table_functions.call(spark, "sales_by_territory", 7, prefix="b_"))
    assert b == pytest.approx(2 * a) and spark.table("orders").count() == 3
    spark.catalog.dropTempView("orders")


def test_ship_method_update_reads_orders_once_and_takes_unused_methods(spark, small_tables):
    methods = spark.createDataFrame([(1, "1-URGENT"), (42, "42-NEW")], "ship_method_id int, name string")
    orders = small_tables["orders"]
    first, second = [r[0] for r in orders.select("o_orderkey").orderBy("o_orderkey").limit(2).collect()]
    changes = spark.createDataFrame([(first, 42, 1), (second, 7, 1)], "o_orderkey long, new_value int, seq long")
    result = updates.set_ship_method(small_tables, changes, methods=methods)
    got = {r.o_orderkey: r.o_orderpriority for r in result.updated.collect()}
    old = {r.o_orderkey: r.o_orderpriority for r in orders.collect()}
    assert got == old | {first: "42-NEW"}
    assert [(r.o_orderkey, r.new_value, r.reason) for r in result.rejects.collect()] == [(second, 7, "no_such_method")]
    leaves = result.updated._jdf.queryExecution().optimizedPlan().collectLeaves().toString()
    assert leaves.count("o_orderpriority#") == 1
