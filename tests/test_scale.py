"""The plans a large cluster would run: no statistics-based broadcast, a hot key.

At 100 TB no growing table fits under the broadcast threshold, so every join
of two growing tables is a sort-merge join. These tests switch the threshold
off, so the small test data takes those same plans, and compare with DuckDB.
A second fixture gives one customer a third of all orders and forces AQE's
skew handling on, to check the hot partition is split and results stay right.
"""

import re
import tempfile

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_module
from conftest import SF_SMALL
from stockyard.operators import cross_territory, sales
from stockyard.sources.tables import Tables

LARGE_PLAN_QUERIES = [
    "sales_by_territory",
    "top_product_lines",
    "top_product_by_territory",
    "cross_territory_customers",
    "stock_adjusted",
    "order_quantity_updated",
    "ship_method_updated",
    "email_updated",
    "update_outcomes",
    "cross_territory_report_lines",
    "sales_table_function",
    "top_product_table_function",
    "cross_territory_table_function",
]

TABLES = "region nation customer supplier part orders lineitem events".split()


def _duck(root):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet/*.parquet')"
                    if not root.startswith("/root/testdata")
                    else f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{root}/{t}.parquet')")
    return con


def _same(spark_df, duck_df):
    cols = sorted(spark_df.columns)
    got = spark_df[cols].astype(str).values.tolist()
    want = duck_df[cols].astype(str).values.tolist()
    return sorted(map(tuple, got)) == sorted(map(tuple, want))


@pytest.fixture()
def no_auto_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


@pytest.mark.parametrize("name", LARGE_PLAN_QUERIES)
def test_sort_merge_plans_match_oracle(spark, no_auto_broadcast, name):
    # a fresh session-level catalog: the registry caches per (session, folder)
    df = entry_module.queries()[name](spark, SF_SMALL)
    con = _duck(SF_SMALL)
    assert _same(df.toPandas(), con.execute(entry_module.oracle_sql()[name]).df())


def test_growing_tables_are_not_broadcast_without_statistics(spark, no_auto_broadcast):
    t = Tables.from_parquet(spark, SF_SMALL)
    df = sales.sales_by_territory(t, 7)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan
    # the only broadcasts are the checked dimensions (nation, region)
    for scan in ("orders.parquet", "customer.parquet", "lineitem.parquet"):
        for part in plan.split("BroadcastExchange")[1:]:
            head = part.split("Exchange")[0]
            assert scan not in head


@pytest.fixture(scope="module")
def skewed_root(spark):
    """sf0.01 tables with one customer owning every third order."""
    root = tempfile.mkdtemp(prefix="stockyard-skew-")
    src = Tables.from_parquet(spark, "/root/testdata/sf0.01")
    for name in TABLES:
        df = src[name]
        if name == "orders":
            df = df.withColumn(
                "o_custkey",
                F.when(F.col("o_orderkey") % 3 == 0, F.lit(7).cast("bigint")).otherwise(
                    F.col("o_custkey")
                ),
            )
        df.repartition(8).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture()
def forced_skew_handling(spark):
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


def test_hot_customer_is_split_and_results_exact(spark, skewed_root, forced_skew_handling):
    t = Tables.from_parquet(spark, skewed_root)
    con = _duck(skewed_root)
    df = cross_territory.cross_territory(t, "customer")
    got = df.toPandas()
    want = con.execute(entry_module.oracle_sql()["cross_territory_customers"]).df()
    assert _same(got, want)
    final_plan = df._jdf.queryExecution().executedPlan().toString()
    assert "skew=true" in final_plan

    u1 = sales.sales_by_territory(t, 7).toPandas()
    want_u1 = con.execute(entry_module.oracle_sql()["sales_by_territory"]).df()
    assert _same(u1, want_u1)


def test_category_filter_prunes_lineitem_before_shuffle(spark):
    """With the cluster settings, U1's category filter on `part` becomes a
    runtime Bloom filter on `lineitem` (the scan-size floor is lowered here so
    the small test data qualifies as it would at scale)."""
    from stockyard.session import cluster_conf

    conf = cluster_conf(1 << 30)
    keys = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": conf[
            "spark.sql.optimizer.runtime.bloomFilter.enabled"
        ],
        "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": conf[
            "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold"
        ],
        "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1k",
    }
    old = {k: spark.conf.get(k, None) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    try:
        t = Tables.from_parquet(spark, SF_SMALL)
        df = sales.sales_by_territory(t, 7)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "might_contain" in plan and "xxhash64(l_partkey" in plan
        con = _duck(SF_SMALL)
        assert _same(df.toPandas(), con.execute(entry_module.oracle_sql()["sales_by_territory"]).df())
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


@pytest.fixture(scope="module")
def hot_order_root(spark):
    """sf0.01 tables with one order holding every third line."""
    root = tempfile.mkdtemp(prefix="stockyard-hot-order-")
    src = Tables.from_parquet(spark, "/root/testdata/sf0.01")
    hot = src["orders"].agg(F.min("o_orderkey")).first()[0]
    for name in TABLES:
        df = src[name]
        if name == "lineitem":
            df = df.withColumn(
                "l_orderkey",
                F.when(
                    (F.col("l_orderkey") + F.col("l_linenumber")) % 3 == 0, F.lit(hot).cast("bigint")
                ).otherwise(F.col("l_orderkey")),
            )
        df.repartition(8).write.parquet(f"{root}/{name}.parquet")
    return root


def test_hot_order_collapses_before_shuffle_and_results_exact(spark, hot_order_root, no_auto_broadcast):
    """U4 reduces lines to one row per order map-side, so the order holding a
    third of all lines crosses the shuffle as one row per map task."""
    t = Tables.from_parquet(spark, hot_order_root)
    con = _duck(hot_order_root)
    for grain, key in (("customer", "cross_territory_customers"), ("order", "cross_territory_orders")):
        df = cross_territory.cross_territory(t, grain)
        assert _same(df.toPandas(), con.execute(entry_module.oracle_sql()[key]).df())
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the partial set aggregation sits below the exchange on the order key
    below = plan.split("Exchange hashpartitioning(order_id")[1]
    assert "partial_bit_or" in below.split("Exchange")[0]

    u1 = sales.sales_by_territory(t, 7).toPandas()
    assert _same(u1, con.execute(entry_module.oracle_sql()["sales_by_territory"]).df())


@pytest.fixture(scope="module")
def hot_supplier_root(spark):
    """sf0.01 tables with one supplier on every third line."""
    root = tempfile.mkdtemp(prefix="stockyard-hot-supplier-")
    src = Tables.from_parquet(spark, "/root/testdata/sf0.01")
    hot = src["supplier"].agg(F.min("s_suppkey")).first()[0]
    for name in TABLES:
        df = src[name]
        if name == "lineitem":
            df = df.withColumn(
                "l_suppkey",
                F.when(F.col("l_partkey") % 3 == 0, F.lit(hot).cast("bigint")).otherwise(
                    F.col("l_suppkey")
                ),
            )
        df.repartition(8).write.parquet(f"{root}/{name}.parquet")
    return root


def test_hot_supplier_is_split_and_results_exact(spark, hot_supplier_root, forced_skew_handling):
    """U3's inventory and U4 join every line to its supplier; with one supplier
    on a third of the lines AQE splits that partition and results stay exact."""
    from stockyard.operators import stock

    t = Tables.from_parquet(spark, hot_supplier_root)
    con = _duck(hot_supplier_root)
    u3 = stock.adjust_stock(t, 7, 8, 5).updated
    assert _same(u3.toPandas(), con.execute(entry_module.oracle_sql()["stock_adjusted"]).df())
    assert "skew=true" in u3._jdf.queryExecution().executedPlan().toString()
    u4 = cross_territory.cross_territory(t, "customer")
    assert _same(u4.toPandas(), con.execute(entry_module.oracle_sql()["cross_territory_customers"]).df())


def test_small_change_set_is_broadcast_and_large_is_sort_merged(spark, no_auto_broadcast):
    """K broadcasts the collapsed changes only behind a bounded count: under the
    bound the base streams through a hash join and is not shuffled; over it the
    join is sort-merge. Both give the same table."""
    from stockyard.operators import updates
    from stockyard.sources import fixture

    t = Tables.from_parquet(spark, SF_SMALL)
    changes = fixture.quantity_changes(t)  # given explicitly: checked per call, not memoised
    small = updates.set_order_quantity(t, changes)
    large = updates.set_order_quantity(t, changes)
    large.broadcast_max_rows = 1  # the change set has more keys than this
    small_plan = small.updated._jdf.queryExecution().executedPlan().toString()
    large_plan = large.updated._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"BroadcastHashJoin[^\n]*LeftOuter", small_plan)
    assert re.search(r"SortMergeJoin[^\n]*LeftOuter", large_plan)
    assert small.updated.exceptAll(large.updated).count() == 0
    assert small.updated.count() == large.updated.count()
