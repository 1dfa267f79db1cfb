"""Plans and choices that hold at scale: bucketed joins, sets as bits, folded branches, even
reads, numbering by the checked bound."""

from __future__ import annotations

import os
import uuid

import pytest
from pyspark.sql import functions as F

from stockyard import __main__ as cli
from stockyard.functions import report, table_functions
from stockyard.operators import cross_territory, ranking, sales
from stockyard.plans import numbering
from stockyard.plans.scratch import Scratch
from stockyard.sources import bucketed, fixture, jdbc
from stockyard.sources.tables import Tables

from conftest import SF_SMALL, make_tables


def same(a, b):
    return a.columns == b.columns and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below(plan: str, marker: str) -> list[str]:
    """The lines of the subtree under the first line with ``marker`` (deeper indentation)."""
    lines = plan.splitlines()
    at = next(k for k, x in enumerate(lines) if marker in x)
    depth = len(lines[at]) - len(lines[at].lstrip(" :+-"))
    out = []
    for x in lines[at + 1 :]:
        if len(x) - len(x.lstrip(" :+-")) <= depth:
            break
        out.append(x)
    return out


@pytest.fixture
def settings(spark):
    before = {}

    def put(**values):
        for k, v in values.items():
            key = "spark.sql." + k.replace("__", ".")
            before.setdefault(key, spark.conf.get(key))
            spark.conf.set(key, v)

    yield put
    for k, v in before.items():
        spark.conf.set(k, v)


# -- bucketed lines and orders -----------------------------------------------------


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    return bucketed.store_bucketed(Tables.from_parquet(spark, SF_SMALL), str(tmp_path_factory.mktemp("b")), buckets=8)


def test_lines_meet_orders_without_an_exchange(spark, stored, small_tables, settings):
    # The dimensions' sides are broadcast, lines and orders are not.
    settings(autoBroadcastJoinThreshold="8000", adaptive__enabled="false")
    for t, exchanged in ((stored, False), (small_tables, True)):
        orders = t["orders"].select("o_orderkey", "o_custkey")
        joined = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n")).join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        assert ("Exchange" in plan_of(joined)) == exchanged
    for build in (lambda t: sales.category_sales_by_nation(t, 7), lambda t: cross_territory.cross_territory_keys(t, "order")):
        tree = below(plan_of(build(stored)), "SortMergeJoin")
        assert tree and not any("Exchange hash" in x for x in tree)
        assert any("Exchange hash" in x for x in below(plan_of(build(small_tables)), "SortMergeJoin"))
    # U2: the lines stay where they are; the orders of the region are no larger than their table.
    lines = [x for x in plan_of(ranking.requests_per_product(stored)).splitlines() if "Exchange hashpartitioning(l_orderkey" in x]
    assert not lines


def test_bucketed_results_are_the_same(spark, stored, small_tables):
    assert stored["lineitem"].count() == small_tables["lineitem"].count()
    assert same(sales.sales_by_territory(stored, 7), sales.sales_by_territory(small_tables, 7))
    assert same(ranking.top_requested_product(stored), ranking.top_requested_product(small_tables))
    assert same(cross_territory.cross_territory(stored), cross_territory.cross_territory(small_tables))


def test_a_hot_order_is_not_put_in_one_bucket(spark, small_tables, tmp_path):
    lines = small_tables["lineitem"]
    hot = lines.unionByName(lines.withColumn("l_orderkey", F.lit(1).cast("bigint")))
    t = small_tables.with_table("lineitem", hot)
    assert bucketed.store_bucketed(t, str(tmp_path), buckets=8) is t and not os.listdir(tmp_path)


# -- sets of territories as bits ----------------------------------------------------


def test_sets_are_hash_aggregates_and_orders_are_not_shuffled_twice(spark, small_tables, settings):
    settings(autoBroadcastJoinThreshold="-1", adaptive__enabled="false")
    plan = plan_of(cross_territory.cross_territory(small_tables, "order"))
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan and "collect_set" not in plan
    # lines by supplier, supplier, lines by order, orders and customers by customer, orders by order
    assert plan.count("Exchange hashpartitioning") == 6
    assert plan_of(cross_territory.cross_territory(small_tables)).count("Exchange hashpartitioning") == 7


@pytest.mark.parametrize("far, words", [(63, 1), (64, 2), (300, 5), (512, None), (-4, None)])
def test_territory_keys_of_any_size(spark, far, words):
    """A key at the border of a word or beyond all of them; null nations count as none."""
    t = make_tables(
        spark,
        region=[(0, "AMERICA")],
        nation=[(0, "A", 0), (5, "B", 0), (far, "FAR", 0)],
        customer=[(1, "c1", 0, 0.0, "m"), (2, "c2", far, 0.0, "m"), (3, "c3", None, 0.0, "m")],
        supplier=[(1, "s1", 0, 0.0), (2, "s2", far, 0.0), (3, "s3", 5, 0.0), (4, "s4", None, 0.0), (5, "s5", 900, 0.0)],
        orders=[(10, 1, "O", 1.0, None, "1-U"), (11, 2, "O", 1.0, None, "1-U"), (12, 3, "O", 1.0, None, "1-U"), (13, 1, "O", 1.0, None, "1-U")],
        lineitem=[(o, 1, s, k, 1.0, 1.0, 0.0, 0.0, "N", "O", None) for o in (10, 11, 12) for k, s in enumerate((1, 2, 2, 3, 4, 5))],
    )
    assert fixture.territory_words(t) == words
    want = {(10, "A", "FAR"), (10, "A", "B"), (11, "FAR", "A"), (11, "FAR", "B")}
    got = cross_territory.cross_territory(t, "order").collect()
    assert {tuple(r) for r in got} == want and len(got) == len(want)
    table_functions.register(t, "keys_")
    assert {tuple(r) for r in table_functions.call(spark, "cross_territory", "order", prefix="keys_").collect()} == want
    assert {r.id for r in cross_territory.cross_territory(t).collect()} == {1, 2}


# -- table functions with optional arguments -----------------------------------------


def test_table_function_arguments(spark, small_tables):
    table_functions.register(small_tables, "args_")
    call = lambda name, *args: table_functions.call(spark, name, *args, prefix="args_")
    for measure in ranking.MEASURES:
        for per in ranking.GRAINS:
            got = call("top_requested_product", "AMERICA", measure, per)
            assert same(got, ranking.top_requested_product(small_tables, "AMERICA", measure, per))
    assert same(call("top_requested_product", "ASIA"), ranking.top_requested_product(small_tables, "ASIA"))
    assert same(call("cross_territory"), call("cross_territory_customers"))
    assert same(call("cross_territory", "order"), cross_territory.cross_territory(small_tables, "order"))
    named = spark.sql("SELECT * FROM args_top_requested_product('AMERICA', per => 'territory')")
    assert same(named, ranking.top_requested_product(small_tables, per="territory"))


def test_only_the_branch_asked_for_is_planned(spark, small_tables):
    table_functions.register(small_tables, "fold_")
    call = lambda name, *args: table_functions.call(spark, name, *args, prefix="fold_")
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    for measure, own, others in (("lines", "count(1)", ("sum(", "distinct")), ("units", "sum(", ("count(1)", "distinct"))):
        text = plan(call("top_requested_product", "AMERICA", measure))
        assert own in text and not any(x in text for x in others) and "CASE WHEN" not in text and "raise_error" not in text
        assert "l_quantity" in text if measure == "units" else "l_quantity" not in plan_scans(call("top_requested_product", "AMERICA", measure))
    assert "raise_error" not in plan(call("cross_territory", "order"))


def plan_scans(df):
    return "\n".join(x for x in plan_of(df).splitlines() if "ReadSchema" in x)


@pytest.mark.parametrize("args, said", [(("AMERICA", "weight"), "measure must be"), (("AMERICA", "lines", "planet"), "per must be")])
def test_unknown_arguments_are_refused(spark, small_tables, args, said):
    table_functions.register(small_tables, "bad_")
    with pytest.raises(Exception, match=said):
        table_functions.call(spark, "top_requested_product", *args, prefix="bad_").collect()


# -- even JDBC reads ------------------------------------------------------------------


def test_predicates_take_each_row_once_in_even_reads(spark):
    """A column with a value in a third of all rows, a long tail and nulls."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None).otherwise((F.col("id") * F.col("id")) % 100_003).alias("k"), F.col("id").alias("own")
    ).cache()
    cuts = jdbc.quantiles(rows, "k", 12)
    assert len(cuts) == 11 and cuts == sorted(cuts) and cuts.count(7) >= 3
    predicates = jdbc.even_predicates("k", cuts, then_by="own")
    sizes = [rows.filter(p).count() for p in predicates]
    assert sum(sizes) == 12_000
    assert rows.filter(" + ".join(f"CAST(coalesce({p}, false) AS INT)" for p in predicates) + " <> 1").count() == 0
    assert max(sizes) <= 1.6 * 12_000 / 12
    whole = jdbc.even_predicates("k", cuts)  # without a second column the frequent value is one read
    assert sum(rows.filter(p).count() for p in whole) == 12_000 and "k = 7" in whole
    # Reads of equal width, for comparison: nearly all rows are in one of them or the other.
    assert rows.filter("k < 100003 / 12 or k is null").count() > 0.35 * 12_000


def test_predicates_of_odd_columns(spark):
    rows = lambda kind: spark.createDataFrame([], f"k {kind}")
    assert jdbc.even_predicates("k", jdbc.quantiles(rows("bigint"), "k", 4)) == ["k IS NOT NULL", "k IS NULL"]
    assert jdbc.quantiles(spark.range(9), "id", 1) == []
    one = jdbc.even_predicates("k", [5, 5, 5])
    assert one == ["k < 5", "k = 5", "k > 5", "k IS NULL"]
    import datetime

    days = jdbc.even_predicates("d", [datetime.date(2024, 1, 2)])
    assert days == ["d <= '2024-01-02'", "d > '2024-01-02'", "d IS NULL"]
    assert jdbc.even_predicates("s", ["it's"])[0] == "s <= 'it''s'"
    with pytest.raises(ValueError):
        jdbc.quantiles(rows("bigint"), "k", 0)


def test_even_partitioning_reads_by_predicates(spark, monkeypatch):
    """No database: the reader is replaced, and what it is asked for is looked at."""
    asked = []

    class Reader:
        def jdbc(self, url, table, predicates, properties):
            asked.append((url, table, predicates))
            return spark.range(1)

    class Session:
        read = Reader()

    monkeypatch.setattr(jdbc, "quantiles", lambda df, column, parts: [10, 10, 20])
    whole = jdbc.read_table
    monkeypatch.setattr(jdbc, "read_table", lambda s, url, table, how=None, props=None: spark.range(5).withColumnRenamed("id", "k") if how is None else whole(s, url, table, how, props))
    jdbc.read_table(Session(), "jdbc:x", "t", jdbc.EvenPartitioning("k", 4, "z"), {})
    (url, table, predicates) = asked[0]
    assert (url, table) == ("jdbc:x", "t") and predicates[0] == "k < 10" and predicates[-1] == "k IS NULL" and len(predicates) == 7


def test_the_command_line_takes_a_database_instance(spark, monkeypatch):
    asked = {}
    monkeypatch.setattr(jdbc, "jdbc_tables", lambda s, url, partitioning, properties: asked.update(url=url, partitioning=partitioning) or Tables.from_parquet(s, SF_SMALL))
    args = ["--jdbc", "jdbc:example://db", "--jdbc-split", "lineitem:l_orderkey:64:l_linenumber", "--jdbc-split", "orders:o_orderkey:16"]
    assert cli.main(["--local", "2", *args, "sales", "--category", "7"]) == 0
    assert asked == {
        "url": "jdbc:example://db",
        "partitioning": {"lineitem": jdbc.EvenPartitioning("l_orderkey", 64, "l_linenumber"), "orders": jdbc.EvenPartitioning("o_orderkey", 16)},
    }
    with pytest.raises(SystemExit):
        cli.main(["--local", "2", "sales", "--category", "7"])


def test_the_command_line_prints_the_stock_outcome(spark, capsys, tmp_path):
    args = ["--local", "2", "--data", SF_SMALL, "adjust-stock", "--category", "7", "--location", "8", "--store", str(tmp_path / uuid.uuid4().hex), "--adjustment-id", "a"]
    assert cli.main(args) == 0
    said = capsys.readouterr().out
    assert "op=adjust_stock, changes=1, applied=1, superseded=0, rejected=0, rows_matched=" in said


# -- numbering by the checked bound -----------------------------------------------------


def test_numbering_follows_the_territory_check(spark, monkeypatch):
    t = Tables.from_parquet(spark, SF_SMALL)
    small = report.sales_report(t, 7)
    assert "Window" in plan_of(small)
    used = []
    whole = numbering.number_rows
    monkeypatch.setattr(numbering, "number_rows", lambda *a, **k: used.append(1) or whole(*a, **k))
    large = Tables.from_parquet(spark, SF_SMALL)
    large.bounded_cache["territory"] = False  # as if the dimension were too large
    with Scratch(spark) as scratch:
        lines = report.sales_report(large, 7, scratch)
        assert used and same(lines, small)
        folders = [p.removeprefix("file:") for p in scratch.paths]
        assert len(folders) == 1 and os.path.exists(folders[0])
    assert not os.path.exists(folders[0])


def test_a_written_report_leaves_nothing_behind(spark, small_tables, tmp_path):
    scratch = Scratch(spark)
    lines = report.cross_territory_report(small_tables, "customer", scratch)
    folder = scratch.paths[0].removeprefix("file:")
    assert os.path.exists(folder)
    report.write_report(lines, str(tmp_path / "r"), scratch=scratch)
    assert not os.path.exists(folder) and spark.read.text(str(tmp_path / "r")).count() > 0
