"""Numbering, reports, snapshots, JDBC options, streaming, and plan shape."""

import os
import re
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import ROOT, SF_SMALL
from stockyard.functions import report, table_functions
from stockyard.operators import cross_territory, ranking, sales, updates
from stockyard.operators.changeset import apply_changes
from stockyard.plans.numbering import number_rows
from stockyard.plans.snapshots import SnapshotStore
from stockyard.plans.versioned import adjust_stock_once, commit_changes
from stockyard.sources import fixture, jdbc
from stockyard.sources.tables import Tables
from stockyard.streaming.change_feed import start_change_feed


def _scratch():
    return tempfile.mkdtemp(prefix="stockyard-test-")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# -- S5 numbering ---------------------------------------------------------


@pytest.mark.parametrize("parts", [None, 1, 7])
def test_distributed_numbering_equals_row_number(spark, small_tables, parts):
    rows = small_tables["orders"].select("o_orderkey", "o_custkey", "o_orderpriority")
    order = ["o_orderpriority", "o_custkey", "o_orderkey"]
    got = number_rows(rows, order, num_partitions=parts).select("o_orderkey", "n")
    want = rows.withColumn("n", F.row_number().over(Window.orderBy(*order))).select(
        "o_orderkey", "n"
    )
    assert got.count() == rows.count()
    assert got.exceptAll(want).count() == 0
    assert want.exceptAll(got).count() == 0


def test_distributed_numbering_has_no_global_window_over_data(spark, small_tables):
    rows = small_tables["orders"].select("o_orderkey")
    numbered = number_rows(rows, ["o_orderkey"], num_partitions=4)
    plan = _plan(numbered)
    # the only window is over the per-partition counts, behind a broadcast
    assert "BroadcastExchange" in plan or "BroadcastHashJoin" in plan
    assert "SinglePartition" not in plan.split("BroadcastExchange")[0]


# -- S6 text ----------------------------------------------------------------


def test_report_layouts(spark, small_tables):
    line = report.sales_report(small_tables, 7).orderBy("n").first().line
    assert re.fullmatch(r"1 Total Ventas:\d+\.\d{4} Territorio:\S+ IDTerritorio:\d+", line)
    line = report.top_product_report(small_tables).orderBy("n").first().line
    assert re.fullmatch(r"1 Producto:.+ Solicitudes:\d+ Region:AMERICA", line)
    first = report.cross_territory_report(small_tables).orderBy("n").first().line
    assert re.fullmatch(r"1 ID: \d+ TeritorioPedido:\S+ TerritorioMandado:\S+", first)


def test_write_report_text(spark, small_tables):
    out = os.path.join(_scratch(), "report")
    lines = report.sales_report(small_tables, 7)
    report.write_report(lines, out)
    text = spark.read.text(out).collect()
    assert [r.value for r in text] == [r.line for r in lines.orderBy("n").collect()]


def test_null_prints_as_null(spark):
    df = spark.createDataFrame([(None, "a", 1)], "a string, b string, c int")
    got = report.as_strings(df, ["a", "b", "c"]).first()
    assert tuple(got) == ("null", "a", "1")


# -- S3 table functions -------------------------------------------------------


def test_table_functions_match_dataframe_operations(spark, small_tables):
    table_functions.register(small_tables)
    pairs = [
        (table_functions.call(spark, "sales_by_territory", 7), sales.sales_by_territory(small_tables, 7)),
        (table_functions.call(spark, "top_requested_product", "AMERICA"),
         ranking.top_requested_product(small_tables)),
        (table_functions.call(spark, "cross_territory_customers"),
         cross_territory.cross_territory(small_tables)),
    ]
    for sql_df, df in pairs:
        assert sql_df.columns == df.columns
        assert sql_df.exceptAll(df).count() == 0 and df.exceptAll(sql_df).count() == 0


def test_table_function_bodies_have_the_operator_plan_shape(spark, small_tables):
    """No window in U2's body (ties kept by an equality match on a one-row best);
    dimension broadcast hints only when the dimension check passed."""
    table_functions.register(small_tables)
    plan = _plan(table_functions.call(spark, "top_requested_product", "AMERICA"))
    assert "Window" not in plan
    for ddl in table_functions.FUNCTIONS.values():
        unchecked = table_functions.with_dimension_hints(ddl, False)
        assert "DIMS" not in unchecked and "BROADCAST(n)" not in unchecked
        assert "DIMS" not in table_functions.with_dimension_hints(ddl, True)
    assert "BROADCAST(no, ns)" in table_functions.with_dimension_hints(
        table_functions.FUNCTIONS["cross_territory_customers"], True
    )


# -- snapshots, observation --------------------------------------------


def test_snapshot_versions_and_entries(spark, small_tables):
    store = SnapshotStore(spark, _scratch() + "/inventory", partition_by=["location_id"])
    inv = fixture.inventory(small_tables)
    first = store.initialize(inv)
    assert first.version == 1 and first.rows_written == inv.count()

    c = adjust_stock_once(store, small_tables, 7, 8, adjustment_id="adj-1")
    assert c.version == 2 and not c.skipped
    assert c.rows_matched == 5  # sf0.001, category 7 at location 8
    again = adjust_stock_once(store, small_tables, 7, 8, adjustment_id="adj-1")
    assert again.skipped and store.current_version() == 2

    v1 = store.read(1)
    v2 = store.read()
    assert v1.count() == v2.count()
    changed = v2.exceptAll(v1.select(*v2.columns))
    assert changed.count() == 5
    assert store.has_entry("adj-1") and not store.has_entry("adj-2")


def test_commit_skips_orphan_folder_of_failed_commit(spark):
    store = SnapshotStore(spark, _scratch() + "/t")
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    store.initialize(df)
    # A commit that died before Spark's writer had left its marker.
    spark.createDataFrame([(9, "orphan")], "k bigint, v string").write.parquet(store.version_path(2))
    os.remove(store.version_path(2) + "/_SUCCESS")
    assert store.current_version() == 1
    c = store.commit(df, "x", hit_column=None)
    assert c.version == 3 and store.current_version() == 3
    assert [tuple(r) for r in store.read().collect()] == [(1, "a")]


def test_commit_fails_when_another_writer_committed(spark):
    from stockyard.plans.snapshots import ConcurrentCommitError

    store = SnapshotStore(spark, _scratch() + "/t")
    df = spark.createDataFrame([(1, "a")], "k bigint, v string")
    store.initialize(df)
    other = SnapshotStore(spark, store.root)
    named = store.version_path

    def name_after_other_commit(version, entry_id=None):
        # The other writer commits version 2 just after this one has looked for the
        # current version.
        store.version_path = named
        other.commit(df, "other", hit_column=None, entry_id="o")
        return f"{store.root}/v{version:08d}"

    store.version_path = name_after_other_commit
    with pytest.raises(ConcurrentCommitError):
        store.commit(df, "x", hit_column=None)
    assert store.current_version() == 2 and store.has_entry("o")  # the other writer's version stands
    assert store.commit(df, "x", hit_column=None, expected_version=2).version == 3


def test_commit_changes_counts_by_observation(spark, small_tables):
    store = SnapshotStore(spark, _scratch() + "/emails")
    store.initialize(fixture.person_email(small_tables))
    changes = fixture.email_changes(small_tables)
    c, result = commit_changes(store, changes, ["person_id"], "email", "set_email", entry_id="e1")
    assert c.rows_matched == result.outcome.first().rows_matched
    assert c.rows_written == 150
    c2, _ = commit_changes(store, changes, ["person_id"], "email", "set_email", entry_id="e1")
    assert c2.skipped and store.current_version() == 2


# -- streaming change feed -----------------------------------------------------


def test_change_feed_applies_each_batch_once(spark, small_tables):
    base_dir = _scratch()
    store = SnapshotStore(spark, base_dir + "/orders")
    store.initialize(small_tables["orders"])
    src = base_dir + "/changes"
    changes = fixture.ship_method_changes(small_tables)
    schema = changes.schema
    # two arrivals of change files, each derived from the events table
    changes.filter(F.col("seq") % 2 == 0).write.parquet(src + "/a")
    changes.filter(F.col("seq") % 2 == 1).write.parquet(src + "/b")

    def prepare(base, batch):
        t = small_tables.with_table("orders", base.select(*small_tables["orders"].columns))
        return updates.set_ship_method(t, batch)

    query = start_change_feed(
        spark,
        src + "/*",
        schema,
        store,
        keys=["o_orderkey"],
        column="o_orderpriority",
        checkpoint_location=base_dir + "/ckpt",
        name="ship_methods",
        op="set_ship_method",
        rejects_path=base_dir + "/rejects",
        max_files_per_trigger=1,
        available_now=True,
        prepare=prepare,
    )
    query.awaitTermination(180)
    assert query.exception() is None
    batch_result = updates.set_ship_method(small_tables).updated
    final = store.read()
    assert final.count() == batch_result.count()
    assert final.exceptAll(batch_result.select(*final.columns)).count() == 0
    rejects = spark.read.parquet(base_dir + "/rejects")
    assert rejects.count() == updates.set_ship_method(small_tables).rejects.count()


def test_change_feed_keeps_latest_seq_across_batches(spark, small_tables):
    """The newer half of the email changes arrives first, the older half in a
    later file: with an applied-seq column the result equals applying all
    changes at once (latest (ts, event_id) wins), whatever the arrival order."""
    from stockyard.streaming.change_feed import with_seq_column

    base_dir = _scratch()
    changes = fixture.email_changes(small_tables)
    seq_type = changes.schema["seq"].dataType
    emails = fixture.person_email(small_tables)
    store = SnapshotStore(spark, base_dir + "/emails")
    store.initialize(with_seq_column(emails, seq_type))
    src = base_dir + "/changes"
    middle = changes.agg(F.percentile_approx("seq.ts", 0.5)).first()[0]
    changes.filter(F.col("seq.ts") >= middle).coalesce(1).write.parquet(src + "/a")
    changes.filter(F.col("seq.ts") < middle).coalesce(1).write.parquet(src + "/b")

    query = start_change_feed(
        spark,
        src + "/*",
        changes.schema,
        store,
        keys=["person_id"],
        column="email",
        checkpoint_location=base_dir + "/ckpt",
        name="emails",
        op="set_email",
        max_files_per_trigger=1,
        available_now=True,
        seq_column="_seq",
    )
    query.awaitTermination(180)
    assert query.exception() is None
    assert store.current_version() == 3  # initial + one commit per file
    want = apply_changes(emails, changes, ["person_id"], "email").updated
    final = store.read().drop("_seq")
    assert final.count() == want.count()
    assert final.exceptAll(want).count() == 0


# -- JDBC (option building only: no database is started here) -----------------


def test_jdbc_options_and_credentials(monkeypatch):
    monkeypatch.setenv(jdbc.USER_ENV, "reader")
    monkeypatch.setenv(jdbc.PASSWORD_ENV, "secret")
    props = jdbc.connection_properties(driver="org.example.Driver")
    assert props["user"] == "reader" and props["password"] == "secret"
    opts = jdbc.read_options(
        "jdbc:example://db", "customer", jdbc.Partitioning("c_custkey", 0, 15000, 8), props
    )
    assert opts["partitionColumn"] == "c_custkey"
    assert opts["numPartitions"] == "8"
    assert opts["lowerBound"] == "0" and opts["upperBound"] == "15000"
    with pytest.raises(ValueError):
        jdbc.read_options("u", "t", jdbc.Partitioning("c", 10, 0, 2))


# -- plan shape ------------------------------------------------------------------


def test_top_product_plan_has_no_single_task_step(spark, small_tables):
    """U2 keeps ties without a window: the per-group best is a broadcast aggregate."""
    for per in ("region", "territory"):
        plan = _plan(ranking.top_requested_product(small_tables, per=per))
        assert "Window" not in plan
        assert "SinglePartition" not in plan
        assert "LeftSemi" in plan


def test_top_product_best_not_hinted_when_dimension_unchecked(spark):
    """The per-group best is broadcast by hint only behind the territory size
    check; when that check fails the planner decides, with the same result."""
    checked = Tables.from_parquet(spark, SF_SMALL)
    unchecked = Tables.from_parquet(spark, SF_SMALL)
    unchecked.bounded_cache["territory"] = False
    for per in ("region", "territory"):
        want = sorted(map(tuple, ranking.top_requested_product(checked, per=per).collect()))
        got = sorted(map(tuple, ranking.top_requested_product(unchecked, per=per).collect()))
        assert got == want


def test_scans_are_pruned_and_filters_pushed(spark, small_tables):
    df = sales.sales_by_territory(small_tables, 7)
    plan = _plan(df)
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint,l_extendedprice:double,l_discount:double>" in plan
    assert "PushedFilters: [IsNotNull(p_brand)" in plan


def test_no_driver_collect_in_library():
    pattern = re.compile(r"\.(collect|toPandas|toLocalIterator|toArrow)\(")
    offenders = []
    for dirpath, dirs, files in os.walk(os.path.join(ROOT, "stockyard")):
        # The corpus operators collect tables of stated bounds (models, filters).
        dirs[:] = [d for d in dirs if d != "llm"]
        for f in files:
            if f.endswith(".py"):
                text = open(os.path.join(dirpath, f)).read()
                if pattern.search(text):
                    offenders.append(f)
    assert offenders == []


def test_jdbc_refuses_a_growing_table_without_partitioning(spark, monkeypatch):
    read = []
    monkeypatch.setattr(jdbc, "read_table", lambda s, url, table, partitioning, props: read.append((table, partitioning)) or s.range(1))
    ranges = jdbc.Partitioning("o_orderkey", 0, 1000, 8)
    t = jdbc.jdbc_tables(spark, "jdbc:example://db", partitioning={"orders": ranges}, properties={})
    t["nation"], t["orders"]
    with pytest.raises(ValueError, match="lineitem"):
        t["lineitem"]
    assert read == [("nation", None), ("orders", ranges)]


def test_parquet_tables_load_at_every_size(spark):
    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"):
        t = Tables.from_parquet(spark, sf)
        assert t["nation"].count() == 25


# -- command line --------------------------------------------------------------


def test_cli_report_and_retry_safe_update(spark, capsys):
    from stockyard.__main__ import main

    root = _scratch()
    assert main(["--local", "2", "--data", SF_SMALL, "sales", "--category", "7", "--out", root + "/r"]) == 0
    lines = [r.value for r in spark.read.text(root + "/r").collect()]
    assert lines[0].startswith("1 Total Ventas:") and len(lines) == 25
    args = ["--local", "2", "--data", SF_SMALL, "set-email", "--store", root + "/em", "--entry-id", "e1"]
    assert main(args) == 0
    assert main(args) == 0
    out = capsys.readouterr().out
    assert "version 2" in out and "skipped (already applied)" in out
    assert SnapshotStore(spark, root + "/em").current_version() == 2
