"""Run one of the seven operations as a Spark job.

    python -m stockyard --data DIR sales --category 7 --out /shared/reports/sales
    python -m stockyard --data DIR top-product --measure units --per territory
    python -m stockyard --data DIR cross-territory --grain customer --out PATH
    python -m stockyard --data DIR adjust-stock --category 7 --location 8 \\
        --store /shared/inventory --adjustment-id 2024-06-01-a
    python -m stockyard --data DIR set-quantity --store /shared/lineitem [--changes PATH]
    python -m stockyard --data DIR set-ship-method --store /shared/orders [--changes PATH]
    python -m stockyard --data DIR set-email --store /shared/emails [--changes PATH]

Reports are written as numbered text lines with ``--out`` (or the first
``--show`` lines are printed). Updates read the store's current version (the
store is started from the data folder the first time), write the next version
and print the outcome counts. ``--changes`` is a parquet folder of changes
(keys, new_value, seq); without it the changes are derived from ``events``.
Instead of ``--data DIR``, ``--jdbc URL`` names a database instance (user and password come from
the environment); ``--jdbc-split TABLE:COLUMN:PARTS[:THEN_BY]`` says how a table that grows is
read in parallel, in reads of about equal size.
Use ``spark-submit`` on a cluster, or ``--local N`` for a local session.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from .functions import report
from .operators import stock, updates
from .plans.snapshots import SnapshotStore
from .plans.versioned import adjust_stock_once, commit_changes
from .plans.scratch import Scratch
from .session import BASE_CONF, local_session
from .sources import fixture, jdbc
from .sources.tables import Tables


def _session(args: argparse.Namespace) -> SparkSession:
    if args.local:
        return local_session(cores=args.local, shuffle_partitions=max(8, 2 * int(args.local)))
    builder = SparkSession.builder.appName("stockyard")
    for key, value in BASE_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _instance(spark: SparkSession, args: argparse.Namespace) -> Tables:
    """S2: the tables of the instance that was named."""
    if args.data:
        return Tables.from_parquet(spark, args.data)
    splits = {}
    for said in args.jdbc_split:
        table, column, parts, *then_by = said.split(":")
        splits[table] = jdbc.EvenPartitioning(column, int(parts), then_by[0] if then_by else None)
    return jdbc.jdbc_tables(spark, args.jdbc, partitioning=splits, properties=jdbc.connection_properties(args.jdbc_driver))


def _emit(lines: DataFrame, args: argparse.Namespace, scratch: Scratch) -> None:
    if args.out:
        report.write_report(lines, args.out, mode="overwrite" if args.overwrite else "errorifexists", scratch=scratch)
        print(f"written to {args.out}")
    else:
        rows = lines.orderBy("n").select("line").take(args.show + 1)
        for row in rows[: args.show]:
            print(row.line)
        if len(rows) > args.show:
            print(f"({lines.count() - args.show} more lines not shown; --out writes all)")


def _store(spark: SparkSession, root: str, initial: DataFrame) -> SnapshotStore:
    store = SnapshotStore(spark, root)
    if store.current_version() == 0:
        store.initialize(initial)
    return store


def _changes(spark: SparkSession, args: argparse.Namespace, default: DataFrame) -> DataFrame:
    return spark.read.parquet(args.changes) if args.changes else default


def _print_commit(commit, outcome: DataFrame | None) -> None:
    state = "skipped (already applied)" if commit.skipped else f"version {commit.version}"
    print(f"{commit.op}: {state} at {commit.path}; rows matched {commit.rows_matched}")
    if outcome is not None:
        row = outcome.first()
        print(", ".join(f"{k}={v}" for k, v in row.asDict().items()))


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="stockyard", description=__doc__.split("\n\n")[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--data", help="folder with <table>.parquet")
    source.add_argument("--jdbc", metavar="URL", help="a database instance with the tables")
    parser.add_argument("--jdbc-driver", help="class of the JDBC driver")
    parser.add_argument("--jdbc-split", action="append", default=[], metavar="TABLE:COLUMN:PARTS[:THEN_BY]")
    parser.add_argument("--local", help="run on local[N] instead of the submitted master")
    sub = parser.add_subparsers(dest="op", required=True)

    def with_output(p: argparse.ArgumentParser) -> None:
        p.add_argument("--out", help="write report lines as text here")
        p.add_argument("--overwrite", action="store_true")
        p.add_argument("--show", type=int, default=50, help="lines to print without --out")

    p = sub.add_parser("sales", help="1: total sales of a category per territory")
    p.add_argument("--category", type=int, required=True)
    with_output(p)
    p = sub.add_parser("top-product", help="2: most requested product of a region")
    p.add_argument("--region", default=fixture.NORTH_AMERICA)
    p.add_argument("--measure", default="lines", choices=["lines", "units", "orders"])
    p.add_argument("--per", default="region", choices=["region", "territory"])
    with_output(p)
    p = sub.add_parser("adjust-stock", help="3: change stock of a category at a location")
    p.add_argument("--category", type=int, required=True)
    p.add_argument("--location", type=int, required=True)
    p.add_argument("--pct", default="5", help="percentage, exact to 4 places")
    p.add_argument("--rounding", default="floor", choices=["floor", "ceil", "half_up"])
    p.add_argument("--store", required=True)
    p.add_argument("--adjustment-id", required=True)
    p = sub.add_parser("cross-territory", help="4: customers shipped to another territory")
    p.add_argument("--grain", default="customer", choices=["customer", "order"])
    with_output(p)
    for name, helptext in [
        ("set-quantity", "5: set quantities of products on orders"),
        ("set-ship-method", "6: set shipping methods of orders"),
        ("set-email", "7: set emails of persons"),
    ]:
        p = sub.add_parser(name, help=helptext)
        p.add_argument("--store", required=True)
        p.add_argument("--changes", help="parquet folder of changes")
        p.add_argument("--entry-id", help="apply at most once under this ID")

    args = parser.parse_args(argv)
    spark = _session(args)
    t = _instance(spark, args)

    scratch = Scratch(spark)
    if args.op == "sales":
        _emit(report.sales_report(t, args.category, scratch), args, scratch)
    elif args.op == "top-product":
        _emit(report.top_product_report(t, scratch, region=args.region, measure=args.measure, per=args.per), args, scratch)
    elif args.op == "cross-territory":
        _emit(report.cross_territory_report(t, args.grain, scratch), args, scratch)
    elif args.op == "adjust-stock":
        store = _store(spark, args.store, fixture.inventory(t))
        commit = adjust_stock_once(
            store, t, args.category, args.location, args.adjustment_id, args.pct, args.rounding
        )
        _print_commit(commit, None if commit.skipped else stock.outcome_row(spark, commit.op, commit.rows_matched))
    elif args.op == "set-quantity":
        store = _store(spark, args.store, t["lineitem"])
        changes = _changes(spark, args, fixture.quantity_changes(t))
        commit, result = commit_changes(
            store, changes, updates.ORDER_LINE_KEYS, "l_quantity", "set_order_quantity", args.entry_id
        )
        _print_commit(commit, result.outcome if result else None)
    elif args.op == "set-ship-method":
        store = _store(spark, args.store, t["orders"])
        changes = _changes(spark, args, fixture.ship_method_changes(t))

        def prepare(base: DataFrame, batch: DataFrame):
            return updates.set_ship_method(t.with_table("orders", base), batch)

        commit, result = commit_changes(
            store, changes, updates.ORDER_KEYS, "o_orderpriority", "set_ship_method",
            args.entry_id, prepare,
        )
        _print_commit(commit, result.outcome if result else None)
    elif args.op == "set-email":
        store = _store(spark, args.store, fixture.person_email(t))
        changes = _changes(spark, args, fixture.email_changes(t))
        commit, result = commit_changes(
            store, changes, updates.PERSON_KEYS, "email", "set_email", args.entry_id
        )
        _print_commit(commit, result.outcome if result else None)
    return 0


if __name__ == "__main__":
    sys.exit(main())
