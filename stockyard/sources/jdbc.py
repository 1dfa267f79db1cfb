"""S1: read a relational table over JDBC, in parallel.

The original client opens one JDBC connection and pulls rows through one
cursor. Spark's JDBC source instead splits a numeric (or date) column into
``num_partitions`` ranges and reads them on the executors concurrently, one
connection per task; filters and column selections are pushed to the
database (``PushedFilters`` in ``explain``).

Ranges of equal width read unevenly where the keys are uneven. :class:`EvenPartitioning`
cuts at the quantiles of the column instead: the reads are given as ``predicates``, one
connection each, with a value that fills whole reads alone in its own (cut further by a second
column), and the nulls in theirs.

Credentials never appear in code: they come from environment variables (by
default ``STOCKYARD_JDBC_USER`` / ``STOCKYARD_JDBC_PASSWORD``) or from the
caller.

:func:`jdbc_tables` builds a :class:`Tables` whose loaders read each table
over JDBC, so every operation runs unchanged against a database instance (S2).
"""

from __future__ import annotations

import itertools
import os
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import TABLE_NAMES, Tables

USER_ENV = "STOCKYARD_JDBC_USER"
PASSWORD_ENV = "STOCKYARD_JDBC_PASSWORD"
#: Tables that don't grow with the data; only these are read through one connection.
FIXED_TABLES = ("region", "nation")


@dataclass(frozen=True)
class Partitioning:
    """How to split a table into parallel range reads."""

    column: str
    lower_bound: int
    upper_bound: int
    num_partitions: int


@dataclass(frozen=True)
class EvenPartitioning:
    """How to split a table into parallel reads of about equal numbers of rows.

    ``then_by``: an integer column by whose remainders the rows of a frequent value are
    dealt to several reads. ``scan``: how to read the column for its quantiles."""

    column: str
    num_partitions: int
    then_by: str | None = None
    scan: Partitioning | None = None


def _literal(value: object) -> str:
    """A value as it stands in a WHERE clause."""
    if isinstance(value, bool) or value is None:
        raise ValueError(f"no bound: {value!r}")
    if isinstance(value, (int, float, Decimal)):
        return str(value)
    return "'" + str(value).replace("'", "''") + "'"


def quantiles(df: DataFrame, column: str, parts: int, accuracy: int = 10_000) -> list:
    """The ``parts - 1`` values that cut the non-null values of ``column`` into equal shares,
    repeated where one value fills several (one row; approximate, which costs evenness only)."""
    if parts < 1:
        raise ValueError("num_partitions must be at least 1")
    shares = [k / parts for k in range(1, parts)]
    if not shares:
        return []
    found = df.agg(F.percentile_approx(column, shares, accuracy).alias("cuts")).first()["cuts"]
    return list(found or [])


def even_predicates(column: str, cuts: Sequence, then_by: str | None = None) -> list[str]:
    """WHERE clauses that take each row of a table once: between the cuts of
    :func:`quantiles`, a value that fills a share or more by itself (cut by the remainders of
    ``then_by`` into as many reads as it fills), and the nulls."""
    out, below = [], None
    for value, repeats in ((v, len(list(same))) for v, same in itertools.groupby(cuts)):
        after = [f"{column} > {_literal(below)}"] if below is not None else []
        if repeats == 1:
            out.append(" AND ".join([*after, f"{column} <= {_literal(value)}"]))
        else:
            out.append(" AND ".join([*after, f"{column} < {_literal(value)}"]))
            own = f"{column} = {_literal(value)}"
            if then_by is None:
                out.append(own)
            else:
                out += [f"{own} AND MOD(ABS({then_by}), {repeats}) = {k}" for k in range(repeats)]
                out.append(f"{own} AND {then_by} IS NULL")
        below = value
    out.append(f"{column} > {_literal(below)}" if below is not None else f"{column} IS NOT NULL")
    return [*out, f"{column} IS NULL"]


def connection_properties(
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    fetch_size: int = 10_000,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """JDBC properties; user and password default to the environment."""
    props: dict[str, str] = {"fetchsize": str(fetch_size)}
    user = user if user is not None else os.environ.get(USER_ENV)
    password = password if password is not None else os.environ.get(PASSWORD_ENV)
    if user:
        props["user"] = user
    if password:
        props["password"] = password
    if driver:
        props["driver"] = driver
    props.update(extra or {})
    return props


def read_options(
    url: str,
    table: str,
    partitioning: Partitioning | None = None,
    properties: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """The option map of ``spark.read.format('jdbc')`` for one table."""
    if partitioning is not None:
        if partitioning.num_partitions < 1:
            raise ValueError("num_partitions must be at least 1")
        if partitioning.upper_bound < partitioning.lower_bound:
            raise ValueError("upper_bound must not be below lower_bound")
    opts = {"url": url, "dbtable": table, **dict(properties or {})}
    if partitioning is not None:
        opts.update(
            partitionColumn=partitioning.column,
            lowerBound=str(partitioning.lower_bound),
            upperBound=str(partitioning.upper_bound),
            numPartitions=str(partitioning.num_partitions),
        )
    return opts


def read_table(
    spark: SparkSession,
    url: str,
    table: str,
    partitioning: Partitioning | EvenPartitioning | None = None,
    properties: Mapping[str, str] | None = None,
) -> DataFrame:
    """One JDBC table as a DataFrame, read in parallel when ``partitioning`` is set."""
    if isinstance(partitioning, EvenPartitioning):
        how = partitioning
        column = read_table(spark, url, table, how.scan, properties).select(how.column)
        predicates = even_predicates(how.column, quantiles(column, how.column, how.num_partitions), how.then_by)
        return spark.read.jdbc(url, table, predicates=predicates, properties=dict(properties or {}))
    return spark.read.format("jdbc").options(**read_options(url, table, partitioning, properties)).load()


def jdbc_tables(
    spark: SparkSession,
    url: str,
    names: Iterable[str] = TABLE_NAMES,
    partitioning: Mapping[str, Partitioning | EvenPartitioning] | None = None,
    properties: Mapping[str, str] | None = None,
    table_names: Mapping[str, str] | None = None,
) -> Tables:
    """:class:`Tables` read over JDBC; ``table_names`` maps logical -> database names.

    Loading a table that grows without ``partitioning`` for it is refused, since one task
    would read all of it.
    """
    partitioning = dict(partitioning or {})
    table_names = dict(table_names or {})
    props = dict(properties) if properties is not None else connection_properties()

    def load(session: SparkSession, name: str) -> DataFrame:
        if name not in partitioning and name not in FIXED_TABLES:
            raise ValueError(f"{name} grows with the data: give its Partitioning")
        return read_table(session, url, table_names.get(name, name), partitioning.get(name), props)

    return Tables.from_loaders(spark, {n: load for n in names})
