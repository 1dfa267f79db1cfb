"""``lineitem`` and ``orders`` stored bucketed on the order key, so that lines meet orders
without an exchange.

The two tables share their largest join in U1, U2 and U4. Stored once with the same number of
buckets, hashed and sorted on the order key, both sides of that join (and every aggregation
per order) are already where they belong: each task reads one bucket of each table.

:func:`store_bucketed` writes them as external tables below ``folder`` and returns the same
:class:`Tables` reading them through the catalogue, so the operators run as they are.
A bucket is one task and can't be split, so the order keys are first searched for one with more
lines than a fair bucket (a sketch of bounded size, :mod:`..plans.hot_keys`); if there is one,
the tables stay as they are and AQE splits the join instead.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from ..plans.hot_keys import hot_keys
from .tables import Tables

#: The tables and the key they share.
ORDER_KEYS = {"lineitem": "l_orderkey", "orders": "o_orderkey"}


def store_bucketed(
    t: Tables, folder: str, buckets: int | None = None, columns: Mapping[str, Sequence[str]] | None = None, prefix: str | None = None
) -> Tables:
    """``t`` with ``lineitem`` and ``orders`` read from bucketed copies below ``folder``.

    ``buckets``: by default ``spark.sql.shuffle.partitions``; choose it so that a bucket of
    either table fits a task (about 256 MB). ``columns``: those to store of each table (all by
    default). ``prefix`` goes before the catalogue names."""
    spark = t.spark
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    prefix = prefix or f"stockyard_{uuid.uuid4().hex}_"
    if any(hot_keys(t[name], [key]) for name, key in ORDER_KEYS.items()):
        return t
    out = t
    for name, key in ORDER_KEYS.items():
        rows = t[name].select(*columns[name]) if columns and name in columns else t[name]
        # Dealt by the same hash first, so each bucket is one file.
        dealt = rows.repartition(buckets, key).sortWithinPartitions(key)
        dealt.write.bucketBy(buckets, key).sortBy(key).option("path", f"{folder.rstrip('/')}/{name}").saveAsTable(prefix + name)
        out = out.with_table(name, spark.table(prefix + name))
    return out
