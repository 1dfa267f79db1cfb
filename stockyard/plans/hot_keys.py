"""Selective salting: a join in which only the keys with very many rows are spread.

``hot_keys`` finds them by a frequent-items sketch of the hashed key: each map task
reduces its rows to at most ``TRACKED`` counters, which merge into one row, so a table of any
size costs a scan of its key columns and no shuffle of them. A key is hot if it holds more
rows than a fair partition; at most as many keys as there are partitions can be.

``salted_join`` then deals a hot key's rows on the large side in pieces of a quarter of a
fair partition, and repeats only the hot keys' rows of the other side for each of them. All
other keys join as they are. Hashes that meet only make a key be spread without need.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TRACKED = 10_000
MOST = 1_000  # keys asked of the sketch
PIECES = 4  # pieces a fair partition holds, so that some meeting in one task do no harm
MAX_SALTS = 1_024
_SALT = "_salt"


def _hash(keys: list[str]) -> Column:
    return F.xxhash64(*keys)


def hot_keys(df: DataFrame, keys: list[str]) -> dict[int, int]:
    """{hash of the key: pieces it is to be dealt in}, for keys with more rows than a fair
    partition. Null keys are left out: they join with nothing."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    whole = df.select(*keys).dropna()
    top = F.expr(f"approx_top_k(h, {MOST}, {TRACKED})").alias("top")
    row = whole.select(_hash(keys).alias("h")).agg(F.count(F.lit(1)).alias("rows"), top).first()  # one row
    fair = max(1.0, (row["rows"] or 0) / parts)
    return {r["item"]: min(MAX_SALTS, math.ceil(PIECES * r["count"] / fair)) for r in row["top"] or [] if r["count"] > fair}


def salted_join(large: DataFrame, other: DataFrame, keys: list[str], how: str, hot: dict[int, int]) -> DataFrame:
    """``large.join(other, keys, how)``, ``how`` being inner, left or full, with the ``hot``
    keys of ``large`` spread. ``other`` has one row for each key."""
    if not hot:
        return large.join(other, keys, how)
    spark = large.sparkSession
    table = F.broadcast(spark.createDataFrame(list(hot.items()), "_h bigint, _salts int"))  # at most MOST rows
    salts = F.coalesce("_salts", F.lit(1))
    place = F.pmod(F.monotonically_increasing_id(), salts.cast("bigint")).cast("int")
    spread = large.withColumn("_h", _hash(keys)).join(table, "_h", "left").withColumn(_SALT, place).drop("_h", "_salts")
    copies = other.withColumn("_h", _hash(keys)).join(table, "_h", "left")
    copies = copies.withColumn(_SALT, F.explode(F.sequence(F.lit(0), salts - 1))).withColumn("_copied", salts > 1).drop("_h", "_salts")
    if how != "full":
        return spread.join(copies, [*keys, _SALT], how).drop(_SALT, "_copied")
    # A hot key has rows in ``large``, though perhaps not in every salt: its copies that met
    # none are no misses.
    both = spread.withColumn("_here", F.lit(True)).join(copies, [*keys, _SALT], "full")
    return both.filter(F.col("_here").isNotNull() | ~F.col("_copied")).drop(_SALT, "_copied", "_here")
