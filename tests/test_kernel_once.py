"""K: one collapse for all parts of an update, counts from the write, salted hot base keys."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from stockyard.operators import changeset, updates
from stockyard.operators.changeset import apply_changes
from stockyard.plans import hot_keys
from stockyard.plans.scratch import Scratch
from stockyard.sources import fixture

KEYS = ["k"]


def base_of(spark, n=3000, parts=8):
    """One key has a third of all rows."""
    k = F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id"))
    return spark.range(0, n, 1, parts).select(k.cast("bigint").alias("k"), F.lit("old").alias("v"), F.col("id").alias("x"))


def changes_of(spark, rows):
    return spark.createDataFrame(rows, "k bigint, new_value string, seq bigint")


ROWS = [(1, "a", 1), (1, "b", 2), (2, "c", 1), (5, None, 1), (None, "d", 1), (99_999, "e", 1), (99_999, "f", 2), (4, "g", 1), (4, "g", 1)]


@pytest.fixture
def small_bound(monkeypatch):
    monkeypatch.setattr(changeset, "CHANGES_BROADCAST_MAX_ROWS", 0)


def test_changes_are_scanned_once(spark, tmp_path):
    """The plans of all three parts read the collapsed table; only the rejects look at
    the changes again, since they show each of them."""
    path = str(tmp_path / "changes")
    changes_of(spark, ROWS).write.parquet(path)
    res = apply_changes(base_of(spark), spark.read.parquet(path), KEYS, "v")
    scans = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("new_value#") and sum(
        f.startswith(f"file://{path}") or f.startswith(f"file:{path}") for f in df.inputFiles()
    )
    assert not scans(res.updated) and not scans(res.outcome) and scans(res.rejects) >= 1
    folders = list(res.scratch.paths)
    res.updated.count(), res.outcome.first(), res.rejects.count(), res.updated.count()
    assert res.scratch.paths == folders and len(folders) == 1  # written once
    assert res.collapsed[1] == {"keys": 4, "bytes": res.collapsed[1]["bytes"], "valid": 7, "bad": 2}
    res.release()
    assert not os.path.exists(folders[0].removeprefix("file:"))


@pytest.mark.parametrize("bounded", [True, False])
def test_write_observes_the_outcome(spark, tmp_path, monkeypatch, bounded):
    if not bounded:
        monkeypatch.setattr(changeset, "CHANGES_BROADCAST_MAX_ROWS", 0)
    res = apply_changes(base_of(spark), changes_of(spark, ROWS), KEYS, "v", op="u")
    got = res.write(str(tmp_path / "v2")).first()
    assert got.asDict() == {"op": "u", "changes": 9, "applied": 3, "superseded": 2, "rejected": 4, "rows_matched": 1003}
    assert got == apply_changes(base_of(spark), changes_of(spark, ROWS), KEYS, "v", op="u").outcome.first()
    stored = spark.read.parquet(str(tmp_path / "v2"))
    assert stored.columns == ["k", "v", "x"] and stored.count() == 3000
    assert {r.v: r["count"] for r in stored.groupBy("v").count().collect()} == {"old": 1997, "b": 1001, "c": 1, "g": 1}


def test_write_with_nothing_to_apply(spark, tmp_path, small_bound):
    res = apply_changes(base_of(spark, 9), changes_of(spark, []), KEYS, "v", op="u")
    assert tuple(res.write(str(tmp_path / "a")).first()) == ("u", 0, 0, 0, 0, 0) and spark.read.parquet(str(tmp_path / "a")).count() == 9
    none = apply_changes(base_of(spark, 0), changes_of(spark, ROWS), KEYS, "v", op="u")
    assert tuple(none.write(str(tmp_path / "b")).first()) == ("u", 9, 0, 0, 9, 0)


def test_hot_keys_are_those_above_a_fair_share(spark):
    hot = hot_keys.hot_keys(base_of(spark).unionByName(base_of(spark, 0)), KEYS)
    (key,) = spark.range(1).select(F.xxhash64(F.lit(1).cast("bigint"))).first()
    assert list(hot) == [key] and 8 <= hot[key] <= 12  # a third of the rows over 8 partitions
    nulls = spark.range(100).select(F.lit(None).cast("bigint").alias("k"))
    assert hot_keys.hot_keys(nulls, KEYS) == {}


def test_hot_base_key_is_spread_without_skew_handling(spark, small_bound):
    """No task of the join gets more than three times the median, and only winners of the
    hot key are repeated."""
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        n = 48_000
        changes = spark.range(n).select(F.col("id").alias("k"), F.lit("new").alias("new_value"), F.lit(1).alias("seq"))
        res = apply_changes(base_of(spark, n), changes, KEYS, "v")
        sizes = sorted(r["count"] for r in res.updated.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sum(sizes) == n and len(sizes) == 16 and sizes[-1] <= 3 * sizes[8]
        plain = base_of(spark, n).join(changes.select("k"), "k")
        skewed = sorted(r["count"] for r in plain.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert skewed[-1] > 3 * skewed[8]  # so it would be without salts
        assert res.updated.filter("v = 'new'").count() == n
        assert len(hot_keys.hot_keys(base_of(spark, n), KEYS)) == 1
        outcome = res.outcome.first()
        assert (outcome.applied, outcome.rows_matched) == (n - n // 3, n)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_scratch_removes_tables_and_checkpoints(spark):
    with Scratch(spark) as scratch:
        rows, seen = scratch.write_once(spark.range(5), "x", n=F.count(F.lit(1)), most=F.max("id"))
        assert seen == {"n": 5, "most": 4} and rows.count() == 5
        assert scratch.checkpointed(spark.range(7)).count() == 7
        folders = [p.removeprefix("file:") for p in scratch.paths]
        assert len(folders) == 2 and all(map(os.path.exists, folders))
    assert not any(map(os.path.exists, folders))


@pytest.mark.parametrize("bounded", [True, False])
def test_updates_written_equal_their_outcomes(spark, small_tables, tmp_path, monkeypatch, bounded):
    if not bounded:
        monkeypatch.setattr(changeset, "CHANGES_BROADCAST_MAX_ROWS", 0)
    t = small_tables
    for name, make in {
        "quantity": lambda: updates.set_order_quantity(t, fixture.mixed_quantity_changes(t)),
        "method": lambda: updates.set_ship_method(t),
        "email": lambda: updates.set_email(t, fixture.mixed_email_changes(t)),
    }.items():
        res = make()
        assert res.write(str(tmp_path / name)).first() == make().outcome.first()
        stored = spark.read.parquet(str(tmp_path / name))
        assert stored.exceptAll(res.updated).count() == 0 and res.updated.exceptAll(stored).count() == 0
