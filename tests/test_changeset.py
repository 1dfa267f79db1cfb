"""Kernel K on hand-made rows: rejects, latest wins, duplicates, invariants."""

from pyspark.sql import functions as F

from stockyard.operators.changeset import apply_changes

BASE = "k bigint, k2 int, v string, other double"
CHANGES = "k bigint, k2 int, new_value string, seq bigint"


def _base(spark):
    rows = [
        (1, 1, "a", 1.0),
        (2, 1, "b", 2.0),
        (2, 1, "b2", 2.5),  # duplicate key: both rows are updated
        (3, 2, "c", 3.0),
        (None, 1, "n", 4.0),  # null key in base: never matched
    ]
    return spark.createDataFrame(rows, BASE)


def _changes(spark):
    rows = [
        (1, 1, "x1", 10),
        (1, 1, "x2", 20),  # later: wins
        (1, 1, "x0", 5),  # earlier: superseded
        (2, 1, "y", 7),
        (2, 1, "z", 7),  # equal seq: larger value wins
        (9, 9, "nokey", 1),  # no such key
        (None, 1, "nullkey", 1),
        (3, 2, None, 1),  # null value
    ]
    return spark.createDataFrame(rows, CHANGES)


def test_updated_values_and_invariants(spark):
    base = _base(spark)
    res = apply_changes(base, _changes(spark), ["k", "k2"], "v", op="t")
    out = res.updated
    assert out.columns == base.columns
    assert out.schema == base.schema
    assert out.count() == base.count()
    got = sorted((r.k, r.v, r.other) for r in out.collect() if r.k is not None)
    assert got == [(1, "x2", 1.0), (2, "z", 2.0), (2, "z", 2.5), (3, "c", 3.0)]
    assert out.filter(F.col("k").isNull()).first().v == "n"


def test_rejects_and_reasons(spark):
    res = apply_changes(_base(spark), _changes(spark), ["k", "k2"], "v", op="t")
    rejects = {(r.k, r.reason) for r in res.rejects.collect()}
    assert rejects == {(9, "no_such_key"), (None, "null_key"), (3, "null_value")}


def test_outcome_counts_add_up(spark):
    res = apply_changes(_base(spark), _changes(spark), ["k", "k2"], "v", op="t")
    o = res.outcome.first().asDict()
    assert o == {
        "op": "t",
        "changes": 8,
        "applied": 2,  # keys (1,1) and (2,1)
        "superseded": 3,  # two on (1,1), one on (2,1)
        "rejected": 3,
        "rows_matched": 3,  # one row of key 1, two rows of key 2
    }
    assert o["changes"] == o["applied"] + o["superseded"] + o["rejected"]


def test_applying_twice_equals_once(spark):
    base = _base(spark)
    changes = _changes(spark)
    once = apply_changes(base, changes, ["k", "k2"], "v").updated
    twice = apply_changes(once, changes, ["k", "k2"], "v").updated
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(
        map(tuple, twice.collect()), key=repr
    )


def test_struct_seq_latest_wins(spark):
    base = spark.createDataFrame([(1, "old")], "person_id bigint, email string")
    changes = spark.sql(
        """
        SELECT * FROM VALUES
          (1L, 'a', named_struct('ts', TIMESTAMP_NTZ'2024-01-02 00:00:00', 'event_id', 5L)),
          (1L, 'b', named_struct('ts', TIMESTAMP_NTZ'2024-01-03 00:00:00', 'event_id', 1L)),
          (1L, 'c', named_struct('ts', TIMESTAMP_NTZ'2024-01-03 00:00:00', 'event_id', 0L))
        AS t(person_id, new_value, seq)
        """
    )
    res = apply_changes(base, changes, ["person_id"], "email")
    assert res.updated.first().email == "b"


def test_match_marker_not_value(spark):
    """A change to a value equal to the old one still counts as a match."""
    base = spark.createDataFrame([(1, "same")], "k bigint, v string")
    changes = spark.createDataFrame([(1, "same", 1)], "k bigint, new_value string, seq bigint")
    res = apply_changes(base, changes, ["k"], "v")
    assert res.outcome.first().rows_matched == 1


def test_hot_key_collapses_map_side(spark):
    """One key receives a third of all changes: the latest-wins collapse is a
    partial aggregation before the shuffle (no window), and the winner and
    counts are exact."""
    n = 30_000
    changes = (
        spark.range(n)
        .repartition(8)
        .select(
            F.when(F.col("id") % 3 == 0, F.lit(1)).otherwise(F.col("id") + 10).cast("bigint").alias("k"),
            F.lit(1).alias("k2"),
            F.concat(F.lit("v"), F.col("id").cast("string")).alias("new_value"),
            F.col("id").alias("seq"),
        )
    )
    base = spark.range(n + 20).select(
        F.col("id").alias("k"), F.lit(1).alias("k2"), F.lit("old").alias("v"), F.lit(0.0).alias("other")
    )
    res = apply_changes(base, changes, ["k", "k2"], "v", op="hot")
    hot_winner = f"v{max(i for i in range(n) if i % 3 == 0)}"
    assert res.updated.filter(F.col("k") == 1).first().v == hot_winner
    o = res.outcome.first()
    assert (o.changes, o.applied, o.superseded, o.rejected) == (n, n - n // 3 + 1, n // 3 - 1, 0)
    plan = res.per_key_changes._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    # the struct buffer makes it a sort-based aggregate, still partial per map task
    before_shuffle = plan.split("Exchange hashpartitioning")[1]
    assert "partial_max" in before_shuffle


def test_seq_column_keeps_latest_across_runs(spark):
    """With an applied-seq column, a second run never applies a change older
    than the one the row already holds; such a change counts as superseded."""
    base = spark.createDataFrame(
        [(1, 1, "a", 1.0, None), (2, 1, "b", 2.0, None), (3, 2, "c", 3.0, None)],
        BASE + ", _seq bigint",
    )
    first = spark.createDataFrame([(1, 1, "new1", 50), (2, 1, "new2", 10)], CHANGES)
    run1 = apply_changes(base, first, ["k", "k2"], "v", seq_column="_seq").updated
    late = spark.createDataFrame(
        [(1, 1, "old1", 40), (2, 1, "newer2", 20), (2, 1, "older2", 5), (3, 2, "c2", 1)], CHANGES
    )
    res = apply_changes(run1, late, ["k", "k2"], "v", seq_column="_seq")
    got = sorted((r.k, r.v, r._seq) for r in res.updated.collect())
    assert got == [(1, "new1", 50), (2, "newer2", 20), (3, "c2", 1)]
    o = res.outcome.first()
    assert (o.changes, o.applied, o.superseded, o.rejected, o.rows_matched) == (4, 2, 2, 0, 2)
    assert res.table.filter("_hit").count() == o.rows_matched
