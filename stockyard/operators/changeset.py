"""K: apply a whole table of keyed changes to a table, as one distributed job.

``apply_changes(base, changes, keys, column)``

* ``changes`` has the key columns (named as in ``base``), ``new_value`` and
  ``seq`` (anything orderable: a bigint, or a struct such as (ts, event_id)),
  and optionally ``reason``: a change that arrives with a reason was already
  rejected upstream (an unknown ship method, a quantity under a minimum).
* Changes that can never apply are set aside with a reason: ``null_key``,
  ``null_value``, ``no_such_key``, or the upstream one.
* The rest collapse to one change per key with ``max(struct(seq, new_value))``:
  a partial (map-side) aggregation and no window, so a key changed a million
  times costs one row per map task. On equal ``seq`` the larger ``new_value``
  wins, deterministically. A struct buffer is not hash-aggregatable, so Spark
  runs this as a sort-based aggregate (it spills instead of failing); the
  alternatives are worse at scale: ``max_by`` breaks ties arbitrarily, and
  ``max(seq)`` joined back to the changes shuffles every change uncollapsed.
* ``base`` LEFT JOIN the collapsed changes; the decision uses a match marker
  on the change side, never ``new_value is not null``. A key matching several
  base rows updates all of them, as a SQL UPDATE does.

The result keeps the schema and the row count of ``base``. Work is organised
around one per-key table, built by a single conditional aggregation over the
changes: the winner, how many valid changes the key had, how many were
rejected. That table is written once to the shared folder, on first use; the
write observes its rows and bytes, and ``updated``, ``rejects`` and ``outcome``
read it from there, so the changes are collapsed once however many of the three are
used. When it is proven small it is broadcast, so the base (the big side, e.g.
all of ``lineitem``) streams through a hash join and is never shuffled; beyond the
bound it is sort-merge joined, and there the few base keys that hold more rows than
a fair partition (found by a sketch of bounded size, see :mod:`..plans.hot_keys`) are
salted, with only their winners replicated.

The update reads ``base`` once (one left join; a key absent from ``base`` simply
matches nothing). Whether a key exists in ``base`` matters only for the rejects and
the counts; a semi-join that streams just the key columns of ``base`` counts the
rows each change key matches, and the outcome is then one aggregation over the
per-key table (no cross join). :meth:`ChangeSetResult.write` stores the new table
and takes its counts from that write: beyond the broadcast bound all of them, since a
full outer join also shows the winners that met no row.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..plans.hot_keys import hot_keys, salted_join
from ..plans.scratch import Scratch

# Reasons a change is set aside.
NULL_KEY = "null_key"
NULL_VALUE = "null_value"
NO_SUCH_KEY = "no_such_key"

HIT = "_hit"  # match marker carried by the change side of the join

# Collapsed change sets up to this many keys are broadcast to the base (checked
# by a bounded count), so the base streams through a hash join without being
# shuffled; larger ones are sort-merge joined. One key row is a few tens of
# bytes, so the bound keeps a broadcast under ~100 MB.
CHANGES_BROADCAST_MAX_ROWS = 1_000_000
CHANGES_BROADCAST_MAX_BYTES = 64 << 20

OUTCOME_COLUMNS = ("op", "changes", "applied", "superseded", "rejected", "rows_matched")


class ChangeSetResult:
    """Parts of one change-set application; each plan is built on first use, and the
    first one writes the collapsed changes (:meth:`release` removes them)."""

    def __init__(
        self,
        op: str,
        base: DataFrame,
        flagged: DataFrame,
        keys: list[str],
        column: str,
        seq_column: str | None = None,
    ):
        self.op = op
        self.base = base
        self.flagged = flagged  # every change: keys..., new_value, seq, reason (null = valid)
        self.keys = list(keys)
        self.column = column
        self.seq_column = seq_column  # base column holding the seq last applied to the row
        self.broadcast_max_rows = CHANGES_BROADCAST_MAX_ROWS
        self.scratch = Scratch(base.sparkSession)
        # (keys..., _new, ...) -> the same with _new as ``column`` stores it; for changes
        # given by an ID, say, so the lookup meets the collapsed changes and not the base
        self.resolve: Callable[[DataFrame], DataFrame] | None = None

    def is_small(self) -> bool:
        """Whether the keys with a valid change are few and narrow enough to broadcast, by
        what the write of the collapsed changes has counted."""
        seen = self.collapsed[1]
        return seen["keys"] <= self.broadcast_max_rows and seen["bytes"] <= CHANGES_BROADCAST_MAX_BYTES

    def release(self) -> None:
        """Remove the collapsed changes, once the last plan that reads them has run."""
        self.scratch.release()

    @cached_property
    def collapsed(self) -> tuple[DataFrame, dict]:
        """:attr:`per_key_changes` written once; with the number and bytes of its keys with a
        valid change, and the sums of _n and _bad."""
        width = reduce(
            lambda a, b: a + b,
            [
                F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)).cast("bigint")
                for c in [*self.keys, "_w.new_value", "_w.seq"]
            ],
        )
        used = F.col("_n") > 0
        return self.scratch.write_once(
            self.per_key_changes,
            "changes",
            keys=F.count(F.when(used, 1)),
            bytes=F.coalesce(F.sum(F.when(used, width)), F.lit(0)),
            valid=F.coalesce(F.sum("_n"), F.lit(0)),
            bad=F.coalesce(F.sum("_bad"), F.lit(0)),
        )

    @cached_property
    def per_key_changes(self) -> DataFrame:
        """The plan that collapses the changes: keys..., _w (winner struct), _n (valid
        changes), _bad (rejected changes)."""
        valid = F.col("reason").isNull()
        return self.flagged.groupBy(*self.keys).agg(
            F.max(F.when(valid, F.struct("seq", "new_value"))).alias("_w"),
            F.count(F.when(valid, 1)).alias("_n"),
            F.count(F.when(~valid, 1)).alias("_bad"),
        )

    def _winners(self, *extra: str) -> DataFrame:
        winners = self.collapsed[0].filter(F.col("_n") > 0).select(
            *self.keys, F.col("_w.new_value").alias("_new"), F.col("_w.seq").alias("_wseq"), F.lit(True).alias(HIT), *extra
        )
        return self.resolve(winners) if self.resolve else winners

    def _joined(self, winners: DataFrame, how: str) -> DataFrame:
        """``base`` joined with the winners: by broadcast if they are few, else by key with
        the hot keys of ``base`` salted."""
        if self.is_small():
            return self.base.join(F.broadcast(winners), self.keys, how)
        return salted_join(self.base, winners, self.keys, how, self._hot)

    @cached_property
    def _hot(self) -> dict[int, int]:
        return hot_keys(self.base, self.keys)

    def _hit(self) -> Column:
        hit = F.coalesce(F.col(HIT), F.lit(False))
        if self.seq_column:
            # a winner no newer than what the row already holds does not apply
            cur = F.col(self.seq_column)
            hit = hit & (cur.isNull() | (F.col("_wseq") > cur))
        return hit

    def _columns(self, hit: Column) -> list[Column]:
        """The columns of ``base``, those that the update sets from the winner."""
        updates = {self.column: "_new"}
        if self.seq_column:
            updates[self.seq_column] = "_wseq"
        return [F.when(hit, F.col(updates[c])).otherwise(F.col(c)).alias(c) if c in updates else F.col(c) for c in self.base.columns]

    @cached_property
    def joined(self) -> DataFrame:
        """``base`` columns with ``column`` updated, plus the match marker ``_hit``."""
        hit = self._hit()
        return self._joined(self._winners(), "left").select(*self._columns(hit), hit.alias(HIT))

    @cached_property
    def per_key(self) -> DataFrame:
        """The collapsed changes plus ``_m``, the number of base rows per key,
        and ``_cur``, the seq those rows already hold (null when not tracked)."""
        change_keys = self.collapsed[0].filter(F.col("_n") > 0).select(*self.keys)
        current = F.max(self.seq_column) if self.seq_column else F.lit(None)
        rows = self.base.select(*self.keys, *([self.seq_column] if self.seq_column else []))
        counts = [F.count(F.lit(1)).alias("_m"), current.alias("_cur")]
        if self.is_small():
            matches = rows.join(F.broadcast(change_keys), self.keys, "left_semi").groupBy(*self.keys).agg(*counts)
        else:
            # Base rows are counted per key in each task before the shuffle, so a key
            # with a third of all rows arrives as one row per task. (A semi-join with the
            # change keys would be pushed below the counting and shuffle every row.)
            matches = rows.groupBy(*self.keys).agg(*counts)
        return self.collapsed[0].join(matches, self.keys, "left")

    @property
    def table(self) -> DataFrame:
        """The new table plus the match marker ``_hit`` (for observed writes)."""
        return self.joined

    @property
    def updated(self) -> DataFrame:
        """The new table: same row count as ``base``."""
        return self.table.drop(HIT)

    def write(self, path: str, mode: str = "errorifexists") -> DataFrame:
        """Store the new table at ``path``; the outcome row (as :attr:`outcome`).

        The counts are observed while the table is written. Beyond the broadcast bound, a full
        outer join shows each winner without a row once, so all counts come from this one
        pass over ``base``; the rows it adds are not stored. A broadcast side can't be
        kept whole by an outer join, so below the bound, and where seqs decide per row, the keys
        that met a row are counted over the key columns of ``base``."""
        spark = self.base.sparkSession
        if self.seq_column or self.is_small():
            self.updated.write.mode(mode).parquet(path)
            return self.outcome
        winners = self._winners("_n")
        of_base = F.lit(True).alias("_base")
        both = salted_join(self.base.select("*", of_base), winners, self.keys, "full", self._hot)
        alone = F.col("_base").isNull()
        seen = Observation("update")
        zero = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
        observed = both.observe(
            seen,
            F.count(F.when(alone, 1)).alias("missed"),
            zero(F.when(alone, F.col("_n"))).alias("missed_changes"),
            F.count(F.when(~alone & self._hit(), 1)).alias("rows_matched"),
        )
        observed.filter(~alone).select(*self._columns(self._hit())).write.mode(mode).parquet(path)
        all_, got = self.collapsed[1], seen.get
        applied = all_["keys"] - got["missed"]
        counts = (
            self.op, all_["valid"] + all_["bad"], applied, all_["valid"] - got["missed_changes"] - applied,
            all_["bad"] + got["missed_changes"], got["rows_matched"],
        )
        kinds = ["string"] + ["bigint"] * (len(OUTCOME_COLUMNS) - 1)
        return spark.createDataFrame([counts], ", ".join(f"{c} {k}" for c, k in zip(OUTCOME_COLUMNS, kinds)))

    @property
    def rejects(self) -> DataFrame:
        """keys..., new_value, seq, reason for every change that was not applied
        (superseded changes are not rejects)."""
        cols = [*self.keys, "new_value", "seq", "reason"]
        flagged = self.flagged.filter(F.col("reason").isNotNull()).select(*cols)
        missing = self.per_key.filter((F.col("_n") > 0) & F.col("_m").isNull()).select(*self.keys)
        no_such_key = (
            self.flagged.filter(F.col("reason").isNull())
            .join(missing, self.keys, "left_semi")
            .withColumn("reason", F.lit(NO_SUCH_KEY))
            .select(*cols)
        )
        return flagged.unionByName(no_such_key)

    @property
    def outcome(self) -> DataFrame:
        """One row: op, changes, applied, superseded, rejected, rows_matched."""
        n, bad, m = F.col("_n"), F.col("_bad"), F.col("_m")
        found = (n > 0) & m.isNotNull()
        cur = F.col("_cur")
        # applied: found, and (when seqs are tracked) newer than the rows' seq;
        # a found key whose winner is not newer was superseded by an earlier commit
        fresh = found & (cur.isNull() | (F.col("_w.seq") > cur)) if self.seq_column else found

        def total(c: Column) -> Column:
            return F.coalesce(F.sum(c), F.lit(0)).cast("bigint")

        return self.per_key.agg(
            F.lit(self.op).alias("op"),
            total(n + bad).alias("changes"),
            total(F.when(fresh, 1).otherwise(0)).alias("applied"),
            total(F.when(fresh, n - 1).when(found, n).otherwise(0)).alias("superseded"),
            total(bad + F.when(found, 0).otherwise(n)).alias("rejected"),
            total(F.when(fresh, m).otherwise(0)).alias("rows_matched"),
        )


def _any_null(keys: list[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def apply_changes(
    base: DataFrame,
    changes: DataFrame,
    keys: list[str],
    column: str,
    op: str = "apply_changes",
    seq_column: str | None = None,
    resolve: Callable[[DataFrame], DataFrame] | None = None,
) -> ChangeSetResult:
    """Apply ``changes`` (keys..., new_value, seq[, reason]) to ``column`` of ``base``.

    ``resolve``: maps the collapsed changes' ``_new`` from what the changes hold to what
    ``column`` holds (by a join with a dimension, say); without it ``new_value`` is cast
    to the type of ``column``.

    ``seq_column``: a column of ``base`` holding the ``seq`` last applied to
    each row (null = never changed). When given, a key's winner applies only
    if it is newer than that, and the column is set to the winner's ``seq``;
    this is how changes arriving in separate runs (stream batches) keep the
    latest-wins order across runs.
    """
    missing = [k for k in [*keys, column, *([seq_column] if seq_column else [])] if k not in base.columns]
    if missing:
        raise ValueError(f"base lacks columns {missing}")
    missing = [k for k in [*keys, "new_value", "seq"] if k not in changes.columns]
    if missing:
        raise ValueError(f"changes lack columns {missing}")

    upstream = F.col("reason").cast("string") if "reason" in changes.columns else F.lit(None)
    reason = F.coalesce(
        upstream,
        F.when(_any_null(keys), F.lit(NULL_KEY)).when(
            F.col("new_value").isNull(), F.lit(NULL_VALUE)
        ),
    )
    flagged = changes.select(
        *keys,
        (F.col("new_value") if resolve else F.col("new_value").cast(base.schema[column].dataType)).alias("new_value"),
        "seq",
        reason.cast("string").alias("reason"),
    )
    result = ChangeSetResult(op, base, flagged, keys, column, seq_column)
    result.resolve = resolve
    return result
