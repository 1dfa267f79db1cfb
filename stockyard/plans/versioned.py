"""The update operations against a :class:`SnapshotStore`: read version n, write n + 1.

* :func:`adjust_stock_once` - U3 with an adjustment ID that its version carries;
  running it again with the same ID changes nothing.
* :func:`commit_changes` - kernel K over the store's current version with a
  table of changes (U5-U7 and any other keyed update), optionally with an
  entry ID so that a retried job (or a replayed stream batch) applies once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from ..operators import stock
from ..operators.changeset import ChangeSetResult, apply_changes
from ..sources.tables import Tables
from .snapshots import Commit, SnapshotStore


def adjust_stock_once(
    store: SnapshotStore,
    t: Tables,
    category: int,
    location: int,
    adjustment_id: str,
    pct: int | float | str = 5,
    rounding: str = "floor",
) -> Commit:
    """U3 on the store's current inventory; skipped if ``adjustment_id`` is recorded."""
    if store.has_entry(adjustment_id):
        return store.skipped("adjust_stock", adjustment_id)
    version = store.current_version()
    adj = stock.adjust_stock(t, category, location, pct, rounding, inventory=store.read(version))
    return store.commit(adj.table, adj.op, entry_id=adjustment_id, expected_version=version)


def commit_changes(
    store: SnapshotStore,
    changes: DataFrame,
    keys: list[str],
    column: str,
    op: str,
    entry_id: str | None = None,
    prepare: Callable[[DataFrame, DataFrame], ChangeSetResult] | None = None,
    seq_column: str | None = None,
    before_commit: Callable[[ChangeSetResult], None] | None = None,
) -> tuple[Commit, ChangeSetResult | None]:
    """Apply ``changes`` to the current version and commit the next one.

    ``prepare(base, changes)`` may replace the plain kernel call (U6 checks
    method IDs first). ``seq_column`` names a column of the stored table with
    the seq last applied to each row, so that a later commit never applies an
    older change (see :func:`apply_changes`); it is for the plain kernel call,
    and a ``prepare`` function passes it to the update itself.
    ``before_commit(result)`` runs before the new version is written (to store rejects:
    a retry repeats it, while after the commit a retry is skipped).
    The commit fails if another version has become current since this one was read.
    Returns the commit and the lazy result (for rejects).
    """
    if prepare is not None and seq_column is not None:
        raise ValueError("seq_column applies to the plain kernel call, not to prepare")
    if entry_id is not None and store.has_entry(entry_id):
        return store.skipped(op, entry_id), None
    version = store.current_version()
    base = store.read(version)
    if prepare is not None:
        result = prepare(base, changes)
    else:
        result = apply_changes(base, changes, keys, column, op=op, seq_column=seq_column)
    if before_commit is not None:
        before_commit(result)
    return store.commit(result.table, result.op, entry_id=entry_id, expected_version=version), result
