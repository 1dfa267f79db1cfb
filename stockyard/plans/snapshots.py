"""A table as numbered Parquet versions, with counts observed by each write (S7).

Plain Parquet has no UPDATE: an update reads version *n* and writes version *n + 1* to a
folder of its own below ``root`` (a shared folder on a cluster), so readers of *n* are never
disturbed. A version counts once Spark's writer has left its ``_SUCCESS`` marker there;
what a failed job leaves is no version, and the next write takes a number beyond it.

A write states the version it was built from and fails if another has become current. The
folder's name also carries a digest of an optional entry ID (an adjustment, a stream batch), so a
job that is run again finds its entry applied and leaves the table as it is.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.changeset import HIT

_NAME = re.compile(r"v(\d{8})(?:-([0-9a-f]{64}))?$")


class ConcurrentCommitError(RuntimeError):
    """Another version has become current."""


@dataclass(frozen=True)
class Commit:
    version: int
    path: str
    op: str
    entry_id: str | None
    rows_written: int
    rows_matched: int | None
    skipped: bool = False


def _digest(entry_id: str) -> str:
    return hashlib.sha256(entry_id.encode()).hexdigest()


class SnapshotStore:
    """A table kept as numbered Parquet versions under ``root``."""

    def __init__(self, spark: SparkSession, root: str, partition_by: list[str] | None = None):
        self.spark = spark
        self.root = root.rstrip("/")
        self.partition_by = list(partition_by or [])

    def _folders(self, complete: bool = True) -> dict[str, tuple[int, str | None]]:
        """{name: (version, digest of its entry)} of the versions under ``root``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return {}
        names = [f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()]
        found = {n: (int(m[1]), m[2]) for n in names if (m := _NAME.match(n))}
        marker = lambda n: self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{n}/_SUCCESS")
        return {n: v for n, v in found.items() if not complete or fs.exists(marker(n))}

    def current_version(self) -> int:
        """The latest version, 0 if there is none."""
        return max((v for v, _ in self._folders().values()), default=0)

    def version_path(self, version: int, entry_id: str | None = None) -> str:
        """The folder of a version: as it is there, or as a new one is named."""
        for name, (v, _) in self._folders().items():
            if v == version:
                return f"{self.root}/{name}"
        return f"{self.root}/v{version:08d}" + (f"-{_digest(entry_id)}" if entry_id is not None else "")

    def read(self, version: int | None = None) -> DataFrame:
        version = self.current_version() if version is None else version
        if version < 1:
            raise ValueError(f"no version under {self.root}")
        return self.spark.read.parquet(self.version_path(version))

    def has_entry(self, entry_id: str) -> bool:
        """Whether a version was written under this entry ID."""
        return _digest(entry_id) in {d for _, d in self._folders().values()}

    def skipped(self, op: str, entry_id: str) -> Commit:
        """What a commit under an entry that is applied already comes to."""
        current = self.current_version()
        return Commit(current, self.version_path(current), op, entry_id, 0, 0, skipped=True)

    def commit(
        self, df: DataFrame, op: str, entry_id: str | None = None, hit_column: str | None = HIT, expected_version: int | None = None
    ) -> Commit:
        """Write ``df`` as the next version. ``expected_version``: the one it was built from.

        If ``hit_column`` is a column of ``df`` it is counted (rows_matched) while writing
        and dropped from the stored table."""
        if entry_id is not None and self.has_entry(entry_id):
            return self.skipped(op, entry_id)
        before = self.current_version()
        if expected_version is not None and before != expected_version:
            raise ConcurrentCommitError(f"{self.root}: version {before} has become current since {expected_version} was read")
        version = max((v for v, _ in self._folders(complete=False).values()), default=0) + 1
        path = self.version_path(version, entry_id)
        metrics = [F.count(F.lit(1)).alias("rows_written")]
        has_hit = hit_column is not None and hit_column in df.columns
        if has_hit:
            metrics.append(F.count(F.when(F.col(hit_column), 1)).alias("rows_matched"))
        seen = Observation(f"version_{version}")
        observed = df.observe(seen, *metrics)
        writer = (observed.drop(hit_column) if has_hit else observed).write.mode("errorifexists")
        (writer.partitionBy(*self.partition_by) if self.partition_by else writer).parquet(path)
        others = [n for n, (v, _) in self._folders().items() if v > before and f"{self.root}/{n}" != path]
        if others:
            own = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            own.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(own, True)
            raise ConcurrentCommitError(f"{self.root}: {others[0]} was written at the same time")
        got = seen.get
        return Commit(version, path, op, entry_id, int(got["rows_written"]), int(got["rows_matched"]) if has_hit else None)

    def initialize(self, df: DataFrame, op: str = "initial") -> Commit:
        """Version 1 from an existing table (fails if the store has versions)."""
        if self.current_version() != 0:
            raise ValueError(f"{self.root} already has versions")
        return self.commit(df, op, hit_column=None)
