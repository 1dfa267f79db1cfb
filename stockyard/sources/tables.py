"""S2: a named set of source tables, loaded from parquet or JDBC.

Every operation takes a :class:`Tables` rather than a connection, so the same
operation runs against any instance: a parquet folder, a JDBC database, or a
mix (one loader per table).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

# Names of the driver's test tables; the operations use the first eight.
TABLE_NAMES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
)

Loader = Callable[[SparkSession, str], DataFrame]


class Tables(Mapping[str, DataFrame]):
    """Lazily loaded ``{name: DataFrame}`` with one loader per table.

    Loading is lazy (a parquet read only lists the file footer), and each table
    is loaded at most once per ``Tables`` so that a query reusing a table shares
    one relation, which lets Spark reuse its exchanges.
    """

    def __init__(self, spark: SparkSession, loaders: Mapping[str, Loader]):
        self.spark = spark
        self._loaders = dict(loaders)
        self._frames: dict[str, DataFrame] = {}
        self._derived: dict[str, DataFrame] = {}
        self.bounded_cache: dict[str, bool] = {}
        self.facts: dict[str, object] = {}  # small figures about the tables, found once

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._frames:
            if name not in self._loaders:
                raise KeyError(f"no loader for table {name!r}")
            self._frames[name] = self._loaders[name](self.spark, name)
        return self._frames[name]

    def __iter__(self):
        return iter(self._loaders)

    def __len__(self) -> int:
        return len(self._loaders)

    def derived(self, key: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A DataFrame derived from the tables (a dimension view), built once."""
        if key not in self._derived:
            self._derived[key] = build()
        return self._derived[key]

    def with_table(self, name: str, df: DataFrame) -> Tables:
        """A copy in which ``name`` is the given DataFrame (e.g. a new snapshot)."""
        out = Tables(self.spark, self._loaders)
        out._frames = dict(self._frames)
        out._frames[name] = df
        return out

    def register_views(self, names: Iterable[str] | None = None, prefix: str = "") -> None:
        """Register the tables as temporary views (for SQL and SQL functions)."""
        for name in names or self._loaders:
            self[name].createOrReplaceTempView(prefix + name)

    # -- constructors -------------------------------------------------------

    @classmethod
    def from_parquet(
        cls, spark: SparkSession, root: str, names: Iterable[str] = TABLE_NAMES
    ) -> Tables:
        """``{root}/{name}.parquet`` for every name (a file or a folder of parts)."""
        root = root.rstrip("/")

        def load(session: SparkSession, name: str) -> DataFrame:
            return session.read.parquet(f"{root}/{name}.parquet")

        return cls(spark, {n: load for n in names})

    @classmethod
    def from_loaders(cls, spark: SparkSession, loaders: Mapping[str, Loader]) -> Tables:
        return cls(spark, loaders)

    @classmethod
    def from_frames(cls, spark: SparkSession, frames: Mapping[str, DataFrame]) -> Tables:
        """Tables over DataFrames already built (tests, JDBC reads, snapshots)."""
        out = cls(spark, {n: _missing for n in frames})
        out._frames = dict(frames)
        return out


def _missing(spark: SparkSession, name: str) -> DataFrame:  # pragma: no cover
    raise KeyError(name)
