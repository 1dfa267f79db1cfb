"""Tables written once to the shared folder, and their removal.

A result that several plans read (the collapsed changes of an update, say) is written
as Parquet below the session's checkpoint folder: the plans then read it instead of
each computing it again, the lineage ends there, and a lost executor costs no more than
the reading. Counts about it come from the same write (``observe``).

:class:`Scratch` remembers what was written for one piece of work and removes it when its
last reader is done (``with Scratch(spark) as scratch``). What is not removed by then goes
when the application ends, since the checkpoint folder is marked for removal.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from ..session import checkpoint_dir


class Scratch:
    """Folders of one piece of work."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *exc) -> None:
        self.release()

    def path(self, what: str) -> str:
        """A fresh folder name below the shared checkpoint folder."""
        path = f"{checkpoint_dir(self.spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
        self.paths.append(path)
        return path

    def write_once(self, df: DataFrame, what: str, **metrics: Column) -> tuple[DataFrame, dict]:
        """``df`` written and read back, and the metrics observed by that write."""
        path = self.path(what)
        seen = Observation(what) if metrics else None
        rows = df.observe(seen, *[c.alias(k) for k, c in metrics.items()]) if seen else df
        rows.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), dict(seen.get) if seen else {}

    def checkpointed(self, df: DataFrame) -> DataFrame:
        """``df.checkpoint()``, its folder among those to remove; unlike a table, it keeps
        the order and the partitions of its rows."""
        checkpoint_dir(self.spark)
        out = df.checkpoint(eager=True)
        file = out._jdf.queryExecution().logical().rdd().getCheckpointFile()
        if file.isDefined():
            self.paths.append(file.get())
        return out

    def release(self) -> None:
        """Remove all that was written."""
        conf = self.spark._jsc.hadoopConfiguration()
        while self.paths:
            place = self.spark._jvm.org.apache.hadoop.fs.Path(self.paths.pop())
            place.getFileSystem(conf).delete(place, True)
