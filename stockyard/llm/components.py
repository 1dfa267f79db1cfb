"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import written


def _contracted(edges: DataFrame) -> DataFrame:
    """Within each partition, replace the edges by one (node, smallest node) each: a
    spanning forest, so at most as many rows as the partition has nodes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for b in batches:
            for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist()):
                a, c = root(u), root(v)
                if a != c:
                    parent[max(a, c)] = min(a, c)
        rows = [(x, root(x)) for x in list(parent)]
        rows = [r for r in rows if r[0] != r[1]]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int64())], names=["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u long, v long")


def components(edges: DataFrame, max_steps: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (u, v: long): root is the smallest node it
    is connected with."""
    links = written(_contracted(edges).distinct(), "links")
    for _ in range(max_steps):
        # links: u > v. Done when every u has one v, and no v is some u.
        several = links.groupBy("u").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("u")
        inner = links.select(F.col("v").alias("w")).join(links.select(F.col("u").alias("w")), "w", "left_semi")
        if several.isEmpty() and inner.isEmpty():
            break
        # Large star: neighbours above a node go to the smallest of its surroundings.
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("x"), F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(least, F.col("u") == F.col("x")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # Small star: neighbours below a node, and the node, go to the smallest of them.
        low = large.groupBy("u").agg(F.min("v").alias("m")).withColumnRenamed("u", "x")
        joined = large.join(low, F.col("u") == F.col("x"))
        small = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select(F.col("x").alias("u"), F.col("m").alias("v")))
        links = written(small.filter("u <> v").distinct(), "links")
    else:
        raise RuntimeError("components did not settle")
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots.select("node", F.col("node").alias("root")))
