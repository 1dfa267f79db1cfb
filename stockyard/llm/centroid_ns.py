"""Operator 11: centroid clustering (k-means on integer vectors) with ns-bounds.

A kept vector has exactly ``dims`` components, none null or non-finite; component x becomes
the integer floor(scale * x). Distances, sums and centroids are exact integers.

Every vector carries, for each centroid, its distance when that was last evaluated and the
number of that round. The driver retains every round's centroids (``k`` x ``dims`` a round).
A stored distance is loosened by the norm of the centroid's total displacement from
the round of the evaluation to now: at most the sum of the drifts of each round, and
smaller whenever a centroid turns back (the norm of a sum against a sum of norms).
If the loosened distance to the own centroid stays below all loosened others, nothing is
evaluated. Otherwise the own distance is evaluated; then those centroids whose bound still
isn't above it, exactly, and the smallest distance wins (ties: smaller number). Bounds are
floats, held with a margin above their rounding, so they decide on work only.

One pass a round over the vectors and their bounds writes the next bounds to the shared folder,
with the sums of each cluster per batch in rows of their own; the table before is then
removed. No vector is shuffled: only sums are, and k x (dims + 1) numbers reach the driver.

Defined results: rows that aren't kept (null, of other length, with a null or non-finite
component) give no row; repeated rows give a row each and each weighs in the means; a null id is
passed on, and as a first centroid it comes after all others; rows of one id are ordered by their
components there; fewer kept vectors than ``k`` give that many clusters; an empty cluster
keeps its centroid; an empty table gives an empty result; other columns don't take part. A
component of 2^27 or more in size after scaling raises an error, since squared distances
would pass 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import binary_parts, discard, fixed_binary, stored

LARGEST = 1 << 27
MARGIN = 1e-6  # above the rounding of 32-bit floats
_FAR = np.iinfo(np.int64).max


def state_type(k: int) -> np.dtype:
    """The bounds of a vector: own centroid; round and distance of each evaluation."""
    return np.dtype([("own", "<i4"), ("at", "<i4", (k,)), ("dist", "<f4", (k,))])


@dataclass
class History:
    """The centroids of every round so far, as integers: (rounds, k, dims)."""

    centroids: np.ndarray
    moved: np.ndarray = field(init=False)  # norm of the displacement from each round to the last

    def __post_init__(self) -> None:
        step = (self.centroids[-1][None] - self.centroids).astype(np.float64)
        self.moved = np.sqrt((step * step).sum(axis=2))

    @property
    def now(self) -> np.ndarray:
        return self.centroids[-1]

    @property
    def round(self) -> int:
        return len(self.centroids) - 1


def squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the integer vectors x to one centroid (or a row each)."""
    step = x - c
    return np.einsum("ij,ij->i", step, step)


def assign(x: np.ndarray, state: np.ndarray, history: History) -> tuple[np.ndarray, int]:
    """The next bounds of the vectors ``x``, and how many distances were evaluated."""
    state, c, now, k = state.copy(), history.now, history.round, len(history.now)
    if now == 0:
        d = np.stack([squares(x, c[j]) for j in range(k)], axis=1)
        state["own"], state["at"], state["dist"] = d.argmin(axis=1), 0, np.sqrt(d.astype(np.float64))
        return state, d.size
    centroid = np.arange(k)
    moved = history.moved[state["at"], centroid] * (1 + MARGIN)
    dist = state["dist"].astype(np.float64)
    low = dist * (1 - MARGIN) - moved
    rows = np.arange(len(x))
    own = state["own"]
    high = dist[rows, own] * (1 + MARGIN) + moved[rows, own]
    low[rows, own] = np.inf
    unsure = np.flatnonzero(~(high < low.min(axis=1)))
    if not len(unsure):
        return state, 0
    x, own, low = x[unsure], own[unsure], low[unsure]
    rows = np.arange(len(unsure))
    d = np.full((len(unsure), k), _FAR)
    d[rows, own] = squares(x, c[own])
    open_ = low <= (np.sqrt(d[rows, own].astype(np.float64)) * (1 + MARGIN))[:, None]
    for j in range(k):
        some = np.flatnonzero(open_[:, j])
        d[some, j] = squares(x[some], c[j])
    state["own"][unsure] = d.argmin(axis=1)
    i, j = np.nonzero(d != _FAR)
    state["at"][unsure[i], j] = now
    state["dist"][unsure[i], j] = np.sqrt(d[i, j].astype(np.float64))
    return state, len(i)


def _sums(x: np.ndarray, own: np.ndarray, k: int) -> np.ndarray:
    """Size and component sums of each cluster: (k, 1 + dims)."""
    out = np.zeros((k, 1 + x.shape[1]), np.int64)
    for j in range(k):
        some = own == j
        out[j, 0], out[j, 1:] = some.sum(), x[some].sum(axis=0)
    return out


def _integers(column: pa.Array, dims: int, scale: int) -> np.ndarray:
    x = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dims) * scale)
    if len(x) and np.abs(x).max() >= LARGEST:
        raise ValueError(f"a vector component is {LARGEST} or more in size after scaling; squared distances would pass 64 bits")
    return x.astype(np.int64)


def _read(batch: pa.RecordBatch, dims: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    x = binary_parts(batch.column("vector"))[1].view(np.int32).reshape(-1, dims).astype(np.int64)
    return x, binary_parts(batch.column("state"))[1].view(state_type(k))


def kept(vectors: DataFrame, vec_id: str, embedding: str, dims: int) -> DataFrame:
    """(id, parts) of the vectors that take part."""
    parts = F.col(embedding).cast("array<double>")
    rows = vectors.select(F.col(vec_id).cast("long").alias("id"), parts.alias("parts")).filter(F.size("parts") == dims)
    fine = F.forall("parts", lambda p: p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf")))
    return rows.filter(fine)


def first_centroids(rows: DataFrame, k: int, seed: str, dims: int, scale: int) -> np.ndarray:
    """The ``k`` kept vectors of smallest sha256 of ``seed:id``, in that order."""
    by = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    found = rows.orderBy(by.asc_nulls_last(), F.col("parts")).limit(k).collect()  # k rows
    return _integers(pa.array([r.parts for r in found], pa.list_(pa.float64())), dims, scale) if found else np.zeros((0, dims), np.int64)


@dataclass
class Clusters:
    """``rows``: vec_id, cluster, distance of every kept vector, written to the shared folder.
    ``history``: the centroids of all rounds. ``evaluated``: distances evaluated in each pass."""

    rows: DataFrame
    history: np.ndarray
    evaluated: list[int]


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: str = "3",
    vec_id: str = "vec_id", embedding: str = "embedding",
) -> Clusters:
    """``rounds`` rounds of assignment and update, then one more assignment."""
    spark = vectors.sparkSession
    rows = kept(vectors, vec_id, embedding, dims)
    first = first_centroids(rows, k, seed, dims, scale)
    k = len(first)
    result = "vec_id long, cluster int, distance long"
    if not k:
        return Clusters(spark.createDataFrame([], result), first[None], [])
    schema = "id long, vector binary, state binary, sums array<long>"
    table, path, centroids, evaluated = rows, None, first[None], []

    def next_bounds(history: History):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if not b.num_rows:
                    continue
                if history.round == 0:
                    x, state = _integers(b.column("parts"), dims, scale), np.zeros(b.num_rows, state_type(k))
                else:
                    x, state = _read(b, dims, k)
                state, n = assign(x, state, history)
                sums = np.r_[_sums(x, state["own"], k).ravel(), n]
                vector = fixed_binary(x.astype(np.int32))
                yield pa.record_batch([b.column("id"), vector, fixed_binary(state), pa.nulls(len(x), pa.list_(pa.int64()))], names=["id", "vector", "state", "sums"])
                none = pa.nulls(1, pa.binary())
                yield pa.record_batch([pa.nulls(1, pa.int64()), none, none, pa.array([sums.tolist()], pa.list_(pa.int64()))], names=["id", "vector", "state", "sums"])

        return run

    def last(history: History):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                if b.num_rows:
                    x, state = _read(b, dims, k)
                    own = assign(x, state, history)[0]["own"]
                    yield pa.record_batch([b.column("id"), pa.array(own), pa.array(squares(x, history.now[own]))], names=["vec_id", "cluster", "distance"])

        return run

    for _ in range(rounds):
        before = path
        table, path = stored(table.mapInArrow(next_bounds(History(centroids)), schema), "ns-bounds")
        if before:
            discard(spark, before)
        numbers = table.filter("sums is not null").select(F.posexplode("sums").alias("place", "value"))
        total = numbers.groupBy("place").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
        sums = {r.place: int(r.value) for r in total.collect()}  # k * (dims + 1) + 1 numbers
        evaluated.append(sums[k * (dims + 1)])
        new = centroids[-1].copy()
        for j in range(k):
            count, *parts = (sums[j * (dims + 1) + p] for p in range(dims + 1))
            if count:
                new[j] = [s // count for s in parts]
        centroids = np.concatenate([centroids, new[None]])
        table = table.filter("vector is not null")
    if path is None:  # no rounds: the first centroids are the last
        table, path = stored(table.mapInArrow(next_bounds(History(centroids)), schema), "ns-bounds")
        table = table.filter("vector is not null")
    done, _ = stored(table.mapInArrow(last(History(centroids)), result), "ns-clusters")
    discard(spark, path)
    return Clusters(done, centroids, evaluated)


def with_totals(found: Clusters) -> DataFrame:
    """One row per vector with its cluster's and the whole inertia and the centroid's digest."""
    per = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # k rows
    inertia = {r.cluster: int(r.total) for r in per}
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in found.history[-1].tolist()]
    said = [(j, inertia.get(j, 0), sum(inertia.values()), digest[j]) for j in range(len(digest))]
    kinds = "cluster int, cluster_inertia long, inertia long, centroid_sha256 string"
    of = found.rows.sparkSession.createDataFrame(said, kinds)
    return found.rows.join(F.broadcast(of), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
