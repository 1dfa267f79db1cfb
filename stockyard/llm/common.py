"""Helpers shared by the corpus operators: reading, Arrow batches, shared folder."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.session import checkpoint_dir

# White space of the contracts: space, tab, \n, \v, \f, \r.
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_path(spark: SparkSession, what: str) -> str:
    """A fresh folder name below the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts the lineage and
    fixes one outcome for every later reader, also when executors are lost."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, what: str) -> tuple[DataFrame, str]:
    """``written`` with the folder's name, for steps that ``discard`` it when its last reader
    is done."""
    path = shared_path(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def discard(spark: SparkSession, *paths: str) -> None:
    """Remove folders that ``stored`` wrote."""
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python this package (once per application), for sessions that
    were started without it on the Python path."""
    app = spark.sparkContext.applicationId
    if app not in _SHIPPED:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp()}/stockyard", "zip", root, "stockyard")
        spark.sparkContext.addPyFile(archive)
        _SHIPPED.add(app)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def held_out(doc_id: str = "doc_id"):
    """True where crc32 of the id as text is divisible by 5 (a null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_fraction(doc_id: str, fraction: float):
    """A row filter that keeps about ``fraction`` of the rows, by a hash of the id."""
    if fraction >= 1:
        return F.lit(True)
    return F.pmod(F.xxhash64(F.lit("sample"), F.col(doc_id)), F.lit(1 << 30)) < int(fraction * (1 << 30))


def text_slices(batches: Iterator[pa.RecordBatch], col: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches into runs of whole rows of about ``max_bytes`` of ``col``, so the
    arrays derived from one run stay small however long the texts are. Before the first and after
    the last, memory that Arrow keeps in this Python worker for later goes back to the system."""
    pool = pa.default_memory_pool()
    pool.release_unused()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(col)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        run = (np.cumsum(size) - 1).clip(0) // max_bytes
        cuts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
    pool.release_unused()


def binary_parts(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets (from 0) and bytes of a string or binary array without nulls."""
    if pa.types.is_large_string(values.type) or pa.types.is_large_binary(values.type):
        kind = np.int64
    else:
        kind = np.int32
    n, at = len(values), values.offset
    _, offsets, data = values.buffers()
    if n == 0 or offsets is None:
        return np.zeros(n + 1, np.int64), np.zeros(0, np.uint8)
    off = np.frombuffer(offsets, kind)[at : at + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return off - off[0], raw


def fixed_binary(values: np.ndarray) -> pa.Array:
    """The rows of an array as binary values of one size."""
    size = values.itemsize * (values.shape[1] if values.ndim > 1 else 1)
    offsets = np.arange(len(values) + 1, dtype=np.int64) * size
    data = pa.py_buffer(np.ascontiguousarray(values).tobytes())
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(values), [None, pa.py_buffer(offsets), data]).cast(pa.binary())


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser (uint64 in and out)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blobs(rec: np.ndarray, bucket: np.ndarray, passing: bool) -> Iterator[pa.RecordBatch]:
    """Records as one row (bucket, hot, blob) for each bucket they fall in."""
    if not len(rec):
        return
    by = np.argsort(bucket, kind="stable")
    rec, bucket = rec[by], bucket[by]
    first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
    raw, ends = rec.tobytes(), np.r_[first, len(rec)] * rec.dtype.itemsize
    parts = [raw[a:b] for a, b in zip(ends.tolist(), ends[1:].tolist())]
    yield pa.record_batch(
        [pa.array(bucket[first].astype(np.int32)), pa.array([passing] * len(parts)), pa.array(parts, pa.binary())], names=["bucket", "hot", "blob"]
    )
