"""Operator 10: line dedup with once-seen and twice-seen Bloom filters.

Every task fills two Bloom filters with the keys of its lines: *once* (a
document has the key) and *twice* (a second document has it). The filters of all
tasks merge chunk by chunk: ``once = a | b``, ``twice = a2 | b2 | (a & b)``, so
``twice`` has the bits of every key that two documents share and of few others.
Only lines whose key it may hold are shuffled, as 128-bit hashes with counts
already summed per task, to be counted exactly. The filter's size follows the
number of lines up to ``max_bits``; beyond that more lines are suspected and
shuffled, and the result stays the same.

The keys to drop are broadcast as hashes only while they are at most
``max_broadcast_keys`` (16 bytes each); more of them are joined instead.

Defined results: a line's key is the line without space, tab, \\n, \\v, \\f, \\r at
both ends, with A-Z lower-cased; lines with an empty key always stay; a null or
empty text is one empty line and stays as it is; every row counts as one
document, so repeated rows count each (a key counts once per row however often
the row has it); other columns pass through, but columns named n_lines and
n_dropped are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import SPACE, partitions, text_slices, written

CHUNK_BITS = 1 << 20
MAX_BITS = 1 << 28
MAX_BROADCAST_KEYS = 1_000_000


class Lines:
    """The lines of a run of texts, with their distinct keys hashed."""

    def __init__(self, texts: pa.Array):
        lists = pc.split_pattern(pc.fill_null(texts, ""), "\n")
        self.counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        self.lines = lists.flatten()
        self.row = np.repeat(np.arange(len(texts)), self.counts)
        coded = pc.ascii_lower(pc.utf8_trim(self.lines, characters=SPACE)).dictionary_encode()
        self.key = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        keys = coded.dictionary.cast(pa.binary()).to_pylist()
        raw = b"".join(map(xxhash.xxh3_128_digest, keys))
        self.hash = np.frombuffer(raw, np.uint64).reshape(-1, 2)
        self.filled = np.fromiter(map(len, keys), np.int64, len(keys)) > 0

    def in_documents(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct (row, key) of non-empty keys: the keys, and the first line of each."""
        lines = np.flatnonzero(self.filled[self.key]) if len(self.key) else np.zeros(0, np.int64)
        pair = self.row[lines] * max(1, len(self.filled)) + self.key[lines]
        _, first = np.unique(pair, return_index=True)
        return self.key[lines[first]], lines[first]


def _bits(hashes: np.ndarray, mask: int) -> np.ndarray:
    """Two bit places for each hash."""
    return (hashes & np.uint64(mask)).astype(np.int64)


def _has(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return ((bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1).all(axis=1)


def _set(bits: np.ndarray, places: np.ndarray) -> None:
    flat = places.ravel()
    np.bitwise_or.at(bits, flat >> 3, np.left_shift(np.uint8(1), (flat & 7).astype(np.uint8)))


def twice_filter(df: DataFrame, text: str = "text", max_bits: int = MAX_BITS) -> np.ndarray:
    """The twice-seen filter (packed bits) over the lines of all rows."""
    spark = df.sparkSession
    n_lines = df.select(F.sum(F.size(F.split(F.coalesce(F.col(text), F.lit("")), "\n")))).first()[0] or 0
    bits = CHUNK_BITS
    while bits < min(max_bits, 8 * n_lines):
        bits *= 2
    step = CHUNK_BITS // 8

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits // 8, np.uint8), np.zeros(bits // 8, np.uint8)
        for b in text_slices(batches, text):
            x = Lines(b.column(text))
            key, _ = x.in_documents()
            if not len(key):
                continue
            n = np.bincount(key, minlength=len(x.filled))
            places = _bits(x.hash, bits - 1)
            many, single = places[n > 1], places[n == 1]
            _set(twice, many)
            _set(twice, single[_has(once, single)])
            _set(once, places[n > 0])
        for c in range(bits // CHUNK_BITS):
            o = once[c * step : (c + 1) * step]
            if o.any():
                t = twice[c * step : (c + 1) * step]
                yield pa.record_batch([pa.array([c], pa.int32()), pa.array([zlib.compress(o, 1)]), pa.array([zlib.compress(t, 1)])], names=["chunk", "once", "twice"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for b in batches:
            for c, o, t in zip(*(col.to_pylist() for col in b.columns)):
                o, t = (np.frombuffer(zlib.decompress(x), np.uint8) for x in (o, t))
                if c not in held:
                    held[c] = [o.copy(), t.copy()]
                else:
                    have = held[c]
                    have[1] |= t | (have[0] & o)
                    have[0] |= o
        for c, (_, t) in held.items():
            if t.any():
                yield pa.record_batch([pa.array([c], pa.int32()), pa.array([zlib.compress(t, 1)])], names=["chunk", "twice"])

    parts = df.select(text).mapInArrow(fill, "chunk int, once binary, twice binary")
    merged = parts.repartition(min(partitions(spark), bits // CHUNK_BITS), "chunk").mapInArrow(merge, "chunk int, twice binary")
    out = np.zeros(bits // 8, np.uint8)
    for c, t in merged.collect():  # at most 2 * max_bits / 8 bytes in all
        out[c * step : (c + 1) * step] = np.frombuffer(zlib.decompress(t), np.uint8)
    return out


def repeated_keys(df: DataFrame, min_docs: int, doc_id: str = "doc_id", text: str = "text", max_bits: int = MAX_BITS) -> DataFrame:
    """Exact: keys in at least ``min_docs`` documents as (h1, h2, n_docs, first), where
    first is the (doc_id, line number) of the first occurrence."""
    if min_docs < 2:
        raise ValueError("min_docs must be at least 2")
    box = df.sparkSession.sparkContext.broadcast(twice_filter(df, text, max_bits))

    def suspects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = box.value
        for b in text_slices(batches, text):
            x = Lines(b.column(text))
            key, line = x.in_documents()
            maybe = _has(bits, _bits(x.hash, len(bits) * 8 - 1))
            key, line = key[maybe[key]], line[maybe[key]]
            if not len(key):
                continue
            number = line - np.repeat(np.cumsum(x.counts) - x.counts, x.counts)[line]
            h = x.hash[key].view(np.int64)
            yield pa.record_batch(
                [pa.array(h[:, 0]), pa.array(h[:, 1]), b.column(doc_id).take(pa.array(x.row[line])), pa.array(number)],
                names=["h1", "h2", "doc", "line"],
            )

    kind = df.schema[doc_id].dataType.simpleString()
    rows = df.select(doc_id, text).mapInArrow(suspects, f"h1 long, h2 long, doc {kind}, line long")
    counted = rows.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n_docs"), F.min(F.struct("doc", "line")).alias("first"))
    return counted.filter(F.col("n_docs") >= min_docs)


def _rebuilt(x: Lines, drop: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """Lines dropped per text, and the texts of the other lines."""
    gone = np.bincount(x.row[drop], minlength=len(x.counts))
    kept = x.lines.filter(pa.array(~drop))
    ends = np.r_[0, np.cumsum(x.counts - gone)].astype(np.int32)
    return gone, pc.binary_join(pa.ListArray.from_arrays(pa.array(ends), kept), "\n")


def dedup_lines(
    df: DataFrame,
    min_docs: int = 10,
    keep_first: bool = False,
    doc_id: str = "doc_id",
    text: str = "text",
    max_bits: int = MAX_BITS,
    max_broadcast_keys: int = MAX_BROADCAST_KEYS,
) -> DataFrame:
    """``df`` with ``text`` without the lines whose key ``min_docs`` documents have, and
    with n_lines (before) and n_dropped. ``keep_first`` leaves the first occurrence of
    each key (smallest doc_id, then line) in place."""
    spark = df.sparkSession
    df = df.drop("n_lines", "n_dropped")
    # Counted once and kept, so that every later reader sees the same keys.
    keys = written(repeated_keys(df, min_docs, doc_id, text, max_bits), "repeated-lines")
    schema = T.StructType(list(df.schema) + [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    names = list(df.columns)

    def finish(b: pa.RecordBatch, x: Lines, drop: np.ndarray) -> pa.RecordBatch:
        gone, texts = _rebuilt(x, drop)
        texts = pc.if_else(b.column(text).is_valid(), texts, pa.scalar(None, pa.string()))
        columns = [texts if n == text else b.column(n) for n in names]
        return pa.RecordBatch.from_arrays([*columns, pa.array(x.counts), pa.array(gone)], names=[*names, "n_lines", "n_dropped"])

    if keys.count() <= max_broadcast_keys:
        rows = keys.select("h1", "h2", "first.doc", "first.line").collect()  # bounded just above
        first = {(r.h1, r.h2): (r.doc, r.line) for r in rows} if keep_first else {}
        box = spark.sparkContext.broadcast((np.array([(r.h1, r.h2) for r in rows], np.int64).reshape(-1, 2), first))

        def drop_known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, first = box.value
            order = np.argsort(known[:, 0], kind="stable")
            known = known[order]
            for b in text_slices(batches, text):
                x = Lines(b.column(text))
                h = x.hash.view(np.int64)
                hit = np.zeros(len(h), bool)
                at = np.searchsorted(known[:, 0], h[:, 0])
                while (at < len(known)).any():  # hashes that share the first half lie side by side
                    live = (at < len(known)) & (known[np.minimum(at, len(known) - 1), 0] == h[:, 0])
                    if not live.any():
                        break
                    hit[live] |= known[at[live], 1] == h[live, 1]
                    at = np.where(live, at + 1, len(known))
                drop = (hit & x.filled)[x.key]
                if first:
                    ids, start = b.column(doc_id).to_pylist(), np.cumsum(x.counts) - x.counts
                    for i in np.flatnonzero(drop).tolist():
                        r = x.row[i]
                        if first[tuple(h[x.key[i]].tolist())] == (ids[r], i - start[r]):
                            drop[i] = False
                yield finish(b, x, drop)

        return df.mapInArrow(drop_known, schema)

    # Many keys: find each document's lines to drop by a join, then bring them to it.
    def own_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            x = Lines(b.column(text))
            at = np.flatnonzero(x.filled[x.key])
            h = x.hash[x.key[at]].view(np.int64)
            number = at - np.repeat(np.cumsum(x.counts) - x.counts, x.counts)[at]
            of = pa.array(x.row[at])
            yield pa.record_batch(
                [b.column(doc_id).take(of), b.column("__text").take(of), pa.array(number), pa.array(h[:, 0]), pa.array(h[:, 1])],
                names=["__doc", "__text", "__line", "h1", "h2"],
            )

    kind = df.schema[doc_id].dataType.simpleString()
    marked = df.withColumn("__text", F.xxhash64(text))
    each = marked.select(doc_id, text, "__text").mapInArrow(own_lines, f"__doc {kind}, __text long, __line long, h1 long, h2 long")
    hits = each.join(keys, ["h1", "h2"])
    if keep_first:
        hits = hits.filter(~(F.col("first.doc").eqNullSafe(F.col("__doc")) & (F.col("first.line") == F.col("__line"))))
    drops = hits.groupBy("__doc", "__text").agg(F.collect_set("__line").alias("__drop")).withColumnRenamed("__text", "__t")
    joined = marked.join(drops, F.col(doc_id).eqNullSafe(F.col("__doc")) & (F.col("__text") == F.col("__t")), "left")

    def drop_listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            x = Lines(b.column(text))
            drop, start = np.zeros(len(x.key), bool), np.cumsum(x.counts) - x.counts
            for r, listed in enumerate(b.column("__drop").to_pylist()):
                if listed:
                    drop[start[r] + np.array(listed)] = True
            yield finish(b, x, drop)

    return joined.select(*names, "__drop").mapInArrow(drop_listed, schema)
