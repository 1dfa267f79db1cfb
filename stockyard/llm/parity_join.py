"""Operator 8: near duplicates by a parity-sketch join on word shingles.

A document's set holds its distinct five-word shingles as 64-bit hashes. Sets of
Jaccard similarity 0.75 or more differ in at most (x + y) / 7 shingles, x and y
being their sizes. Shingles are XOR-hashed into a bit sketch: each flips one bit of one
segment, so the sketches of two sets differ in at most as many segments as the
sets differ in shingles (the Hamming distance bounds the symmetric difference from
below). Per size band the sketch has more segments than that bound, so a similar
pair agrees in some segment even among the ``bound + 1`` segments that each set
shows, if all sets choose them in one common order (the pigeonhole principle).
Segments of rare shingles come first in that order, empty ones last; so passages
that many documents share seldom bring documents together. The order rests on a table
of at most ``ORDER_SIZE`` frequent shingles; it decides on work, not on results.

Groups of equal segments yield candidate pairs: all pairs of groups of at most
``SMALL_GROUP`` members, from larger ones a star: everyone with the smallest class of the group,
its head. These pass the Hamming bound on whole sketches, then the exact test on the sets, and
the links join classes to components. What a star leaves apart is settled within blocks, a block
being the members of all groups with one head (every pair of a group is in the block of its
head). A block whose members are in several components is compared in chunks against its
streamed rest, twice: by sketches, which names the members that have another within the bound
in some other component; then, for these, by their whole sets, which go with them. A task
verifies its pairs itself and puts out only those links that join two trees of its own
union-find, so a group of m members yields at most m - 1 rows a chunk, however many of its pairs
come close to the threshold. No group has to fit a task.

Equal sets are one class; a class shows its segments once per task. Classes and
shingles are told apart by 64-bit hashes.

Defined results: words are runs of other characters than space, tab, \\n, \\v, \\f,
\\r, with A-Z lower-cased; fewer than five words are one shingle; a null text or one
without words has the empty set, linked with nothing and its own component; rows
that share an id have a row each, with the component of their own text; a null id is passed on,
links like any other, and its component is the smallest id that is not null (null if there is
none); other columns don't take part; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import blobs, mix64, partitions, text_slices, written
from stockyard.llm.components import components

WORDS = 5
ORDER_SIZE = 1 << 17
HOT = 4096  # a segment whose rarest shingle is that frequent goes the way of hot groups
SMALL_GROUP = 4
CHUNK_BYTES = 8 << 20  # of the sketches or sets that a task holds against the rest of a block
MAX_BROADCAST_IDS = 500_000
_COEF = mix64(np.arange(1, WORDS + 2, dtype=np.uint64)) | np.uint64(1)
_RECORD = np.dtype([("key", "<u8"), ("cls", "<i8"), ("n", "<i4")])


class Sets:
    """Shingle sets of a run of texts: flat sorted hashes, offsets, sizes, classes."""

    def __init__(self, texts: pa.Array):
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
        counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        known = coded.dictionary.cast(pa.binary()).to_pylist()
        codes = np.fromiter(map(xxhash.xxh3_64_intdigest, known), np.uint64, len(known))
        index = coded.indices.to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(texts)), counts)
        if b"" in known:  # white space at the ends of a text
            ok = index != known.index(b"")
            index, row = index[ok], row[ok]
            counts = np.bincount(row, minlength=len(texts))
        word = codes[index] if len(codes) else np.zeros(0, np.uint64)
        start = np.r_[0, np.cumsum(counts)]
        parts, sizes = [], []
        with np.errstate(over="ignore"):
            rolled = np.zeros(max(0, len(word) - WORDS + 1), np.uint64)
            for k in range(WORDS):
                rolled += word[k : k + len(rolled)] * _COEF[k]
            rolled = mix64(rolled)
            for a, b in zip(start.tolist(), start[1:].tolist()):
                if b - a >= WORDS:
                    part = np.unique(rolled[a : b - WORDS + 1])
                elif b > a:
                    part = mix64(np.array([(word[a:b] * _COEF[: b - a]).sum() + _COEF[WORDS] * np.uint64(b - a)], np.uint64))
                else:
                    part = rolled[:0]
                parts.append(part)
                sizes.append(len(part))
            self.size = np.array(sizes, np.int64)
            self.start = np.r_[0, np.cumsum(self.size)]
            self.flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
            self.row = np.repeat(np.arange(len(sizes)), self.size)
            total = np.zeros(len(sizes), np.uint64)
            np.add.at(total, self.row, mix64(self.flat + _COEF[0]))
            self.cls = mix64(total + self.size.astype(np.uint64)).view(np.int64)

    def sketches(self) -> list[bytes]:
        """Parity sketches of two to four bits per shingle (a power of two, 64 at least)."""
        out = []
        for a, n in zip(self.start.tolist(), self.size.tolist()):
            bits = 1 << max(6, int(2 * n - 1).bit_length())
            flips = np.bincount((self.flat[a : a + n] & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
            out.append(np.packbits(flips.astype(np.uint8), bitorder="little").tobytes())
        return out


def distance(a: bytes, b: bytes) -> int:
    """Hamming distance of two sketches, the longer one folded to the shorter's length."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    if len(x) < len(y):
        x, y = y, x
    if len(x) > len(y):
        x = np.bitwise_xor.reduce(x.reshape(-1, len(y)), axis=0)
    return int(np.bitwise_count(x ^ y).sum())


def bound(x, y):
    """Most shingles by which sets of x and y shingles differ at similarity 0.75."""
    return (x + y) // 7


def _level(n: np.ndarray) -> np.ndarray:
    """Size band: 4 ** level <= n."""
    return (np.frexp(np.maximum(n, 1).astype(np.float64))[1] - 1) // 2


class Order:
    """Frequencies of the most frequent shingles; 0 for all others."""

    def __init__(self, shingles: np.ndarray, counts: np.ndarray):
        order = np.argsort(shingles)
        self.shingles, self.counts = shingles[order], counts[order]
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[(shingles >> np.uint64(44)).astype(np.int64)] = True

    def __call__(self, flat: np.ndarray) -> np.ndarray:
        out = np.zeros(len(flat), np.int64)
        some = np.flatnonzero(self.maybe[(flat >> np.uint64(44)).astype(np.int64)])
        if len(some) and len(self.shingles):
            at = np.minimum(np.searchsorted(self.shingles, flat[some]), len(self.shingles) - 1)
            ok = self.shingles[at] == flat[some]
            out[some[ok]] = self.counts[at[ok]]
        return out


def shown_segments(x: Sets, rows: np.ndarray, order: Order) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The segments that the sets ``rows`` show, as (row, key, frequency), once per band."""
    n = x.size[rows]
    own = _level(n)
    lower = _level(-(-3 * n // 4)) < own  # may be the larger one of a pair in the band below
    yield from _band(x, rows, own, bound(n, 4 * n // 3) + 1, order)
    rows, own, n = rows[lower], own[lower], n[lower]
    yield from _band(x, rows, own - 1, bound(4**own - 1, n) + 1, order)


def _band(x: Sets, rows: np.ndarray, level: np.ndarray, show: np.ndarray, order: Order):
    some = show > 1  # else only equal sets are similar, and these are one class
    rows, level, show = rows[some], level[some], show[some]
    if not len(rows):
        return
    segments = 3 * 4**level + 1  # more than the bound of any pair of the band
    n = x.size[rows]
    at = np.repeat(x.start[rows] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    flat, doc = x.flat[at], np.repeat(np.arange(len(rows)), n)
    with np.errstate(over="ignore"):
        place = (mix64(flat ^ _COEF[2]) % segments[doc].astype(np.uint64)).astype(np.int64)
        base = np.r_[0, np.cumsum(segments)]
        cell = base[doc] + place
        by = np.argsort(cell, kind="stable")
        cell, flat = cell[by], flat[by]
        first = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]])
        cell = cell[first]
        parity = np.bitwise_xor.reduceat(mix64(flat + _COEF[3]), first)
        often = np.minimum.reduceat(order(flat), first)
        doc = np.searchsorted(base, cell, side="right") - 1
        place = cell - base[doc]
        held = np.bincount(doc, minlength=len(rows))
        short = np.flatnonzero(held < show)
        if len(short):  # too few segments hold a shingle: empty ones, by number, come last
            ends = np.cumsum(held)
            more_doc, more_place = [], []
            for d in short.tolist():
                free = np.setdiff1d(np.arange(segments[d]), place[ends[d] - held[d] : ends[d]], assume_unique=True)
                free = free[: show[d] - held[d]]
                more_place.append(free)
                more_doc.append(np.full(len(free), d))
            more = np.concatenate(more_doc)
            doc, place = np.r_[doc, more], np.r_[place, np.concatenate(more_place)]
            parity = np.r_[parity, np.zeros(len(more), np.uint64)]
            often = np.r_[often, np.full(len(more), 1 << 40)]
        key = mix64(parity ^ mix64((level[doc].astype(np.uint64) << np.uint64(40)) + place.astype(np.uint64) + _COEF[4]))
    # One common order of all segments: by frequency, then by key; empty ones by number.
    empty = often >= 1 << 40
    tie = np.where(empty, place.astype(np.uint64), key >> np.uint64(1))
    by = np.lexsort((tie, often, doc))
    doc = doc[by]
    rank = np.arange(len(doc)) - np.searchsorted(doc, np.arange(len(rows)))[doc]
    keep = by[rank < show[doc]]
    yield rows[doc[rank < show[doc]]], key[keep], np.where(empty[keep], 0, often[keep])


def _scan(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Rows of two kinds: documents (doc, text_hash, cls, n, sketch), and shingles that three or
    more documents of a run have (cls: the shingle, n: how many)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text, 8 << 20):
            x = Sets(b.column(text))
            k = len(x.size)
            seen, n = np.unique(x.flat, return_counts=True)
            seen, n = seen[n > 2], n[n > 2]
            ids = b.column(doc_id).cast(pa.int64()).to_pylist()
            yield pa.record_batch(
                [
                    pa.array([True] * k + [False] * len(seen)),
                    pa.array(ids + [None] * len(seen), pa.int64()),
                    pa.array(b.column("__hash").to_pylist() + [None] * len(seen), pa.int64()),
                    pa.array(np.r_[x.cls, seen.view(np.int64)]),
                    pa.array(np.r_[x.size, n].astype(np.int64)),
                    pa.array(x.sketches() + [None] * len(seen), pa.binary()),
                ],
                names=["is_doc", "doc", "text_hash", "cls", "n", "sketch"],
            )

    rows = documents.select(doc_id, text, F.xxhash64(text).alias("__hash"))
    return rows.mapInArrow(run, "is_doc boolean, doc long, text_hash long, cls long, n long, sketch binary")


def _member_rows(members: np.ndarray) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(members), 100_000):
        m = members[k : k + 100_000]
        yield pa.record_batch(
            [pa.array(m["key"].copy().view(np.int64)), pa.array(m["cls"].copy()), pa.nulls(len(m), pa.int64()), pa.array(m["n"].astype(np.int64))],
            names=["key", "a", "b", "n"],
        )


def _met(got: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Pairs of the small groups and members of the large ones of a bucket's records."""
    if not got:
        return
    rec = np.concatenate(got)
    rec = rec[np.lexsort((rec["cls"], rec["key"]))]
    same = (rec["key"][1:] == rec["key"][:-1]) & (rec["cls"][1:] == rec["cls"][:-1])
    rec = rec[np.r_[True, ~same]]  # one class from several tasks
    first = np.flatnonzero(np.r_[True, rec["key"][1:] != rec["key"][:-1]])
    sizes = np.diff(np.r_[first, len(rec)])
    group = np.repeat(np.arange(len(first)), sizes)
    rec, group = rec[sizes[group] > 1], group[sizes[group] > 1]
    large = sizes[group] > SMALL_GROUP
    pairs = []
    for d in range(1, SMALL_GROUP):
        i = np.flatnonzero((group[:-d] == group[d:]) & ~large[:-d])
        if not len(i):
            break
        small, big = np.minimum(rec["n"][i], rec["n"][i + d]), np.maximum(rec["n"][i], rec["n"][i + d])
        i = i[4 * small.astype(np.int64) >= 3 * big.astype(np.int64)]
        pairs.append(np.stack([rec["cls"][i], rec["cls"][i + d]], axis=1))
    if pairs:
        both = np.unique(np.concatenate(pairs), axis=0)
        for k in range(0, len(both), 100_000):
            p = both[k : k + 100_000]
            none = pa.nulls(len(p), pa.int64())
            yield pa.record_batch([none, pa.array(p[:, 0]), pa.array(p[:, 1]), none], names=["key", "a", "b", "n"])
    yield from _member_rows(rec[large])


def _candidates(documents: DataFrame, text: str, order: Order) -> DataFrame:
    """(key, a, b, n): pairs of classes a < b that share a segment (key null), and members
    (a, n) of large or hot groups by key (b null)."""
    spark = documents.sparkSession
    parts = partitions(spark)
    buckets = 8 * parts
    box = spark.sparkContext.broadcast(order)

    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in text_slices(batches, text):
            x = Sets(b.column(text))
            fresh = []
            for k, (c, n) in enumerate(zip(x.cls.tolist(), x.size.tolist())):
                if n and c not in done:
                    done.add(c)
                    fresh.append(k)
            for rows, key, often in shown_segments(x, np.array(fresh, np.int64), box.value):
                rec = np.empty(len(key), _RECORD)
                rec["key"], rec["cls"], rec["n"] = key, x.cls[rows], x.size[rows]
                hot = often >= HOT
                yield from blobs(rec[~hot], (rec["key"][~hot] % np.uint64(buckets)).astype(np.int64), False)
                # Members of hot groups only pass through, so they are dealt out by class.
                yield from blobs(rec[hot], (mix64(rec["cls"][hot].copy().view(np.uint64)) % np.uint64(buckets)).astype(np.int64), True)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, got = None, []  # one bucket at a time
        for b in batches:
            for bucket, is_hot, blob in zip(*(b.column(c).to_pylist() for c in ("bucket", "hot", "blob"))):
                rec = np.frombuffer(blob, _RECORD)
                if is_hot:
                    yield from _member_rows(rec)
                    continue
                if bucket != at:
                    yield from _met(got)
                    at, got = bucket, []
                got.append(rec)
        yield from _met(got)

    shown = documents.select(text).mapInArrow(show, "bucket int, hot boolean, blob binary")
    dealt = shown.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(meet, "key long, a long, b long, n long")


def _sets(classes: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(cls, items): the whole sets of ``classes`` (cls, rep), one row each. Texts are found by
    the smallest id of the class; classes without an id among all rows that have none."""
    needed = written(classes.select(F.col("rep").alias("__id")).distinct(), "near-ids")
    some = needed.filter("__id is not null")
    if some.count() <= MAX_BROADCAST_IDS:  # 8 bytes each; more are joined
        some = F.broadcast(some)
    rows = documents.select(doc_id, text)
    found = rows.join(some, F.col(doc_id) == F.col("__id")).select(text)
    if not needed.filter("__id is null").isEmpty():
        found = found.unionByName(rows.filter(F.col(doc_id).isNull()).select(text))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: set[int] = set()
        for b in text_slices(batches, text):
            x = Sets(b.column(text))
            raw, at = x.flat.tobytes(), (x.start * 8).tolist()
            fresh = [k for k, c in enumerate(x.cls.tolist()) if x.size[k] and not (c in done or done.add(c))]
            items = [raw[at[k] : at[k + 1]] for k in fresh]
            yield pa.record_batch([pa.array(x.cls[fresh]), pa.array(items, pa.binary())], names=["cls", "items"])

    whole = found.mapInArrow(sets, "cls long, items binary").join(classes.select("cls"), "cls", "left_semi")
    return whole.groupBy("cls").agg(F.first("items").alias("items"))  # a row that repeats, from several tasks


def _similar(s: bytes, t: bytes) -> bool:
    s, t = np.frombuffer(s, np.uint64), np.frombuffer(t, np.uint64)
    shared = len(np.intersect1d(s, t, assume_unique=True))
    return 100 * shared >= 75 * (len(s) + len(t) - shared)


def _verified(pairs: DataFrame, classes: DataFrame, documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    """Of the pairs (a, b) of classes those that are similar, as (u, v)."""
    side = lambda s: classes.select(F.col("cls").alias(s), F.col("n").alias(f"{s}_n"), F.col("sketch").alias(f"{s}_sketch"))
    known = pairs.join(side("a"), "a").join(side("b"), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols = [b.column(c).to_pylist() for c in ("a_sketch", "b_sketch", "a_n", "b_n")]
            ok = [4 * min(m, n) >= 3 * max(m, n) and distance(s, t) <= bound(m, n) for s, t, m, n in zip(*cols)]
            yield pa.record_batch([b.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], names=["a", "b"])

    left = written(known.mapInArrow(near, "a long, b long"), "near-pairs")
    ends = left.select(F.col("a").alias("cls")).unionByName(left.select(F.col("b").alias("cls"))).distinct()
    whole = written(_sets(classes.join(ends, "cls", "left_semi").select("cls", "rep"), documents, doc_id, text), "near-sets")
    both = left.join(whole.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a").join(whole.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = [_similar(s, t) for s, t in zip(b.column("x").to_pylist(), b.column("y").to_pylist())]
            yield pa.record_batch([b.column(c).filter(pa.array(ok, pa.bool_())) for c in ("a", "b")], names=["u", "v"])

    return both.select("a", "b", "x", "y").mapInArrow(exact, "u long, v long")


def _linked(documents: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """The documents (doc, text_hash, cls, n), and (node, root): the component of every class
    that has a link."""
    scan = written(_scan(documents, doc_id, text), "shingle-sets")
    docs = scan.filter("is_doc").select("doc", "text_hash", "cls", "n", "sketch")
    frequent = scan.filter("not is_doc").groupBy("cls").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "cls").limit(ORDER_SIZE)
    rows = frequent.toArrow()  # at most ORDER_SIZE rows
    order = Order(rows.column("cls").to_numpy().view(np.uint64), rows.column("n").to_numpy())
    # A class's text is found by its smallest document; sizes and sketches follow from the class.
    classes = docs.filter("n > 0").groupBy("cls").agg(F.min("doc").alias("rep"), F.min("n").alias("n"), F.min("sketch").alias("sketch"))
    classes = written(classes, "classes")
    found = written(_candidates(documents, text, order), "candidates")
    members = found.filter("b is null").select("key", F.col("a").alias("cls"), "n")
    # Large groups: everyone with the smallest class of the group, once for all groups it heads.
    heads = members.groupBy("key").agg(F.min("cls").alias("head"))
    blocks = written(members.join(heads, "key").select("head", "cls").distinct(), "near-blocks")
    star = blocks.filter("cls <> head").select(F.col("head").alias("a"), F.col("cls").alias("b"))
    pairs = found.filter("b is not null").select("a", "b").unionByName(star).distinct()
    edges = _verified(pairs, classes, documents, doc_id, text)
    roots = written(components(written(edges, "near-edges")), "near-roots")
    rest = _apart(blocks, classes, roots, "sketch", CHUNK_BYTES, _has_near)
    if rest is not None:
        rest = written(rest.distinct(), "near-rest")  # (head, cls)
        ends = classes.join(rest.select("cls").distinct(), "cls", "left_semi")
        whole = written(_sets(ends.select("cls", "rep"), documents, doc_id, text), "near-sets")
        sized = classes.select("cls", "n").join(whole, "cls")
        more = _apart(rest, sized, roots, "items", CHUNK_BYTES, _joining)
        if more is not None:
            # The components so far stand for the links that made them.
            known = roots.filter("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))
            more = written(more.select(F.col("head").alias("u"), F.col("cls").alias("v")), "near-edges")
            roots = written(components(known.unionByName(more)), "near-roots")
    return docs.drop("sketch"), roots


def near_duplicates(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id that
    links lead to)."""
    docs, roots = _linked(documents, doc_id, text)
    placed = docs.join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    least = placed.filter("n > 0").groupBy("root").agg(F.min("doc").alias("least"))
    out = placed.join(least, "root", "left")
    return out.select(F.col("doc").alias(doc_id), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("least")).otherwise(F.col("doc")).alias("component_id"))


def _apart(blocks: DataFrame, classes: DataFrame, roots: DataFrame, load: str, chunk_bytes: int, compare) -> DataFrame | None:
    """What ``compare`` finds, as (head, cls), in the blocks (head, cls) with members of several
    components: for each chunk, members outside the block's largest component (whose ``load``s
    have ``chunk_bytes`` together) against all. None if there is no such block."""
    of = classes.select("cls").join(roots, F.col("cls") == F.col("node"), "left").select("cls", F.coalesce("root", "cls").alias("root"))
    placed = blocks.join(of, "cls")
    split = placed.groupBy("head").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).filter("lo <> hi").select("head")
    placed = placed.join(split, "head", "left_semi").join(classes.select("cls", "n", F.octet_length(load).alias("size")), "cls")
    placed = written(placed, "near-apart")
    if placed.isEmpty():
        return None
    sizes = placed.groupBy("head", "root").agg(F.count(F.lit(1)).alias("m"), F.sum("size").alias("size"))
    most = F.max(F.struct("m", "root", "size"))
    per = sizes.groupBy("head").agg(most.alias("main"), F.sum("size").alias("all"))
    per = per.select("head", F.col("main.root").alias("main"), F.ceil((F.col("all") - F.col("main.size")) / chunk_bytes).cast("int").alias("chunks"))
    rows = placed.join(per, "head").join(classes.select("cls", load), "cls")
    own = rows.filter("root <> main").select("head", F.pmod(F.xxhash64("cls"), "chunks").cast("int").alias("chunk"), F.lit(0).alias("side"), "cls", "n", "root", load)
    all_ = rows.select("head", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("side"), "cls", "n", "root", load)
    dealt = own.unionByName(all_).repartition(partitions(blocks.sparkSession), "head", "chunk").sortWithinPartitions("head", "chunk", "side")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, work = None, [], None
        for b in text_slices(batches, load):
            head, chunk, side = (b.column(c).to_numpy() for c in ("head", "chunk", "side"))
            cuts = np.flatnonzero(np.r_[True, (head[1:] != head[:-1]) | (chunk[1:] != chunk[:-1]) | (side[1:] != side[:-1])])
            for i, j in zip(cuts.tolist(), [*cuts[1:].tolist(), len(head)]):
                if at != (head[i], chunk[i]):
                    if work is not None:
                        yield from _found(at[0], work.end())
                    at, held, work = (head[i], chunk[i]), [], None
                part = [b.column(c).slice(i, j - i) for c in ("cls", "n", "root")]
                rows = (*(x.to_numpy() for x in part), b.column(load).slice(i, j - i).to_pylist())
                if side[i] == 0:
                    held.append(rows)
                elif held:  # else no member was dealt to this chunk
                    if work is None:
                        work = compare(_side(held))
                    yield from _found(at[0], work.against(_side([rows])))
        if work is not None:
            yield from _found(at[0], work.end())

    return dealt.mapInArrow(run, "head long, cls long")


def _found(head: int, pairs: list[tuple[int | None, int]]) -> Iterator[pa.RecordBatch]:
    if pairs:
        first = [head if a is None else a for a, _ in pairs]
        yield pa.record_batch([pa.array(first, pa.int64()), pa.array([b for _, b in pairs], pa.int64())], names=["head", "cls"])


def _side(parts: list[tuple]) -> tuple:
    cls, n, root, load = zip(*parts)
    return np.concatenate(cls), np.concatenate(n).astype(np.int64), np.concatenate(root), [x for part in load for x in part]


def _near(x: tuple, y: tuple, sx: np.ndarray, sy: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(index in x, index in y, distance) of pairs of different components whose sketches are
    within the bound, some at a time."""
    step = max(1, (1 << 21) // max(1, sx.size))
    for k in range(0, len(sy), step):
        far = np.bitwise_count(sx[:, None, :] ^ sy[None, k : k + step, :]).sum(axis=2, dtype=np.int64)
        m, n = x[1][:, None], y[1][None, k : k + step]
        i, j = np.nonzero((far <= bound(m, n)) & (4 * np.minimum(m, n) >= 3 * np.maximum(m, n)) & (x[2][:, None] != y[2][None, k : k + step]))
        yield i, k + j, far[i, j]


class _has_near:
    """Names the members of a chunk and of the rest that come within the bound of a member of
    another component, by their sketches."""

    def __init__(self, held: tuple):
        self.held, self.near = held, set()
        self.words = min(map(len, held[3])) // 8
        self.sketch = _folded(held[3], self.words)

    def against(self, rest: tuple) -> list[tuple[None, int]]:
        words = min(self.words, min(map(len, rest[3])) // 8)
        sx = self.sketch if words == self.words else _folded(self.held[3], words)
        found: set[int] = set()
        for i, j, _ in _near(self.held, rest, sx, _folded(rest[3], words)):
            self.near.update(self.held[0][np.unique(i)].tolist())
            found.update(rest[0][np.unique(j)].tolist())
        return [(None, c) for c in found]

    def end(self) -> list[tuple[None, int]]:
        return [(None, c) for c in self.near]


class _joining:
    """Links between members of a chunk and the rest that join two trees, verified on whole
    sets. Sketches of 16 bits a shingle, made for the chunk at hand, come before the sets."""

    def __init__(self, held: tuple):
        self.held, self.parent = held, {}
        self.level = _level(held[1])

    def root(self, x: int) -> int:
        while self.parent.setdefault(x, x) != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def against(self, rest: tuple) -> list[tuple[int, int]]:
        out = []
        levels = _level(rest[1])
        for level in np.unique(self.level).tolist():
            mine, theirs = np.flatnonzero(self.level == level), np.flatnonzero(abs(levels - level) <= 1)
            if not len(theirs):
                continue
            x, y = _picked(self.held, mine), _picked(rest, theirs)
            bits = 16 << (2 * (level + 1))
            for i, j, far in _near(x, y, _fine(x[3], bits), _fine(y[3], bits)):
                for k in np.argsort(far, kind="stable").tolist():  # the closest first: they join most
                    a, b = int(i[k]), int(j[k])
                    u, v = self.root(int(x[2][a])), self.root(int(y[2][b]))
                    if u != v and _similar(x[3][a], y[3][b]):
                        self.parent[max(u, v)] = min(u, v)
                        out.append((int(x[0][a]), int(y[0][b])))
        return out

    def end(self) -> list[tuple[int, int]]:
        return []


def _picked(side: tuple, at: np.ndarray) -> tuple:
    return side[0][at], side[1][at], side[2][at], [side[3][k] for k in at.tolist()]


def _fine(sets: list[bytes], bits: int) -> np.ndarray:
    """Parity sketches of ``bits`` bits of whole sets."""
    out = np.zeros((len(sets), bits // 64), np.uint64)
    for k, items in enumerate(sets):
        place = np.frombuffer(items, np.uint64) & np.uint64(bits - 1)
        np.bitwise_xor.at(out[k], (place >> np.uint64(6)).astype(np.int64), np.uint64(1) << (place & np.uint64(63)))
    return out


def _folded(sketches: list[bytes], words: int) -> np.ndarray:
    return np.stack([np.bitwise_xor.reduce(np.frombuffer(s, np.uint64).reshape(-1, words), axis=0) for s in sketches])


def keep_one(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each group of near duplicates: that of the smallest id (null ids last; then by
    a hash of the text), decided by id and text together, so another text under the same id has
    its own fate. Of rows that repeat both, one stays. Rows without words stay."""
    docs, roots = _linked(documents, doc_id, text)
    placed = docs.filter("n > 0").join(roots, F.col("cls") == F.col("node"), "left").withColumn("root", F.coalesce("root", "cls"))
    rows = written(placed.groupBy("root", "doc", "text_hash").agg(F.count(F.lit(1)).alias("rows")), "near-rows")
    first = F.struct(F.col("doc").isNull().alias("none"), "doc", "text_hash")
    best = rows.groupBy("root").agg(F.min(first).alias("best")).select("root", F.col("best.doc").alias("best_doc"), F.col("best.text_hash").alias("best_hash"))
    judged = rows.join(best, "root").withColumn("stays", F.col("doc").eqNullSafe(F.col("best_doc")) & (F.col("text_hash") == F.col("best_hash")))
    same = lambda df: [F.col(doc_id).eqNullSafe(F.col("__id")), F.xxhash64(text) == F.col("__hash")]
    named = judged.select(F.col("doc").alias("__id"), F.col("text_hash").alias("__hash"), "stays", "rows")
    gone = written(named.filter(~F.col("stays")).select("__id", "__hash"), "near-gone")
    if gone.count() <= MAX_BROADCAST_IDS:  # 16 bytes each; more are joined
        gone = F.broadcast(gone)
    kept = documents.join(gone, same(gone), "left_anti")
    again = written(named.filter(F.col("stays") & (F.col("rows") > 1)).select("__id", "__hash"), "near-again")
    if again.isEmpty():
        return kept
    repeated = kept.join(again, same(again), "left_semi").withColumn("__hash", F.xxhash64(text)).dropDuplicates([doc_id, "__hash"])
    return kept.join(again, same(again), "left_anti").unionByName(repeated.drop("__hash"))
