"""Operator 4: removal of repeated byte strings by blockwise suffix sorting.

Every byte string of 100 bytes (a window, the head of a suffix) that also starts
earlier loses its bytes. Windows are told apart bucket by bucket:

* A window's *anchor* is the 32-byte string of smallest hash in it, so equal windows
  have equal anchors at equal places. Windows in a row with one anchor form a run;
  a run with all the bytes of its windows is a context. A suffix bucket holds the
  runs of one anchor (about one run for 35 bytes of text).
* Runs with the same context collapse to the earliest one, in each task before the
  shuffle and again after it; the others are repeats as a whole. So a bucket has one
  run per distinct context, however many copies of a text there are. Buckets with
  one context are done; the contexts of the others are fetched from the texts.
* A bucket with more contexts than a block holds (a line of less than 100 bytes that many
  texts have between different neighbours) is split: its windows are dealt one by one, by
  two fingerprints of their 100 bytes, the anchor and its distance, which equal windows
  share. Equal ones collapse in each task before that shuffle; after it they come in
  order, each compared with the first of its kind. In the first shuffle too, runs of an
  anchor with ``SPLIT`` or more contexts in one slice of texts are dealt by anchor and
  context; runs of an anchor with fewer in a slice go by the anchor (34 bytes a run).
* The other buckets' windows are sorted one block of buckets at a time, so memory is
  bounded by the block: by the fingerprints of their first and last 32 bytes, and, where these
  tie, by the ranks of a difference-cover sample. The cover has 6 of every 31
  positions and holds, for any two windows, places at the same distance behind
  both; the ranks of the 68 bytes from there decide. Only the sample is ranked. A
  three-way partition around one member splits all groups of ties at once.

Strings are compared by 64-bit fingerprints of 32 bytes; only equality matters here, so
a block's order is that of fingerprints and ranks.

Defined results: a null text counts as empty; order is (doc_id, start), a null
doc_id before all others; rows that repeat an id and a text are the same document and get the
same result; strings of rows that share an id but not the text count as earlier only by their
start; other columns don't take part; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import binary_parts, blobs, mix64, partitions, text_slices, written

WINDOW, GRAM = 100, 32
#: A perfect difference set, any two residues mod 31 share a distance to it.
PERIOD, COVER = 31, (0, 1, 3, 8, 12, 18)
SAMPLE_LENGTH = 68
BLOCK_BYTES = 4 << 20
#: Bytes of a context and its columns in a block, at most.
CONTEXT_BYTES = 256
SPLIT, _SPLIT_BIT = 8, 128
_NO_ID = -(2**63)
_RUN = np.dtype([("key", "<u8"), ("ctx", "<u8"), ("doc", "<i8"), ("tag", "<i4"), ("lo", "<i4"), ("runs", "u1"), ("off", "u1")])
_SPAN = "doc long, tag int, start int, stop int"


def grams(raw: np.ndarray) -> np.ndarray:
    """Hash of the GRAM bytes from every place that has so many behind it."""
    with np.errstate(over="ignore"):
        h = (raw.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        step, odd = 1, np.uint64(0xD6E8FEB86659FD93)
        while step < GRAM:
            h = (h[:-step] * odd) + (h[step:] ^ (h[step:] >> np.uint64(29)))
            step, odd = step * 2, odd * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(2)
        return mix64(h)


def _anchors(h: np.ndarray, piece: int = 1 << 24) -> np.ndarray:
    """The place of the anchor of the window at each place: least by the leading 40 bits of
    its hash, then leftmost. Taken in pieces in which a place fits the other 24 bits, so the rule is
    the same for texts of any length."""
    need = WINDOW - GRAM + 1
    out = np.empty(max(0, len(h) - need + 1), np.int64)
    for a in range(0, len(out), piece - need + 1):
        part = h[a : a + piece]
        least, have = (part & ~np.uint64((1 << 24) - 1)) | np.arange(len(part), dtype=np.uint64), 1
        n = len(part) - need + 1
        while have * 2 <= need:
            least = np.minimum(least[:-have], least[have:])
            have *= 2
        least = np.minimum(least[:n], least[need - have : need - have + n])
        out[a : a + n] = a + (least & np.uint64((1 << 24) - 1)).astype(np.int64)
    return out


def runs_of(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one anchor in texts that lie behind each other: text, first
    window (place in ``raw``), number of windows, anchor's distance, and all hashes."""
    none = np.zeros(0, np.int64)
    if len(raw) < WINDOW:
        return none, none, none, none, np.zeros(0, np.uint64)
    h = grams(raw)
    anchor = _anchors(h)
    ends = np.repeat(off[1:], np.diff(off))[: len(anchor)]
    start = np.flatnonzero(np.arange(len(anchor)) + WINDOW <= ends)
    if not len(start):
        return none, none, none, none, h
    at = anchor[start]
    new = np.flatnonzero(np.r_[True, (at[1:] != at[:-1]) | (np.diff(start) != 1)])
    lo = start[new]
    count = np.diff(np.r_[new, len(start)])
    return np.searchsorted(off, lo, side="right") - 1, lo, count, at[new] - lo, h


def _contexts(h: np.ndarray, lo: np.ndarray, count: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Fingerprint of each run's context: hashes that cover it, its length and the anchor's
    place."""
    last = lo + count - 1 + WINDOW - GRAM
    with np.errstate(over="ignore"):
        out = mix64((count * 256 + off).astype(np.uint64))
        for k in range(0, WINDOW + 96, GRAM):
            out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + h[np.minimum(lo + k, last)])
    return out


def _earliest(rec: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of runs with equal key and context the earliest, and all later ones."""
    if not len(rec):
        return rec, rec
    rec = rec[np.lexsort((rec["lo"], rec["doc"], rec["ctx"], rec["key"]))]
    new = np.r_[True, (rec["key"][1:] != rec["key"][:-1]) | (rec["ctx"][1:] != rec["ctx"][:-1])]
    head = np.flatnonzero(new)[np.cumsum(new) - 1]
    same = (rec["doc"] == rec["doc"][head]) & (rec["lo"] == rec["lo"][head])  # a repeated row is no repeat
    return rec[new], rec[~same]


def _many(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of sorted keys: which occur ``SPLIT`` times or more, and the first place of each
    of these."""
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
    n = np.diff(np.r_[first, len(key)])
    return np.repeat(n >= SPLIT, n), first[n >= SPLIT]


def _span_batches(doc, tag, start, stop, size: int = 200_000) -> Iterator[pa.RecordBatch]:
    for k in range(0, len(doc), size):
        s = slice(k, k + size)
        yield pa.record_batch(
            [pa.array(doc[s].astype(np.int64)), pa.array(tag[s].astype(np.int32)), pa.array(start[s].astype(np.int32)), pa.array(stop[s].astype(np.int32))],
            names=["doc", "tag", "start", "stop"],
        )


def _runs(documents: DataFrame) -> DataFrame:
    """First shuffle: spans of repeats, and one run of each context of a key with several
    (then with key and the rest of the run)."""
    parts = partitions(documents.sparkSession)
    buckets = 8 * parts

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text", 2 << 20):
            off, raw = binary_parts(b.column("text"))
            text, lo, count, away, h = runs_of(raw, off)
            if not len(lo):
                continue
            rec = np.empty(len(lo), _RUN)
            rec["key"], rec["ctx"] = h[lo + away], _contexts(h, lo, count, away)
            rec["doc"] = b.column("doc").to_numpy()[text]
            rec["tag"] = b.column("tag").to_numpy()[text]
            rec["lo"], rec["runs"], rec["off"] = lo - off[text], count, away
            first, later = _earliest(rec)
            many, heads = _many(first["key"])
            first["off"][many] |= _SPLIT_BIT
            with np.errstate(over="ignore"):
                deal = np.where(many, mix64(first["key"] * np.uint64(3) + first["ctx"]), first["key"])
            # The rest of such a key, from other slices, must learn that it has several contexts.
            sign = first[heads]
            sign["runs"] = 0
            yield from blobs(np.concatenate([first, sign]), (np.r_[deal, sign["key"]] % np.uint64(buckets)).astype(np.int64), False)
            # Decided already, these only pass through, dealt out by document.
            yield from blobs(later, (mix64(later["doc"].copy().view(np.uint64)) % np.uint64(buckets)).astype(np.int64), True)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got, passing = [np.empty(0, _RUN)], [np.empty(0, _RUN)]
        for b in batches:
            for done, blob in zip(b.column("hot").to_pylist(), b.column("blob").to_pylist()):
                (passing if done else got).append(np.frombuffer(blob, _RUN))
        rec = np.concatenate(got)
        signs = np.unique(rec["key"][rec["runs"] == 0])
        rec, later = _earliest(rec[rec["runs"] > 0])
        later = np.concatenate([*passing, later])
        key = rec["key"]
        several = (rec["off"] >= _SPLIT_BIT) | np.isin(key, signs)
        rec["off"] &= _SPLIT_BIT - 1
        if len(rec) > 1:
            same = key[1:] == key[:-1]
            several[1:] |= same
            several[:-1] |= same
        ask = rec[several]
        for kind, x in ((False, later), (True, ask)):
            for k in range(0, len(x), 100_000):
                r = x[k : k + 100_000]
                yield pa.record_batch(
                    [
                        pa.array([kind] * len(r)), pa.array(r["key"].copy().view(np.int64)), pa.array(r["doc"].copy()), pa.array(r["tag"].copy()), pa.array(r["lo"].copy()),
                        pa.array(r["runs"].astype(np.int32)), pa.array(r["off"].astype(np.int32)),
                    ],
                    names=["ask", "key", "doc", "tag", "lo", "runs", "off"],
                )

    found = documents.mapInArrow(find, "bucket int, hot boolean, blob binary").repartition(parts, "bucket")
    return found.mapInArrow(meet, "ask boolean, key long, doc long, tag int, lo int, runs int, off int")


_CONTEXT, _WINDOW, _DONE = range(3)


def _split(asked: DataFrame) -> DataFrame:
    """The asked runs; ``split`` where the bucket has more contexts than a block holds."""
    large = asked.groupBy("key").count().filter(F.col("count") > max(1, BLOCK_BYTES // CONTEXT_BYTES)).select("key", F.lit(True).alias("split"))
    return asked.join(large, "key", "left").withColumn("split", F.coalesce("split", F.lit(False)))


def _windows(contexts: list[bytes], key, lo, runs, off) -> tuple[np.ndarray, ...]:
    """Of each window of these runs: its run, its place in the text, and two fingerprints of
    its bytes, its anchor and the anchor's distance."""
    size = runs - 1 + WINDOW
    h = grams(np.frombuffer(b"".join(contexts), np.uint8))
    of = np.repeat(np.arange(len(runs)), runs)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(runs) - runs, runs)
    begin = lo[of] + nth
    at = (np.cumsum(size) - size)[of] + nth
    out = []
    with np.errstate(over="ignore"):
        for odd in (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)):
            x = mix64(key.view(np.uint64)[of] * odd + (off[of] - nth).astype(np.uint64))
            for k in (*range(0, WINDOW - GRAM, GRAM), WINDOW - GRAM):
                x = mix64(x * odd + h[at + k])
            out.append(x.view(np.int64))
    return of, begin, *out


def _fetched(asked: DataFrame, documents: DataFrame) -> DataFrame:
    """The asked runs with their contexts' bytes; of split buckets the windows, with their
    fingerprints as key and sub, and those that are repeats already."""
    asked = _split(asked)
    run = F.struct("key", "lo", "runs", "off", "split")
    per_doc = asked.groupBy("doc", "tag").agg(F.collect_list(run).alias("asked"))
    joined = documents.join(per_doc, ["doc", "tag"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            lists = b.column("asked")
            n = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
            flat = lists.flatten()
            key, lo, runs, off, split = (flat.field(k).to_numpy(zero_copy_only=False) for k in range(5))
            row = np.repeat(np.arange(b.num_rows), n)
            doc, tag = b.column("doc").to_numpy()[row], b.column("tag").to_numpy()[row]
            texts = [t.encode() for t in b.column("text").to_pylist()]
            bytes_ = lambda w: [texts[r][a : a + c - 1 + WINDOW] for r, a, c in zip(row[w].tolist(), lo[w].tolist(), runs[w].tolist())]  # noqa: E731, B023
            w = np.flatnonzero(~split)
            yield rows(_CONTEXT, key[w], np.zeros(len(w), np.int64), doc[w], tag[w], lo[w], runs[w], off[w], pa.array(bytes_(w), pa.binary()))
            large = np.flatnonzero(split)
            for k in range(0, len(large), 4096):
                w = large[k : k + 4096]
                of, begin, key_, sub = _windows(bytes_(w), key[w], lo[w], runs[w], off[w])
                doc_, tag_ = doc[w][of], tag[w][of]
                by = np.lexsort((begin, doc_, sub, key_))
                repeat = np.zeros(len(by), bool)
                repeat[by], _ = _behind(key_[by], sub[by], doc_[by], begin[by], None)
                x, hit = np.flatnonzero(~repeat), np.flatnonzero(repeat)
                one, zero = np.ones(len(x), np.int64), np.zeros(len(x), np.int64)
                yield rows(_WINDOW, key_[x], sub[x], doc_[x], tag_[x], begin[x], one, zero, pa.nulls(len(x), pa.binary()))
                # Decided already, these only pass through, dealt out by document.
                new = np.flatnonzero(np.r_[True, (np.diff(hit) != 1) | (np.diff(of[hit]) != 0)][: len(hit)])
                x, n = hit[new], np.diff(np.r_[new, len(hit)])
                yield rows(_DONE, mix64(doc_[x].view(np.uint64)).view(np.int64), sub[x], doc_[x], tag_[x], begin[x], n, np.zeros(len(x), np.int64), pa.nulls(len(x), pa.binary()))

    def rows(kind, key, sub, doc, tag, lo, runs, off, ctx) -> pa.RecordBatch:
        ints = [pa.array(x.astype(np.int32)) for x in (tag, lo, runs, off)]
        return pa.record_batch(
            [pa.array(np.full(len(key), kind, np.int32)), pa.array(key), pa.array(sub), pa.array(doc), *ints, ctx],
            names=["kind", "key", "sub", "doc", "tag", "lo", "runs", "off", "ctx"],
        )

    kept = "kind int, key long, sub long, doc long, tag int, lo int, runs int, off int, ctx binary"
    return joined.select("doc", "tag", "text", "asked").mapInArrow(cut, kept)


def _behind(key, sub, doc, begin, head: tuple | None) -> tuple[np.ndarray, tuple | None]:
    """Which of the sorted windows are not the first of their kind (a repeated row is no
    repeat), and the first of the last kind; ``head`` is that of the rows before."""
    if not len(key):
        return np.zeros(0, bool), head
    new = np.r_[True, (key[1:] != key[:-1]) | (sub[1:] != sub[:-1])]
    first = np.flatnonzero(new)[np.cumsum(new) - 1]
    first_doc, first_begin = doc[first], begin[first]
    if head and head[:2] == (key[0], sub[0]):
        first_doc[first == 0], first_begin[first == 0] = head[2:]
    return (doc != first_doc) | (begin != first_begin), (key[-1], sub[-1], first_doc[-1], first_begin[-1])


_DELTA = np.array(
    [[next((d for d in range(PERIOD) if (a + d) % PERIOD in COVER and (b + d) % PERIOD in COVER), -1) for b in range(PERIOD)] for a in range(PERIOD)]
)


def equal_windows(raw: np.ndarray, start: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """Classes of equal windows: the same number for two windows of one bucket if their
    WINDOW bytes are equal."""
    h = grams(np.r_[raw, np.zeros(WINDOW, np.uint8)])
    with np.errstate(over="ignore"):
        ends = mix64(bucket.astype(np.uint64) + mix64(h[start]) * np.uint64(3) + h[start + WINDOW - GRAM])
        # The cover sample: ranks of the SAMPLE_LENGTH bytes from each of its places.
        place = np.flatnonzero(np.isin(np.arange(len(raw)) % PERIOD, COVER))
        fits = place[place + SAMPLE_LENGTH <= len(raw)]
        word = mix64(h[fits] * np.uint64(3) + mix64(h[fits + GRAM]) * np.uint64(5) + h[fits + SAMPLE_LENGTH - GRAM])
    rank = np.full(len(raw), -1, np.int64)
    rank[fits] = np.unique(word, return_inverse=True)[1]
    order = np.argsort(ends, kind="stable")
    new = np.r_[True, ends[order[1:]] != ends[order[:-1]]]
    group = np.empty(len(start), np.int64)
    group[order] = np.cumsum(new) - 1
    out = np.full(len(start), -1, np.int64)
    todo, next_class = order, 0  # todo: members of groups of ties, group by group
    while len(todo):
        g = group[todo]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        pivot = start[todo[np.repeat(first, np.diff(np.r_[first, len(todo)]))]]
        own = start[todo]
        d = _DELTA[own % PERIOD, pivot % PERIOD]
        side = np.sign(rank[own + d] - rank[pivot + d])
        number = np.cumsum(np.r_[True, g[1:] != g[:-1]]) - 1
        same = side == 0
        out[todo[same]] = next_class + number[same]
        next_class += number[-1] + 1
        rest, part = todo[~same], number[~same] * 2 + (side[~same] > 0)
        by = np.argsort(part, kind="stable")
        todo = rest[by]
        group[todo] = part[by]
    return out


def _bucket_spans(contexts: DataFrame) -> DataFrame:
    """Sort the buckets' windows; spans of those that are not the first of their class."""
    parts = partitions(contexts.sparkSession)

    def spans(block: pa.Table) -> Iterator[pa.RecordBatch]:
        off, raw = binary_parts(block.column("ctx").combine_chunks().cast(pa.large_binary()))
        key, doc, tag, lo, runs = (block.column(c).to_numpy() for c in ("key", "doc", "tag", "lo", "runs"))
        rec = np.repeat(np.arange(len(runs)), runs)
        nth = np.arange(len(rec)) - np.repeat(np.cumsum(runs) - runs, runs)
        at = off[rec] + nth
        # Equal windows have their anchor at the same distance.
        away = block.column("off").to_numpy()[rec] - nth
        with np.errstate(over="ignore"):
            bucket = mix64(key.view(np.uint64)[rec] * np.uint64(3) + away.astype(np.uint64))
        cls = equal_windows(raw, at, bucket)
        begin = lo[rec] + nth
        by = np.lexsort((begin, doc[rec], cls))
        head = np.flatnonzero(np.r_[True, cls[by][1:] != cls[by][:-1]])
        of = by[head[np.cumsum(np.r_[True, cls[by][1:] != cls[by][:-1]]) - 1]]
        repeat = np.zeros(len(rec), bool)
        repeat[by] = (doc[rec[by]] != doc[rec[of]]) | (begin[by] != begin[of])
        hit = np.flatnonzero(repeat)
        if len(hit):
            new = np.r_[True, (np.diff(hit) != 1) | (np.diff(rec[hit]) != 0)]
            first, last = hit[new], hit[np.r_[np.flatnonzero(new)[1:] - 1, len(hit) - 1]]
            yield from _span_batches(doc[rec[first]], tag[rec[first]], begin[first], begin[last] + WINDOW)

    def sort_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, head = [], 0, None
        for b in batches:  # in order of the kinds and keys
            kind = b.column("kind").to_numpy()
            split = b.slice(int(np.searchsorted(kind, _WINDOW)))
            b = b.slice(0, b.num_rows - split.num_rows)
            if split.num_rows:
                key, sub, doc, tag, lo, runs = (split.column(c).to_numpy() for c in ("key", "sub", "doc", "tag", "lo", "runs"))
                n = int(np.searchsorted(kind, _DONE)) - b.num_rows
                repeat, head = _behind(key[:n], sub[:n], doc[:n], lo[:n], head)
                hit = np.r_[np.flatnonzero(repeat), np.arange(n, len(key))]
                yield from _span_batches(doc[hit], tag[hit], lo[hit], lo[hit] + runs[hit] - 1 + WINDOW)
            if not b.num_rows:
                continue
            key = b.column("key").to_numpy()
            whole = pa.Table.from_batches([b])
            if size >= BLOCK_BYTES:
                # Close the block where the next bucket begins.
                cut = int(np.searchsorted(key, held[-1].column("key")[-1].as_py(), side="right"))
                held.append(whole.slice(0, cut))
                whole = whole.slice(cut)
                if whole.num_rows:
                    yield from spans(pa.concat_tables(held))
                    held, size = [], 0
            if whole.num_rows:
                held.append(whole)
                size += whole.nbytes
        if held:
            yield from spans(pa.concat_tables(held))

    dealt = contexts.repartition(parts, "key").sortWithinPartitions("kind", "key", "sub", "doc", "lo")
    return dealt.mapInArrow(sort_blocks, _SPAN)


def repeated_spans(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc, tag, start, stop): byte ranges covered by windows that also start earlier; they
    may overlap. tag is a hash that tells texts of one doc apart."""
    rows = _keyed(documents, doc_id, text).filter("text <> ''")
    runs = written(_runs(rows), "runs")
    whole = runs.filter("not ask").select("doc", "tag", F.col("lo").alias("start"), (F.col("lo") + F.col("runs") - 1 + WINDOW).alias("stop"))
    contexts = _fetched(runs.filter("ask").drop("ask"), rows)
    return whole.unionByName(written(_bucket_spans(contexts), "bucket-spans"))


def _keyed(documents: DataFrame, doc_id: str, text: str) -> DataFrame:
    value = F.coalesce(F.col(text), F.lit(""))
    return documents.select(F.coalesce(F.col(doc_id).cast("long"), F.lit(_NO_ID)).alias("doc"), F.hash(value).alias("tag"), value.alias("text"))


def remove_repeats(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept (binary)."""
    spans = repeated_spans(documents, doc_id, text)
    per_doc = spans.groupBy("doc", "tag").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    rows = _keyed(documents, doc_id, text).join(per_doc, ["doc", "tag"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            size, gone, count, kept = [], [], [], []
            for t, spans in zip(b.column("text").to_pylist(), b.column("spans").to_pylist()):
                raw = t.encode()
                out, at, n, pieces = 0, 0, 0, []
                for s in sorted((x["start"], x["stop"]) for x in spans or ()):
                    if s[0] > at or not n:
                        n += 1
                        pieces.append(raw[at : s[0]])
                        at = s[0]
                    out += max(0, s[1] - at)
                    at = max(at, s[1])
                pieces.append(raw[at:])
                size.append(len(raw))
                gone.append(out)
                count.append(n)
                kept.append(b"".join(pieces))
            yield pa.record_batch(
                [b.column("doc"), pa.array(size, pa.int64()), pa.array(gone, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                names=["doc", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    done = rows.select("doc", "text", "spans").mapInArrow(cut, "doc long, n_bytes long, n_removed long, n_spans long, kept binary")
    name = F.when(F.col("doc") != _NO_ID, F.col("doc")).cast(documents.schema[doc_id].dataType)
    return done.select(name.alias(doc_id), "n_bytes", "n_removed", "n_spans", "kept")
