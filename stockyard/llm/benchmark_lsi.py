"""Operator 2: benchmark decontamination by latent semantic retrieval.

Documents are cut into blocks of ``BLOCK`` words. A passage for an item is as many
neighbouring blocks as hold the item wherever it lies, so items of similar length
share their passages. Terms are the words of the
benchmark that are not common in the corpus, weighted by TF-IDF over all passages.
A randomised SVD gives the latent space: one pass over all blocks multiplies their
Gram matrix with a random test matrix (sums per task, then per group of terms), and
the Nystroem formula turns that into singular vectors on the driver (at most a third as many
as there are terms, or blocks with terms). Passages and items are projected, each direction scaled by its singular value, and pairs of
cosine ``min_cosine`` or more are candidates.

The cosine is the search. One kind of item it can't be trusted with: a text that is itself
frequent has a weak direction, and its words weigh little, so its copies may lie far from it.
Which items these are is known from the words' frequencies (even the item's ``least`` rarest
words are in more than ``FREQUENT`` of all blocks); for them alone, regions are found by
counting as well. The *probe* of such an item is its rarest words, so many that a region with
the least share of the item that counts has ``MARGIN`` of the item's words in the probe
at least.

Of the pairs near enough, those leave the task that can hold the least share that counts: the
passage, and of the item's own words its region (a block more on each side), needs as many weighted
words as that share leaves when all the item's unweighted words are there, and three at least.

A candidate counts as contaminated if the longest common subsequence of words covers
``copied`` of the item, or ``reworded`` of it while the item's answer (its last
sentence) occurs too. Words are compared lower-cased, without marks at their ends.

What reaches the driver or is broadcast is bounded by the benchmark (its terms times
the rank), not by the documents.

Defined results: one row per (doc_id, item_id) that is contaminated, with the best
cosine and coverage; null and empty texts and items match nothing; rows that share an
id count together (a null id is an id); items of one id count each, the best one is
shown; an empty table gives an empty result; other columns don't take part.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import partitions, text_slices, written

MARKS = ".,;:!?\"'()[]{}«»¿¡…|#$%&*"
BLOCK = 16
RANK, EXTRA = 320, 16
MARGIN = 0.2
FREQUENT = 0.00025  # of all blocks, and 20 at least
_NEVER = 1 << 40
_SENTENCE = re.compile(r"[.!?:\n]+")


def words_of(text: str | None) -> list[str]:
    return [w for w in (x.strip(MARKS).lower() for x in (text or "").split()) if w]


def _lowered(text: str | None) -> list[str]:
    """Words in lower case, marks at their ends to be taken off. The whole text at once, unless
    it has the one letter whose lower case depends on what is beside it."""
    text = text or ""
    return text.lower().split() if "Σ" not in text else [x.strip(MARKS).lower() for x in text.split()]


@dataclass
class Item:
    item_id: object
    words: list[str]
    answer: list[str]
    times: Counter = field(init=False)  # how often it has each word

    def __post_init__(self):
        self.times = Counter(self.words)


@dataclass
class Benchmark:
    items: list[Item]
    terms: list[str]  # sorted
    block: int = BLOCK  # words per block

    @staticmethod
    def of(rows: list, block: int = BLOCK) -> Benchmark:
        items = []
        for r in rows:
            parts = [p for p in (words_of(p) for p in _SENTENCE.split(r.text or "")) if p]
            if parts:
                items.append(Item(r.item_id, [w for p in parts for w in p], parts[-1]))
        return Benchmark(items, sorted({w for i in items for w in i.words}), block)

    def span(self, item: Item) -> int:
        """Blocks that hold the item wherever it begins."""
        return -(-(len(item.words) - 1) // self.block) + 1


def _hits(texts: pa.Array, terms: pa.Array, block: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text, block and term of every word that is a term; and blocks per text."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    clean = pc.utf8_lower(pc.utf8_trim(coded.dictionary.cast(pa.string()), characters=MARKS))
    term = pc.fill_null(pc.index_in(clean, value_set=terms), -1).to_numpy(zero_copy_only=False)
    index = coded.indices.to_numpy(zero_copy_only=False)
    term = term[index] if len(index) else np.zeros(0, np.int64)
    at = np.flatnonzero(term >= 0)
    start = np.cumsum(counts) - counts
    row = np.searchsorted(start + counts, at, side="right")
    return row, (at - start[row]) // block, term[at], -(-counts // block)


def _frequencies(documents: DataFrame, bench: Benchmark, text: str) -> tuple[np.ndarray, int]:
    """In how many blocks each term occurs, and the number of blocks."""
    box = documents.sparkSession.sparkContext.broadcast((pa.array(bench.terms, pa.string()), bench.block))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, block = box.value
        df, n = np.zeros(len(terms) + 1, np.int64), 0
        for b in text_slices(batches, text):
            row, at, term, blocks = _hits(b.column(text), terms, block)
            base = np.cumsum(blocks) - blocks
            # Hits come by block: a stable order by term puts a term's hits of one block side by side.
            by = np.argsort(term.astype(np.uint16) if len(terms) <= 1 << 16 else term, kind="stable")
            cell, term = (base[row] + at)[by], term[by]
            new = np.r_[True, (term[1:] != term[:-1]) | (cell[1:] != cell[:-1])][: len(term)]
            df[:-1] += np.bincount(term[new], minlength=len(terms))
            n += blocks.sum()
        df[-1] = n
        seen = np.flatnonzero(df)
        yield pa.record_batch([pa.array(seen), pa.array(df[seen])], names=["term", "n"])

    rows = documents.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    df = np.zeros(len(bench.terms) + 1, np.int64)
    for r in rows:
        df[r.term] = r.n
    return df[:-1], int(df[-1])


def _weights(bench: Benchmark, df: np.ndarray, n: int, common: float, least: int) -> np.ndarray:
    """Inverse document frequency by term; 0 for terms in more than ``common`` of all
    blocks, unless an item would have fewer than ``least`` terms."""
    at = {w: k for k, w in enumerate(bench.terms)}
    use = df <= max(20, common * n)
    for item in bench.items:
        own = sorted({at[w] for w in item.words}, key=lambda k: df[k])
        use[own[:least]] = True
    return np.where(use, np.log((1 + n) / (1 + df)) + 1, 0.0)


class Own:
    """Which weighted words (by their place among these) are an item's own."""

    TABLE = 1 << 26  # items x words up to here are a table, beyond it sorted pairs

    def __init__(self, words: list[np.ndarray], n_words: int):
        self.n = max(1, n_words)
        codes = np.unique(np.concatenate([k * self.n + w for k, w in enumerate(words)])) if words else np.zeros(0, np.int64)
        self.codes, self.table = codes, None
        if len(words) * self.n <= self.TABLE:
            self.table = np.zeros(len(words) * self.n, bool)
            self.table[codes] = True

    def has(self, item: np.ndarray, word: np.ndarray) -> np.ndarray:
        code = item * self.n + word
        if self.table is not None:
            return self.table[code]
        at = np.minimum(np.searchsorted(self.codes, code), len(self.codes) - 1)
        return self.codes[at] == code

    def counts(self, item: np.ndarray, low: np.ndarray, high: np.ndarray, word: np.ndarray) -> np.ndarray:
        """How many of the words at places low to high - 1 are each item's own."""
        size = high - low
        of = np.repeat(np.arange(len(item)), size)
        at = np.arange(len(of)) + np.repeat(low - (np.cumsum(size) - size), size)
        return np.bincount(of, self.has(item[of], word[at]), minlength=len(item))


@dataclass
class Probes:
    """Which words of each item are counted, and how many a region that counts has."""

    start: np.ndarray  # by term: its entries in item and words
    item: np.ndarray
    words: np.ndarray  # how often the item has the term
    need: np.ndarray  # by item

    @staticmethod
    def of(bench: Benchmark, df: np.ndarray, least_share: float, above: float, rarest: int) -> Probes:
        """Probes of the items whose ``rarest`` rarest words are in more than ``above`` blocks."""
        at = {w: k for k, w in enumerate(bench.terms)}
        entries, need = [], []
        for k, item in enumerate(bench.items):
            n = len(item.words)
            own = sorted(df[at[w]] for w in set(item.words))[:rarest]
            if own[-1] <= above:
                need.append(_NEVER)
                continue
            least = max(1, math.ceil(least_share * n - 1e-9))
            margin = min(least, max(1, math.ceil(MARGIN * n)))
            times = Counter(at[w] for w in item.words)
            probed = 0
            for t in sorted(times, key=lambda t: (df[t], t)):
                if probed >= n - least + margin:
                    break
                entries.append((t, k, times[t]))
                probed += times[t]
            need.append(probed - (n - least))
        term, of, words = np.array(sorted(entries), np.int64).reshape(-1, 3).T
        start = np.searchsorted(term, np.arange(len(bench.terms) + 1))
        return Probes(start, of, words, np.array(need))

    def take(self, terms: np.ndarray) -> Probes:
        """For terms numbered by their place in ``terms``, which has all that are probed."""
        size = np.diff(self.start)[terms]
        entry = np.repeat(self.start[terms] - np.cumsum(size) + size, size) + np.arange(size.sum())
        return Probes(np.r_[0, np.cumsum(size)], self.item[entry], self.words[entry], self.need)

    def _entries(self, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place in ``term`` and entry, of all entries of these terms."""
        size = self.start[term + 1] - self.start[term]
        of = np.repeat(np.arange(len(term)), size)
        return of, self.start[term][of] + np.arange(len(of)) - np.repeat(np.cumsum(size) - size, size)

    def regions(self, row: np.ndarray, block: np.ndarray, term: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row, block and item of the passages whose regions (a block more on each side)
        may have as many probed words as the item needs, from the rows' hits."""
        none = np.zeros(0, np.int64)
        n_terms, n_items = len(self.start) - 1, len(self.need)
        probed = (np.diff(self.start) > 0)[term]
        row, block, term = row[probed], block[probed], term[probed]
        # By whole texts first; only few have enough of an item.
        seen = np.unique(row.astype(np.int64) * n_terms + term)
        of, entry = self._entries(seen % n_terms)
        pair = (seen // n_terms)[of] * n_items + self.item[entry]
        if not len(pair):
            return none, none, none
        count = np.bincount(pair, self.words[entry])
        enough = count >= np.tile(self.need, -(-len(count) // n_items))[: len(count)]
        rows = np.unique(np.flatnonzero(enough) // n_items)
        if not len(rows):
            return none, none, none
        some = np.isin(row, rows)
        high = int(block.max()) + 1
        seen = np.unique((row[some].astype(np.int64) * high + block[some]) * n_terms + term[some])
        of, entry = self._entries(seen % n_terms)
        cell = (seen // n_terms)[of]
        good = enough[(cell // high) * n_items + self.item[entry]]
        cell, item, words = cell[good], self.item[entry[good]], self.words[entry[good]]
        # The hit counts for passages from ``span`` blocks before to one after it.
        size = spans[item] + 2
        hit = np.repeat(np.arange(len(cell)), size)
        begin = (cell % high)[hit] + 1 - (np.arange(len(hit)) - np.repeat(np.cumsum(size) - size, size))
        ok = begin >= 0
        hit, begin = hit[ok], begin[ok]
        code = ((cell // high)[hit] * n_items + item[hit]) * (high + 1) + begin
        code, back = np.unique(code, return_inverse=True)
        item, begin = code // (high + 1) % n_items, code % (high + 1)
        hot = np.bincount(back, words[hit]) >= self.need[item]
        return (code // (high + 1) // n_items)[hot], begin[hot], item[hot]


def _compact(documents: DataFrame, bench: Benchmark, used: np.ndarray, doc_id: str, text: str) -> DataFrame:
    """(doc, block, term) arrays of each document that has used terms."""
    box = documents.sparkSession.sparkContext.broadcast((pa.array([bench.terms[k] for k in used], pa.string()), bench.block))
    kind = documents.schema[doc_id].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, block = box.value
        for b in text_slices(batches, text):
            row, at, term, _ = _hits(b.column(text), terms, block)
            per = np.bincount(row, minlength=b.num_rows)
            some = np.flatnonzero(per)
            ends = pa.array(np.r_[0, np.cumsum(per[some])].astype(np.int32))
            yield pa.record_batch(
                [b.column(doc_id).take(pa.array(some)), pa.ListArray.from_arrays(ends, pa.array(at.astype(np.int32))), pa.ListArray.from_arrays(ends, pa.array(term.astype(np.int32)))],
                names=["doc", "block", "term"],
            )

    return documents.select(doc_id, text).mapInArrow(run, f"doc {kind}, block array<int>, term array<int>")


def _rows(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, block and term of each hit of a batch."""
    lists = b.column("block")
    row = np.repeat(np.arange(b.num_rows), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    block = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return row, block, b.column("term").flatten().to_numpy(zero_copy_only=False)


def _cells(row: np.ndarray, block: np.ndarray, term: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Blocks with hits of the first ``n_terms`` terms: row and number of each; and per
    hit its block's place and its term."""
    weighted = term < n_terms
    row, block, term = row[weighted], block[weighted], term[weighted]
    new = np.r_[True, (row[1:] != row[:-1]) | (block[1:] != block[:-1])][: len(row)]
    return row[new], block[new], np.cumsum(new) - 1, term


def _sums(rows: np.ndarray, index: np.ndarray, first: np.ndarray, step: int = 512, short: int = 8) -> np.ndarray:
    """Sums of ``rows[index]`` over the runs that begin at ``first``, some runs at a time so
    that what is gathered stays in the cache. Most runs are short: of these the k-th rows are
    added all at once, in the order in which ``reduceat`` adds them, which takes the others."""
    out = np.empty((len(first), rows.shape[1]), rows.dtype)
    size = np.diff(np.r_[first, len(index)])
    by = np.argsort(-size, kind="stable")
    n_long = int(np.searchsorted(-size[by], -short))
    for a in range(0, n_long, step // short):
        of = by[a : min(a + step // short, n_long)]
        start = np.cumsum(size[of]) - size[of]
        at = np.arange(int(size[of].sum())) + np.repeat(first[of] - start, size[of])
        out[of] = np.add.reduceat(rows[index[at]], start, axis=0)
    for a in range(n_long, len(by), step):
        of = by[a : a + step]
        begin, n = first[of], -size[of]
        part, more = rows[index[begin]], int(np.searchsorted(n, -1))  # runs of two rows or more
        rest = rows[index[begin[:more] + 1]]
        for k in range(2, short):
            some = int(np.searchsorted(n, -k))
            rest[:some] += rows[index[begin[:some] + k]]
        part[:more] += rest
        out[of] = part
    return out


def _latent(compact: DataFrame, weight: np.ndarray, rank: int, extra: int) -> np.ndarray:
    """Randomised SVD: (terms x rank) matrix that projects weighted term counts, each
    direction divided by its singular value."""
    n_terms = len(weight)
    width = min(n_terms, rank + extra)
    omega = np.random.default_rng(7).standard_normal((n_terms, width)).astype(np.float32)
    spark = compact.sparkSession
    box = spark.sparkContext.broadcast((omega, weight.astype(np.float32)))
    step = 256

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        omega, weight = box.value
        out = np.zeros((n_terms, width), np.float32)
        weighted = omega * weight[:, None]
        for b in batches:
            for k in range(0, b.num_rows, 512):
                _, _, cell, term = _cells(*_rows(b.slice(k, 512)), n_terms)
                if not len(cell):
                    continue
                y = _sums(weighted, term, np.flatnonzero(np.r_[True, np.diff(cell) > 0]))
                by = np.argsort(term, kind="stable")
                first = np.flatnonzero(np.r_[True, np.diff(term[by]) > 0])
                out[term[by[first]]] += _sums(y, cell[by], first) * weight[term[by[first]], None]
        for a in range(0, n_terms, step):
            part = out[a : a + step]
            if part.any():
                yield pa.record_batch([pa.array([a], pa.int32()), pa.array([part.astype(np.float32).tobytes()], pa.binary())], names=["at", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for a, raw in zip(b.column("at").to_pylist(), b.column("part").to_pylist()):
                held[a] = held.get(a, 0) + np.frombuffer(raw, np.float32).astype(np.float64)
        for a, x in held.items():
            yield pa.record_batch([pa.array([a], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["at", "part"])

    sums = compact.mapInArrow(multiply, "at int, part binary").repartition(min(partitions(spark), -(-n_terms // step)), "at").mapInArrow(add, "at int, part binary")
    c = np.zeros((n_terms, width))
    for r in sums.collect():  # terms x width in all, bounded by the benchmark
        x = np.frombuffer(r.part, np.float64).reshape(-1, width)
        c[r.at : r.at + len(x)] = x
    # Terms that no document has still tell items apart: a small ridge keeps them in.
    ridge = 1e-6 * max(1.0, float(np.abs(c).max()))
    c += ridge * omega
    vals, vecs = np.linalg.eigh((omega.T.astype(np.float64) @ c + c.T @ omega) / 2)
    ok = vals > 1e-9 * vals.max()
    u, s, _ = np.linalg.svd(c @ (vecs[:, ok] / np.sqrt(vals[ok])), full_matrices=False)
    u, s = u[:, :rank], s[:rank]  # s: singular values of the passage matrix
    return (u / np.maximum(s / s.max(), 1e-6)).astype(np.float32)


def _candidates(
    compact: DataFrame, bench: Benchmark, weight: np.ndarray, probes: Probes, rank: int, extra: int, min_cosine: float, least_share: float
) -> DataFrame:
    """(doc, block, item, cosine): passages that begin at ``block`` near an item, or
    with enough of its probe."""
    at = {bench.terms[k]: j for j, k in enumerate(np.flatnonzero(weight))}
    own = weight[weight > 0]
    basis = _latent(compact, own, rank, extra) * own[:, None].astype(np.float32)
    queries = np.stack([basis[[at[w] for w in i.words if w in at]].sum(0) for i in bench.items])
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-12)
    spans = np.array([bench.span(i) for i in bench.items])
    # How many weighted words a passage with the least share of an item has; and three, or all
    # that the item has, for a cosine to say anything.
    floors = np.array([
        max(sum(w in at for w in i.words) - math.floor((1 - least_share) * len(i.words) + 1e-9), min(3, len({w for w in i.words if w in at})), 1)
        for i in bench.items
    ])
    by_span = {int(m): np.flatnonzero(spans == m) for m in np.unique(spans)}
    own_words = Own([np.array(sorted({at[w] for w in i.words if w in at}), np.int64) for i in bench.items], len(own))
    box = compact.sparkSession.sparkContext.broadcast((basis, queries.astype(np.float32), spans, by_span, probes, own_words, floors))
    kind = compact.schema["doc"].dataType.simpleString()

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        basis, queries, spans, by_span, probes, own_words, floors = box.value
        widest = max(by_span)
        query = {m: queries[items].T for m, items in by_span.items()}
        for whole in batches:
            for k in range(0, whole.num_rows, 256):
                b = whole.slice(k, 256)
                hits = _rows(b)
                if not len(hits[0]):
                    continue
                sure_row, sure_block, sure_item = probes.regions(*hits, spans)
                # All blocks of a text from 0 to its last hit, and empty ones between texts.
                last = np.zeros(b.num_rows, np.int64)
                np.maximum.at(last, hits[0], hits[1] + 1)
                row, block, cell, term = _cells(*hits, len(basis))
                size = last + widest
                base = np.cumsum(size) - size
                first = np.flatnonzero(np.r_[True, np.diff(cell) > 0])
                v = np.zeros((int(size.sum()), basis.shape[1]), np.float32)
                n_hits = np.zeros(len(v), np.int64)
                if len(row):
                    v[base[row] + block] = _sums(basis, term, first)
                    n_hits[base[row] + block] = np.diff(np.r_[first, len(cell)])
                of = np.repeat(np.arange(b.num_rows), size)
                place = (base[row] + block)[cell] if len(cell) else cell  # of each weighted hit, ascending
                sums, count, wide = v.copy(), n_hits.copy(), 1
                for m in sorted(by_span):
                    for d in range(wide, m):
                        sums[:-d] += v[d:]
                        count[:-d] += n_hits[d:]
                    wide = m
                    mine = np.flatnonzero(spans[sure_item] == m)
                    for j in range(0, len(mine), 8192):
                        x = mine[j : j + 8192]
                        p = sums[base[sure_row[x]] + sure_block[x]]
                        cos = (p * queries[sure_item[x]]).sum(1) / np.maximum(np.linalg.norm(p, axis=1), 1e-12)
                        yield pa.record_batch(
                            [b.column("doc").take(pa.array(sure_row[x])), pa.array(sure_block[x].astype(np.int32)), pa.array(sure_item[x].astype(np.int32)), pa.array(cos.astype(np.float64))],
                            names=["doc", "block", "item", "cosine"],
                        )
                    items, floor = by_span[m], floors[by_span[m]]
                    some = np.flatnonzero(count >= floor.min())
                    for j in range(0, len(some), 4096):
                        at = some[j : j + 4096]
                        p = sums[at]
                        product, norm = p @ query[m], np.maximum(np.sqrt(np.einsum("ij,ij->i", p, p)), 1e-12)
                        # Few pass the bound, which rounding leaves a little below the cosine's.
                        x, q = np.divmod(np.flatnonzero(product >= ((min_cosine - 1e-4) * norm)[:, None]), len(items))
                        cos = product[x, q] / norm[x]
                        enough = (cos >= min_cosine) & (count[at[x]] >= floor[q])
                        x, q, cos = x[enough], q[enough], cos[enough]
                        low = np.searchsorted(place, np.maximum(at[x] - 1, base[of[at[x]]]))
                        enough = own_words.counts(items[q], low, np.searchsorted(place, at[x] + m, side="right"), term) >= floor[q]
                        x, q, cos = x[enough], q[enough], cos[enough]
                        if len(x):
                            yield pa.record_batch(
                                [b.column("doc").take(pa.array(of[at[x]])), pa.array((at[x] - base[of[at[x]]]).astype(np.int32)), pa.array(items[q].astype(np.int32)), pa.array(cos.astype(np.float64))],
                                names=["doc", "block", "item", "cosine"],
                            )

    return compact.mapInArrow(near, f"doc {kind}, block int, item int, cosine double")


def common_subsequence(item: list[str], region: list[str]) -> int:
    """Length of the longest common subsequence, by bits of one integer."""
    places: dict[str, int] = {}
    for k, w in enumerate(item):
        places[w] = places.get(w, 0) | (1 << k)
    full = (1 << len(item)) - 1
    row = full
    for at in filter(None, map(places.get, region)):
        hit = row & at
        row = ((row + hit) | (row - hit)) & full
    return len(item) - row.bit_count()


def matches(item: Item, region: list[str], copied: float, reworded: float) -> float:
    """Share of the item that the region has in order; 0 if that isn't contamination."""
    if sum(map(item.times.__getitem__, item.times.keys() & region)) < min(copied, reworded) * len(item.words):
        return 0.0  # more can't be in order
    share = common_subsequence(item.words, region) / len(item.words)
    if share >= copied:
        return share
    if share >= reworded and common_subsequence(item.answer, region) >= 0.8 * len(item.answer):
        return share
    return 0.0


def contaminated(
    documents: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", common: float = 0.002, least: int = 8, rank: int = RANK, extra: int = EXTRA,
    min_cosine: float = 0.45, copied: float = 0.75, reworded: float = 0.6, frequent: float = FREQUENT,
) -> DataFrame:
    """doc_id, item_id, cosine and coverage of every contaminated pair. ``frequent``: above which
    share of blocks an item's words have it counted too; 1 for the cosine alone."""
    spark = documents.sparkSession
    rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).collect()  # the query set
    bench = Benchmark.of(rows)
    kind, item_kind = documents.schema[doc_id].dataType.simpleString(), benchmark.schema[item_id].dataType.simpleString()
    if not bench.items:
        return spark.createDataFrame([], f"{doc_id} {kind}, {item_id} {item_kind}, cosine double, coverage double")
    df, n = _frequencies(documents, bench, text)
    weight = _weights(bench, df, n, common, least)
    least_share = min(copied, reworded)
    probes = Probes.of(bench, df, least_share, max(20, frequent * n) if frequent < 1 else n, least)
    used = weight > 0
    # Terms that are only probed come last.
    terms = np.r_[np.flatnonzero(used), np.flatnonzero(~used & (np.diff(probes.start) > 0))]
    compact = written(_compact(documents, bench, terms, doc_id, text), "lsi-terms")
    # With as many directions as terms or blocks, each block would be a direction of its own,
    # and a reworded passage as far from its item as any other.
    rank = min(rank, max(1, min(int(used.sum()), n, int(df[used].sum())) // 3))
    found = written(_candidates(compact, bench, weight, probes.take(terms), rank, extra, min_cosine, least_share), "lsi-candidates")
    # One row a document: which passages and items to look at.
    todo = found.groupBy("doc").agg(F.collect_list(F.struct("block", "item", "cosine")).alias("todo"))
    joined = documents.select(doc_id, text).join(todo, F.col(doc_id).eqNullSafe(F.col("doc"))).select(doc_id, text, "todo")
    box = spark.sparkContext.broadcast((bench, copied, reworded))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bench, copied, reworded = box.value
        for b in text_slices(batches, text):
            docs, items, cosines, shares = [], [], [], []
            for d, t, todo in zip(b.column(doc_id).to_pylist(), b.column(text).to_pylist(), b.column("todo").to_pylist()):
                raw = _lowered(t)
                blocks: dict[int, list[str]] = {}  # those that regions have, cleaned once
                best: dict[tuple[int, int], float] = {}  # found by cosine, by probe, or both
                for x in todo:
                    at = x["block"], x["item"]
                    best[at] = max(x["cosine"], best.get(at, -1.0))
                for (block, k), cosine in best.items():
                    item = bench.items[k]
                    region = []
                    for j in range(max(0, block - 1), block + bench.span(item) + 1):
                        if j not in blocks:
                            blocks[j] = [x.strip(MARKS) for x in raw[j * bench.block : (j + 1) * bench.block]]
                        region += blocks[j]
                    share = matches(item, region, copied, reworded)
                    if share:
                        docs.append(d)
                        items.append(k)
                        cosines.append(cosine)
                        shares.append(share)
            kinds = [b.schema.field(doc_id).type, pa.int32(), pa.float64(), pa.float64()]
            yield pa.record_batch([pa.array(v, k) for v, k in zip((docs, items, cosines, shares), kinds)], names=["doc", "item", "cosine", "coverage"])

    good = joined.mapInArrow(check, f"doc {kind}, item int, cosine double, coverage double")
    names = spark.createDataFrame([(k, i.item_id) for k, i in enumerate(bench.items)], f"item int, name {item_kind}")
    named = good.join(F.broadcast(names), "item")  # one row an item of the query set, which the tasks hold anyway
    best = named.groupBy("doc", "name").agg(F.max("cosine").alias("cosine"), F.max("coverage").alias("coverage"))
    return best.select(F.col("doc").alias(doc_id), F.col("name").alias(item_id), "cosine", "coverage")
