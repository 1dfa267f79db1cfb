"""Operator 7: language identification by prediction by partial matching (PPM).

For each language a tree of byte contexts up to order 3 is learned from labelled
texts: counts of the byte that follows each context, with escape probabilities of
method C (a context seen n times with d different successors escapes with
d / (n + d)). The statistics are frozen; a text's exact code length under a tree
is the sum over its bytes, and the language with the shortest code wins.

For scoring, the trees are unrolled into cost tables: all contexts of two bytes,
and the most frequent contexts of three bytes (others escape to two, as in a
tree that was pruned). One look-up per byte gives the costs for all languages.

Learning takes about ``max_docs`` texts a language (a documented bound; rows are
chosen by a hash of the id). At most ``MAX_CLASSES`` - 1 different bytes, the most
frequent ones, have symbols of their own; the others share one and cost the
further bits to tell them apart.

Defined results: ``und`` with score 0 for a null text, a text without a letter,
and all texts if nothing could be learned; ties go to the language that sorts
first; repeated rows get a row each; an empty table gives an empty result; other
columns pass through, but columns named lang_pred and score are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import binary_parts, keep_fraction, text_slices

MAX_CLASSES = 96
MAX_DOCS = 4_000
LONG_CONTEXTS = 16_384
PAD = "\n\n\n"  # what a text's first bytes have before them


def _padded(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bytes of all texts, each after PAD; start and end of each text's own bytes."""
    off, raw = binary_parts(pc.binary_join_element_wise(pa.scalar(PAD), pc.fill_null(texts, ""), ""))
    return raw, off[:-1] + len(PAD), off[1:]


def count_grams(df: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, gram, n): how often each three bytes and their successor occur."""

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            coded = b.column(lang).dictionary_encode()
            of = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            raw, start, end = _padded(b.column(text))
            x = raw.astype(np.int64)
            code = np.full(len(x), -1, np.int64)
            code[3:] = (x[:-3] << 24) | (x[1:-2] << 16) | (x[2:-1] << 8) | x[3:]
            own = np.ones(len(x), bool)
            for k in range(len(PAD)):
                own[start - len(PAD) + k] = False
            key = (np.repeat(of, end - start) << 32) | code[own]
            key, n = np.unique(key, return_counts=True)
            yield pa.record_batch(
                [coded.dictionary.take(pa.array(key >> 32)), pa.array(key & 0xFFFFFFFF), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    counts = df.select(F.col(lang).alias(lang), text).mapInArrow(grams, "lang string, gram long, n long")
    return counts.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


class Model:
    """Cost tables: bits of a byte after a context, for every language."""

    def __init__(self, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.langs = sorted(counts)
        n_bytes = np.zeros(256, np.int64)
        for gram, n in counts.values():
            np.add.at(n_bytes, gram & 255, n)
        n_bytes[ord(PAD[0])] += 1  # contexts begin with it, so it isn't one of the others
        own = [b for b in np.argsort(-n_bytes, kind="stable").tolist() if n_bytes[b]][: MAX_CLASSES - 1]
        self.cls = np.zeros(256, np.int32)  # class 0: all other bytes
        for k, b in enumerate(sorted(own)):
            self.cls[b] = k + 1
        c = len(own) + 1
        self.size = c
        rare_bits = np.log2(256 - len(own))
        joint: dict[str, tuple] = {}
        seen = np.zeros(c**3, np.int64)
        for lang, (gram, n) in counts.items():
            parts = [self.cls[(gram >> s) & 255].astype(np.int64) for s in (24, 16, 8, 0)]
            context = (parts[0] * c + parts[1]) * c + parts[2]
            joint[lang] = (context, parts, n)
            np.add.at(seen, context, n)
        top = np.argsort(-seen, kind="stable")[:LONG_CONTEXTS]
        top = np.sort(top[seen[top] > 1])
        # Rows of the cost table: long contexts first, then all contexts of two bytes.
        self.row = (len(top) + np.arange(c**3) % (c * c)).astype(np.int32)
        self.row[top] = np.arange(len(top))
        self.cost = np.zeros((len(top) + c * c, c, len(self.langs)), np.float32)
        base = np.full(c, 1 / 256)
        base[0] = (256 - len(own)) / 256
        for k, lang in enumerate(self.langs):
            context, parts, n = joint[lang]
            count2 = np.zeros((c, c, c))
            np.add.at(count2, (parts[1], parts[2], parts[3]), n)
            long = np.zeros((len(top), c))
            at = self.row[context]
            inside = at < len(top)
            np.add.at(long, (at[inside], parts[3][inside]), n[inside])
            p0 = _escape(count2.sum((0, 1)), base)
            p1 = _escape(count2.sum(0), p0)
            p2 = _escape(count2, p1[None]).reshape(c * c, c)
            p = np.concatenate([_escape(long, p2[top % (c * c)]), p2])
            bits = -np.log2(p)
            bits[:, 0] += rare_bits
            self.cost[:, :, k] = bits
        self.cost = self.cost.reshape(-1, len(self.langs))

    def code_lengths(self, texts: pa.Array) -> np.ndarray:
        """Bits of every text (rows) under every language (columns)."""
        raw, start, end = _padded(texts)
        c, x = self.size, self.cls[raw]
        context = np.zeros(len(x), np.int32)
        context[3:] = (x[:-3] * c + x[1:-2]) * c + x[2:-1]
        cost = self.cost[self.row[context] * c + x]
        out = np.zeros((len(start), len(self.langs)))
        full = np.flatnonzero(end > start)
        if len(full):  # every second sum: from a text's start to its end
            borders = np.stack([start[full], end[full]], axis=1).ravel()
            borders = borders[:-1] if borders[-1] == len(x) else borders
            out[full] = np.add.reduceat(cost, borders, axis=0, dtype=np.float64)[::2]
        return out


def _escape(count: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Method C along the last axis: seen symbols c / (n + d), others d / (n + d) of the
    lower order's share; a context never seen leaves all to the lower order."""
    n, d = count.sum(-1, keepdims=True), (count > 0).sum(-1, keepdims=True)
    total = np.maximum(n + d, 1)
    return np.where(n == 0, lower, np.where(count > 0, count / total, d / total * lower))


def learn(df: DataFrame, lang: str = "lang", text: str = "text", doc_id: str = "doc_id", max_docs: int = MAX_DOCS) -> Model | None:
    """Learn from the labelled rows of ``df``, about ``max_docs`` a language."""
    rows = df.filter(F.col(lang).isNotNull() & F.col(text).isNotNull())
    known = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row a language
    if not known:
        return None
    share = F.lit(False)
    for name, n in known.items():
        share = F.when(F.col(lang) == name, keep_fraction(doc_id, max_docs / n)).otherwise(share)
    some = rows.filter(share)
    # All counts of the sample, also those of one: the lower orders are their sums.
    grams = count_grams(some, lang, text).toArrow()  # bounded by the sample
    coded = grams.column("lang").combine_chunks().dictionary_encode()
    of, gram, n = coded.indices.to_numpy(), grams.column("gram").to_numpy(), grams.column("n").to_numpy()
    return Model({name: (gram[of == k], n[of == k]) for k, name in enumerate(coded.dictionary.to_pylist())})


def identify(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """``df`` with lang_pred and score (the share of the winner if every language were
    equally likely before)."""
    df = df.drop("lang_pred", "score")
    names = list(df.columns)
    schema = T.StructType(list(df.schema) + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    box = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = box.value
        for b in text_slices(batches, text, 2 << 20):
            texts = b.column(text)
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\pL"), False).to_numpy(zero_copy_only=False)
            if m is None:
                pred, score = ["und"] * len(texts), np.zeros(len(texts))
            else:
                bits = m.code_lengths(texts)
                best = bits.argmin(axis=1)
                over = bits - bits.min(axis=1, keepdims=True)
                score = np.where(letters, 1 / np.exp2(-np.minimum(over, 1000)).sum(axis=1), 0.0)
                pred = [m.langs[k] if ok else "und" for k, ok in zip(best.tolist(), letters.tolist())]
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(pred, pa.string()), pa.array(score)], names=[*names, "lang_pred", "score"])

    return df.mapInArrow(run, schema)
