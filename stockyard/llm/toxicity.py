"""Operator 3: a toxicity classifier with a counterfactual penalty.

Logistic regression on word and word-stem counts. In labelled sentences that
mention a group, the identity term is swapped for others of its category, and the
change of the score is penalised: with d = features(swapped) - features(original)
the loss has ``fairness * (w . d)^2``. So a term's weight is pulled to that of its
peers, and neutral mentions of a group are not taken for toxic ones because some
toxic texts mention it.

Fitting uses about ``max_rows`` labelled rows (a documented bound; rows are chosen
by a hash of the id). Word counts are summed per task before the shuffle; the at
most ``MAX_FEATURES`` features of clearest association are kept, so the fit on the
driver is bounded by both. With the labels in a table of their own, those of the sample
are broadcast behind a count, so that no text is shuffled to meet its label.

Defined results: null and empty texts have no word and get the score of a text
without any feature; repeated rows get a row each; if only one label (or none)
occurs, every score is the share of toxic labels (0 without labels); an empty
table gives an empty result; other columns pass through, but columns named score
and predicted are replaced.
"""

from __future__ import annotations

import itertools
import json
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import keep_fraction, text_slices

MAX_ROWS = 20_000
MAX_FEATURES = 512
MAX_BROADCAST_ROWS = 200_000  # labels of the sample (an id and a number each); more are left to the planner
STEMS = (4, 5, 6, 7)  # word beginnings that count as features, marked by a final *
MARKS = ".,;:!?\"'()[]{}#$%&*|<>«»¿¡-–—…"

#: Neutral names of groups by category; a swap stays within a line.
IDENTITY = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("immigrants", "refugees", "natives", "foreigners"),
    ("disabled", "blind", "deaf", "elderly", "young"),
    ("frauen", "männer", "mädchen", "jungen"),
    ("muslime", "christen", "juden", "atheisten"),
    ("femmes", "hommes", "filles", "garçons"),
    ("musulmans", "chrétiens", "juifs", "athées"),
    ("mujeres", "hombres", "niñas", "niños"),
    ("musulmanes", "cristianos", "judíos", "ateos"),
)
_PEERS = {t: tuple(x for x in line if x != t) for line in IDENTITY for t in line}
_SENTENCE = re.compile(r"[.!?\n]+")


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Distinct lower-case words without marks at their ends; the word and the text of
    every place."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts, ""))
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = lists.flatten().dictionary_encode()
    first = coded.indices.to_numpy(zero_copy_only=False)
    clean = pc.utf8_lower(pc.utf8_trim(coded.dictionary.cast(pa.string()), characters=MARKS)).dictionary_encode()
    again = clean.indices.to_numpy(zero_copy_only=False)
    return clean.dictionary.cast(pa.string()), again[first] if len(first) else first, np.repeat(np.arange(len(texts)), counts)


def word_features(words: pa.Array) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Features of distinct words: which words, and the feature of each."""
    length = pc.utf8_length(words).to_numpy(zero_copy_only=False)
    some = np.flatnonzero(length > 0)
    yield some, words.take(pa.array(some))
    for k in STEMS:
        some = np.flatnonzero(length >= k)
        yield some, pc.binary_join_element_wise(pc.utf8_slice_codeunits(words.take(pa.array(some)), 0, k), "*", "")


def feature_counts(texts: pa.Array, names: pa.Array | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """(row, feature, count) of all texts, the features' names, and words per text.
    ``names``: the features to count, or None for all."""
    words, word, row = words_of(texts)
    n_words = np.bincount(row, minlength=len(texts))
    out_w, out_f = [], []
    if names is None:
        parts = list(word_features(words))
        coded = pa.concat_arrays([f for _, f in parts]).dictionary_encode()
        names = coded.dictionary
        out_w = [np.concatenate([w for w, _ in parts])]
        out_f = [coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)]
    else:
        for w, f in word_features(words):
            at = pc.index_in(f, value_set=names)
            ok = at.is_valid().to_numpy(zero_copy_only=False)
            out_w.append(w[ok])
            out_f.append(at.drop_null().to_numpy(zero_copy_only=False).astype(np.int64))
    w, f = np.concatenate(out_w), np.concatenate(out_f)
    order = np.argsort(w, kind="stable")
    w, f = w[order], f[order]
    per = np.bincount(w, minlength=len(words))
    first = np.cumsum(per) - per
    has = per[word] > 0 if len(word) else np.zeros(0, bool)
    word, row = word[has], row[has]
    n = per[word]
    at = np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    key, count = np.unique(np.repeat(row, n) * max(1, len(names)) + f[at], return_counts=True)
    return key // max(1, len(names)), key % max(1, len(names)), count, names, n_words


@dataclass
class Model:
    names: list[str]
    weight: np.ndarray  # of log(1 + count) of each feature
    length: float  # of log(1 + words)
    bias: float

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, f, count, _, n_words = feature_counts(texts, pa.array(self.names, pa.string()))
        z = np.bincount(row, self.weight[f] * np.log1p(count), minlength=len(texts)) if len(self.names) else 0.0
        return 1 / (1 + np.exp(-np.clip(z + self.length * np.log1p(n_words) + self.bias, -500, 500)))


def swaps(text: str, known: dict[str, int]) -> Iterator[tuple[tuple[int, int], ...]]:
    """For each sentence with identity terms: net feature changes of every swap of one of
    its terms, as sorted (feature, change) pairs."""
    for sentence in _SENTENCE.split(text):
        for word in sentence.lower().split():
            word = word.strip(MARKS)
            for peer in _PEERS.get(word, ()):
                change: dict[int, int] = {}
                for w, step in ((word, -1), (peer, 1)):
                    for f in [w] + [w[:k] + "*" for k in STEMS if len(w) >= k]:
                        if f in known:
                            change[known[f]] = change.get(known[f], 0) + step
                d = tuple(sorted((k, v) for k, v in change.items() if v))
                if d:
                    yield d


def labelled(df: DataFrame, labels: DataFrame | None, label: str = "toxic", doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``df`` whose ``label`` is 0 or 1; with ``labels`` (``doc_id`` and ``label``), a row
    for each label of their id."""
    if labels is None:
        return df.filter(F.col(label).isin(0, 1))
    known = labels.select(F.col(doc_id).alias("__id"), label).filter(F.col(label).isin(0, 1))
    return df.select(doc_id, text).join(known, F.col(doc_id) == F.col("__id")).drop("__id")


def sampled(
    df: DataFrame, labels: DataFrame | None, fraction: float, label: str = "toxic", doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """About ``fraction`` of the labelled rows, by a hash of the id."""
    rows = df.filter(keep_fraction(doc_id, fraction))
    if labels is not None and labels.schema[doc_id].dataType == df.schema[doc_id].dataType:  # else equal ids may differ in hash
        labels = labels.select(doc_id, label).filter(keep_fraction(doc_id, fraction) & F.col(label).isin(0, 1))
        if labels.count() <= MAX_BROADCAST_ROWS:
            labels = F.broadcast(labels)
    return labelled(rows, labels, label, doc_id, text)


def fit(
    df: DataFrame, label: str = "toxic", doc_id: str = "doc_id", text: str = "text", max_rows: int = MAX_ROWS,
    max_features: int = MAX_FEATURES, fairness: float = 10.0, ridge: float = 1e-3, steps: int = 600, labels: DataFrame | None = None,
) -> Model:
    """Fit on the rows of ``df`` whose ``label`` is 0 or 1; ``labels``: the table that has the
    labels by ``doc_id``, if ``df`` hasn't."""
    rows = labelled(df, labels, label, doc_id, text)
    n = {int(r[0]): r[1] for r in rows.groupBy(label).count().collect()}
    total = sum(n.values())
    if len(n) < 2:
        share = n.get(1, 0) / total if total else 0.0
        return Model([], np.zeros(0), 0.0, float(np.log((share + 1e-9) / (1 - share + 1e-9))))
    some = sampled(df, labels, max_rows / total, label, doc_id, text).select(doc_id, text, F.col(label).cast("int").alias("__y"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            y = b.column("__y").to_numpy(zero_copy_only=False)
            row, f, _, names, _ = feature_counts(b.column(text), None)
            docs = np.bincount(f, minlength=len(names)).astype(np.int64)
            toxic = np.bincount(f, y[row], minlength=len(names)).astype(np.int64)
            yield pa.record_batch([names, pa.array(docs), pa.array(toxic)], names=["name", "docs", "toxic"])

    seen = some.groupBy().agg(F.count(F.lit(1)).alias("n"), F.sum("__y").alias("t")).first()
    if not seen.n or not seen.t or seen.t == seen.n:
        return fit(df, label, doc_id, text, 2 * max_rows, max_features, fairness, ridge, steps, labels)
    expected = F.col("docs") * (seen.t / seen.n)
    gap = (F.col("toxic") - expected) / F.sqrt(expected * (1 - seen.t / seen.n) + 0.5)
    table = some.select(text, "__y").mapInArrow(count, "name string, docs long, toxic long").groupBy("name").agg(F.sum("docs").alias("docs"), F.sum("toxic").alias("toxic"))
    chosen = table.withColumn("gap", gap).filter((F.col("docs") >= 5) & (F.abs("gap") >= 4)).orderBy(F.desc(F.abs("gap")), "name").limit(max_features)
    names = sorted({r.name for r in chosen.collect()} | set(_PEERS))
    value = pa.array(names, pa.string())
    known = {x: k for k, x in enumerate(names)}

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            row, f, c, _, n_words = feature_counts(b.column(text), value)
            cuts = np.searchsorted(row, np.arange(1, b.num_rows))
            fs, cs = np.split(f, cuts), np.split(c, cuts)
            # Most texts name no group: a quick look first.
            hit = pc.match_substring_regex(pc.fill_null(b.column(text), ""), "(?i)(" + "|".join(_PEERS) + ")").to_pylist()
            d = [[json.dumps(x) for x in swaps(t, known)] if h else [] for t, h in zip(b.column(text).to_pylist(), hit)]
            yield pa.record_batch(
                [b.column("__y"), pa.array(n_words.astype(np.int64)), pa.array([x.tolist() for x in fs], pa.list_(pa.int64())), pa.array([x.tolist() for x in cs], pa.list_(pa.int64())), pa.array(d, pa.list_(pa.string()))],
                names=["y", "n_words", "f", "c", "swaps"],
            )

    sample = some.select(text, "__y").mapInArrow(vectors, "y int, n_words long, f array<long>, c array<long>, swaps array<string>").collect()
    return _solve(sample, names, fairness, ridge, steps)


def _solve(sample: list, names: list[str], fairness: float, ridge: float, steps: int) -> Model:
    """Gradient descent with momentum (Adam) on the penalised loss."""
    y = np.array([r.y for r in sample], float)
    size = np.log1p(np.array([r.n_words for r in sample], float))
    mid, wide = size.mean(), max(float(size.std()), 0.1)
    row = np.repeat(np.arange(len(sample)), [len(r.f) for r in sample])
    f = np.fromiter(itertools.chain.from_iterable(r.f for r in sample), np.int64)
    x = np.log1p(np.fromiter(itertools.chain.from_iterable(r.c for r in sample), float))
    changes: dict[str, int] = {}
    for r in sample:
        for d in r.swaps:
            changes[d] = changes.get(d, 0) + 1
    pairs = [json.loads(d) for d in changes]
    times = np.array(list(changes.values()), float)
    d_row = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs]) if pairs else np.zeros(0, np.int64)
    d_f = np.array([k for p in pairs for k, _ in p], np.int64)
    d_x = np.array([v for p in pairs for _, v in p], float) * np.log(2)  # one mention more or less
    k = len(names)
    w = np.zeros(k + 2)
    w[-1] = np.log(y.mean() / (1 - y.mean()))
    m, v = np.zeros(k + 2), np.zeros(k + 2)
    z_size = (size - mid) / wide
    for t in range(1, steps + 1):
        z = np.bincount(row, w[f] * x, minlength=len(y)) + w[k] * z_size + w[k + 1]
        e = 1 / (1 + np.exp(-np.clip(z, -500, 500))) - y
        g = np.r_[np.bincount(f, e[row] * x, minlength=k), e @ z_size, e.sum()] / len(y)
        g[:k] += ridge * w[:k]
        if len(pairs):
            change = np.bincount(d_row, w[d_f] * d_x, minlength=len(pairs)) * times * (2 * fairness / times.sum())
            g[:k] += np.bincount(d_f, change[d_row] * d_x, minlength=k)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.05 * (1 - t / (steps + 1)) * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return Model(names, w[:k], float(w[k] / wide), float(w[k + 1] - w[k] * mid / wide))


def score(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` with score (0 to 1) and predicted (1 from 0.5 on)."""
    df = df.drop("score", "predicted")
    names = list(df.columns)
    schema = T.StructType(list(df.schema) + [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    box = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            s = box.value.scores(b.column(text))
            yield pa.RecordBatch.from_arrays([b.column(n) for n in names] + [pa.array(s), pa.array((s >= 0.5).astype(np.int32))], names=[*names, "score", "predicted"])

    return df.mapInArrow(run, schema)
