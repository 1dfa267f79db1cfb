"""Operator 13: a quality classifier, logistic regression on hashed word n-grams with
follow-the-regularised-leader updates.

Tokens are runs of letters and digits (A-Z lower-cased, bytes above 127 count as letters) and
runs of other marks; so a word followed by ``!!`` is a pair of tokens. Features are hashed
single tokens and pairs of neighbours, ``2 ** BITS`` places, each weighted by log(1 + its
count) and the text's vector scaled to length one. A place's second use is its sign, so
features that share a place cancel rather than add up. One more place, with value 1, is the bias.

Training: each labelled row in turn gets a prediction and one update of the sums z and
squares n of its places; weights follow from them in closed form, zero while |z| <= l1.
About ``max_rows`` labelled rows are used (a documented bound; a hash of the id decides). They
are dealt to ``shards`` files by a hash of id and text, as places and counts (255 at most);
each epoch runs the updates of every shard in its own task, starting from one common state, and
the states are averaged (weighted by rows) on the driver: ``shards`` times two arrays of
``2 ** BITS`` numbers. Scoring is a sparse dot
product of each text's features with the weights, in the same pass that hashes them.

Defined results: null and empty texts have the bias only and get its score; repeated rows
get a row each and, if labelled, count each; several labels of one id make a row each; null labels
and labelled rows without a document are left out; without any labelled row every score is
0.5; an empty table gives an empty result; other columns pass through, but columns named score and
predicted are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.byte_runs import Runs
from stockyard.llm.common import discard, keep_fraction, mix64, stored, text_slices

BITS = 18
MAX_ROWS = 20_000
SHARDS = 4
EPOCHS = 4
ALPHA, BETA, L1, L2 = 8.0, 0.1, 0.05, 0.001
THRESHOLD = 0.3
_KIND = np.full(256, 2, np.uint8)  # 0: white space, 1: letters and digits, 2: marks
_KIND[[0x20, *range(0x09, 0x0E)]] = 0
_KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1


def counted(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, signed place, count) of the hashed n-grams of all texts, by row and place; the
    last bit of a signed place is its sign."""
    runs = Runs(texts, _KIND, words=(1, 2))
    code = np.fromiter(map(xxhash.xxh3_64_intdigest, runs.words), np.uint64, len(runs.words))[runs.word] if runs.words else np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        pair = mix64(code[:-1] * np.uint64(3) + code[1:])[runs.row[1:] == runs.row[:-1]]
    row = np.r_[runs.row, runs.row[1:][runs.row[1:] == runs.row[:-1]]]
    both = np.r_[code, pair]
    place = (both >> np.uint64(64 - BITS - 1)).astype(np.int64)
    key, count = np.unique(row * (2 << BITS) + place, return_counts=True)
    return key // (2 << BITS), key % (2 << BITS), count


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, place, value) of all texts, without the bias."""
    row, place, count = counted(texts)
    value = _values(place, count)
    norm = np.sqrt(np.bincount(row, value * value, minlength=len(texts)))
    return row, place >> 1, value / norm[row]


def _values(place: np.ndarray, count: np.ndarray) -> np.ndarray:
    return np.log1p(count) * np.where(place & 1, 1.0, -1.0)


@dataclass
class State:
    """The sums of the leader: ``z`` and ``n`` for each place, the bias last."""

    z: np.ndarray
    n: np.ndarray

    @classmethod
    def new(cls) -> State:
        return cls(np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1))

    def weights(self, at=slice(None)) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        w = (np.sign(z) * L1 - z) / ((BETA + np.sqrt(n)) / ALPHA + L2)
        return np.where(np.abs(z) <= L1, 0.0, w)

    def learn(self, at: np.ndarray, value: np.ndarray, label: int) -> None:
        """One update by a row; places may repeat."""
        w = self.weights(at)
        p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
        g = (p - label) * value
        step = (np.sqrt(self.n[at] + g * g) - np.sqrt(self.n[at])) / ALPHA
        np.add.at(self.z, at, g - step * w)
        np.add.at(self.n, at, g * g)


@dataclass
class Model:
    weight: np.ndarray  # by place, the bias last

    def scores(self, texts: pa.Array) -> np.ndarray:
        row, place, value = features(texts)
        dot = np.bincount(row, self.weight[place] * value, minlength=len(texts))
        return 1 / (1 + np.exp(-np.clip(dot + self.weight[-1], -500, 500)))


def fit(rows: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", max_rows: int = MAX_ROWS, shards: int = SHARDS, epochs: int = EPOCHS) -> Model:
    """A model of the labels (0 or 1) of ``rows``."""
    spark = rows.sparkSession
    rows = rows.select(F.col(doc_id).alias("id"), F.col(text).alias("text"), F.col(label).cast("int").alias("label")).filter("label in (0, 1)")
    fraction = max_rows / max(1, rows.count())
    mixed = F.xxhash64("id", "text", "label")
    dealt = rows.filter(keep_fraction("id", fraction)).select("text", "label", mixed.alias("turn"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, "text"):
            row, place, count = counted(b.column("text"))
            cuts = np.searchsorted(row, np.arange(b.num_rows + 1)).tolist()
            at, n = place.astype(np.int32).tobytes(), np.minimum(count, 255).astype(np.uint8).tobytes()
            cut = lambda data, size: pa.array([data[size * i : size * j] for i, j in zip(cuts, cuts[1:])], pa.binary())
            yield pa.record_batch([b.column("turn"), b.column("label"), cut(at, 4), cut(n, 1)], names=["turn", "label", "place", "count"])

    # Dealt and ordered once; each epoch reads the files as they are, without a shuffle.
    rows_of = dealt.mapInArrow(hashed, "turn long, label int, place binary, count binary")
    train, path = stored(rows_of.repartition(shards, "turn").sortWithinPartitions("turn", "place", "label"), "ftrl-rows")
    state = State.new()
    for _ in range(epochs):
        box = spark.sparkContext.broadcast((state.z, state.n))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own, rows = State(*(x.copy() for x in box.value)), 0
            for b in batches:
                for place, count, y in zip(*(b.column(c).to_pylist() for c in ("place", "count", "label"))):
                    place, value = np.frombuffer(place, np.int32), np.frombuffer(count, np.uint8)
                    value = _values(place, value)
                    value /= max(1e-9, np.sqrt(value @ value))
                    own.learn(np.r_[place >> 1, 1 << BITS], np.r_[value, 1.0], y)
                    rows += 1
            if rows:
                yield pa.record_batch([pa.array([rows]), pa.array([own.z.tobytes()]), pa.array([own.n.tobytes()])], names=["rows", "z", "n"])

        done = train.coalesce(shards).mapInArrow(run, "rows long, z binary, n binary").collect()  # one state a shard
        if not done:
            break
        share = np.array([r.rows for r in done], float) / sum(r.rows for r in done)
        mean = lambda name: sum(s * np.frombuffer(r[name]) for s, r in zip(share, done))
        state = State(mean("z"), mean("n"))
    discard(spark, path)
    return Model(state.weights().astype(np.float32))


def score(documents: DataFrame, model: Model, text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows with score (0 to 1) and predicted (1 from ``threshold`` on)."""
    rows = documents.drop("score", "predicted")
    box = documents.sparkSession.sparkContext.broadcast(model)  # 2 ** BITS + 1 numbers

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in text_slices(batches, text):
            p = box.value.scores(b.column(text))
            yield pa.record_batch([*b.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    schema = T.StructType([*rows.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])
    return rows.mapInArrow(run, schema)
