"""Operators 11 to 13 against brute-force versions on small tables with odd rows."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockyard.llm import centroid_ns, phrases_cqf, quality_ftrl, registry
from stockyard.llm.common import held_out, table
from stockyard.llm.quotient_filter import Packing, QuotientFilter

SF = "/root/testdata/sf0.001"


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, cluster int, state string")


def lloyd(rows, k, rounds, dims, scale, seed="3"):
    """(vec_id, cluster, distance) and centroids by comparing all with all."""
    kept = [(i, [math.floor(scale * x) for x in e]) for i, e in rows if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [c for _, c in order[:k]]
    square = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    nearest = lambda v: min((square(v, c), j) for j, c in enumerate(centroids))
    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, v in kept:
            own[nearest(v)[1]].append(v)
        centroids = [[sum(x) // len(own[j]) for x in zip(*own[j])] if own[j] else c for j, c in enumerate(centroids)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in kept], centroids


def test_ns_bounds_equal_plain_k_means(spark):
    r = random.Random(2)
    rows = [(k, [r.gauss(k % 5, 0.7) for _ in range(6)]) for k in range(400)]
    rows += [(k, rows[7][1]) for k in range(400, 440)] + [rows[3], rows[3]]  # copies; a repeated row
    rows += [(500, None), (501, [1.0] * 5), (502, [None] * 6), (503, [float("nan")] * 6), (504, [float("inf")] + [0.0] * 5), (None, [0.5] * 6), (505, [])]
    df = vectors_of(spark, [(i, e, 9, "x") for i, e in rows])
    found = centroid_ns.cluster(df, k=8, rounds=10, dims=6, scale=1024)
    want, centroids = lloyd(rows, 8, 10, 6, 1024)
    assert sorted(map(tuple, found.rows.collect()), key=str) == sorted(want, key=str)
    assert found.history[-1].tolist() == centroids
    # The bounds spare most evaluations, and every first round evaluates all.
    assert found.evaluated[0] == 8 * len(want) and sum(found.evaluated[1:]) < 0.6 * 9 * 8 * len(want)
    totals = centroid_ns.with_totals(found).collect()
    assert {r.inertia for r in totals} == {sum(d for _, _, d in want)}
    for row in totals:
        assert row.cluster_inertia == sum(d for _, j, d in want if j == row.cluster)
        assert row.centroid_sha256 == hashlib.sha256(",".join(map(str, centroids[row.cluster])).encode()).hexdigest()


def test_ns_bounds_odd_tables(spark):
    empty = centroid_ns.cluster(vectors_of(spark, []), dims=2)
    assert centroid_ns.with_totals(empty).collect() == []
    few = [(1, [0.0, 0.0]), (2, [5.0, 5.0])]
    found = centroid_ns.cluster(vectors_of(spark, [(i, e, 0, "") for i, e in few]), dims=2)
    assert sorted(map(tuple, found.rows.collect())) == sorted(lloyd(few, 8, 10, 2, 1024)[0])
    same = [(k, [1.5, -2.25]) for k in range(20)]  # one point: centroid 0 takes all, the others stay empty
    found = centroid_ns.cluster(vectors_of(spark, [(i, e, 0, "") for i, e in same]), dims=2)
    assert {(r.cluster, r.distance) for r in found.rows.collect()} == {(0, 0)} and found.history[-1].tolist() == [[1536, -2304]] * 8
    with pytest.raises(Exception, match="pass 64 bits"):
        centroid_ns.cluster(vectors_of(spark, [(1, [1e9, 0.0], 0, "")]), dims=2).rows.collect()


def test_a_round_trip_displacement_loosens_nothing():
    there = np.array([[[0, 0]], [[100, 0]], [[0, 0]]])  # moved out and back: the norm of the sum is 0
    assert centroid_ns.History(there).moved[:, 0].tolist() == [0.0, 100.0, 0.0]


@pytest.mark.parametrize("bits", [48, 64])
@pytest.mark.parametrize("n", [1, 2, 3, 4])
def test_quotient_filter_is_lossless(bits, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 1 << 62, (5000, n), dtype=np.uint64) >> np.uint64(max(0, 62 - bits))
    ids[:2000] = ids[2000:4000]
    ids[:50, 0] = ids[50, 0]
    p = Packing(n, bits, 6)
    assert (p.unpack(p.pack(ids)) == ids).all()
    counts = rng.integers(1, 600, len(ids))
    halves = [QuotientFilter.of(p, ids[k::2], counts[k::2]) for k in (0, 1)]
    again = [QuotientFilter.merged([QuotientFilter.read(p, b, data) for f in halves for k, data in f.segments() if k == b]) for b in range(1 << 6)]
    got = {tuple(i): c for f in again for i, c in zip(f.ids().tolist(), f.counts.tolist())}
    want = collections.Counter()
    for i, c in zip(ids.tolist(), counts.tolist()):
        want[tuple(i)] += c
    assert got == dict(want) and sum(map(len, again)) == len(want)
    size = sum(len(d) for f in halves for _, d in f.segments())
    assert size < sum(map(len, halves)) * (n * bits // 8 + 8)


def brute_phrases(rows, min_count, top):
    lower = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})
    f = collections.defaultdict(collections.Counter)
    for lang, t in rows:
        for piece in re.split("[.,;:!?\x0a-\x0d]", (t or "").translate(lower)):
            ws = re.findall("[^\x20\x09]+", piece)
            for n in range(1, 5):
                f[lang or "und" if lang is None else lang].update(tuple(ws[i : i + n]) for i in range(len(ws) - n + 1))
    out = []
    for lang, c in f.items():
        cand = {p: a for p, a in c.items() if len(p) > 1 and a >= min_count}
        inner = collections.Counter()
        for p, a in cand.items():
            for m in range(2, len(p)):
                for i in range(len(p) - m + 1):
                    inner[p[i : i + m]] = max(inner[p[i : i + m]], a)
        got = []
        for p, a in cand.items():
            if 100 * inner[p] >= 80 * a:
                continue
            s, _, left, right = min((2000000 * a // (c[p[:k]] + c[p[k:]]), k, c[p[:k]], c[p[k:]]) for k in range(1, len(p)))
            got.append((-s, -a, " ".join(p).encode(), left, right))
        total = sum(v for p, v in c.items() if len(p) == 1)
        out += [(lang, k, p.decode(), -a, left, right, total, -s) for k, (s, a, p, left, right) in enumerate(sorted(got)[:top], 1)]
    return sorted(out)


@pytest.mark.parametrize("held", [1 << 20, 50])
def test_phrases_equal_brute_force(spark, monkeypatch, held):
    monkeypatch.setattr(phrases_cqf, "HELD", held)
    r = random.Random(4)
    words = ["a", "B", "ça", "d\x00", "e'e", "long" * 40, "日本", "z"]
    rows = [(r.choice(["en", "de", None, "und"]), "".join(r.choice(words) + r.choice([" ", "  ", "\t", ", ", "\n", ".", " "]) for _ in range(r.randint(0, 60)))) for _ in range(200)]
    rows += [("en", None), ("en", ""), ("fr", " ,;: "), ("xx", "one two three four five " * 40), ("xx", "one two. Three four"), ("en", "a b c d. " * 50_000)]
    df = spark.createDataFrame([(t, x, 1, "n") for x, t in rows], "text string, lang string, n int, phrase string")
    got = phrases_cqf.phrases(df, min_count=5, top=40)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 5, 40)
    assert phrases_cqf.phrases(df.limit(0), min_count=5).collect() == []


def test_word_ids_that_meet_are_counted_again(spark, monkeypatch):
    """Under the first seed the lexicon shows two words of one id; another seed is taken."""
    whole, seeds = phrases_cqf.lexicon, []

    def lexicon(documents, text, lang, bitmap, seed, bits):
        seeds.append(seed)
        found = whole(documents, text, lang, bitmap, seed, bits)
        return found if seed else found.unionByName(found.filter("id is not null").withColumn("word", F.lit("other")))

    monkeypatch.setattr(phrases_cqf, "lexicon", lexicon)
    rows = [("en", "a b c " * 10)]
    got = phrases_cqf.phrases(spark.createDataFrame([(t, x) for x, t in rows], "text string, lang string"), min_count=5)
    assert sorted(map(tuple, got.collect())) == brute_phrases(rows, 5, 2000) and seeds == [0, 1]


def test_quality_classifier(spark):
    sf = "/root/testdata/sf0.01"
    got = registry.QUERIES["op13_quality_ftrl"](spark, sf)
    assert got.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    rows = {r.doc_id: r for r in got.collect()}
    assert len(rows) == table(spark, sf, "documents").count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    held = [(r.quality, rows[r.doc_id]) for r in table(spark, sf, "labels").filter(held_out()).collect()]
    assert sum(q == r.predicted for q, r in held) >= 0.93 * len(held)
    assert min(r.score for q, r in held if q) > np.median([r.score for q, r in held if not q])


def test_quality_classifier_odd_rows(spark, docs_of):
    train = spark.createDataFrame([(i, "good words here" if i % 2 else "bad !! junk !!", i % 2) for i in range(60)] + [(90, None, 1), (91, "x", None), (92, "", 0)], "doc_id long, text string, quality int")
    model = quality_ftrl.fit(train)
    docs = docs_of([(1, "good words"), (2, "junk !! bad"), (3, None), (4, ""), (5, " \n"), (None, "good"), (1, "good words"), (6, "good " * 300_000), (7, "☃!")])
    got = quality_ftrl.score(docs.withColumn("predicted", F.lit("x")), model).collect()
    by = {r.doc_id: r.score for r in got}
    assert len(got) == 9 and got[0].key == "x" and by[1] > 0.5 > by[2] and by[3] == by[4] == by[5]
    assert quality_ftrl.score(docs.limit(0), model).collect() == []
    none = quality_ftrl.fit(train.limit(0))
    assert {r.score for r in quality_ftrl.score(docs, none).collect()} == {0.5}


def test_features_are_hashed_pairs():
    row, place, value = quality_ftrl.features(pa.array(["a b a", None, "", "Az!!"]))
    assert set(row.tolist()) == {0, 3} and np.allclose(np.bincount(row, value * value)[[0, 3]], 1) and len(place[row == 3]) == 3 and len(place[row == 0]) == 4
