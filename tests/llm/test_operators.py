"""Each operator against a brute-force version on small tables with odd rows."""

from __future__ import annotations

import collections
import hashlib
import os
import re
import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stockyard.llm import (
    benchmark_lsi, chat_tree, hilbert_shards, language_ppm, line_dedup, parity_join, quality_rules, registry,
    sentencepiece_bpe, suffix_dedup, toxicity,
)

SPACE = " \t\n\v\f\r"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def sha(x) -> str:
    return hashlib.sha256(x if isinstance(x, bytes) else x.encode()).hexdigest()


needs_model = pytest.mark.skipif(not os.path.exists(registry.PIECE_MODEL), reason="no vocabulary file")


@needs_model
def test_sentencepiece_equals_the_library(docs_of, corpus):
    import sentencepiece

    own = sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_MODEL)
    odd = ["  a  b ", "▁x", "a\x00b", "<s> </s> <0x41>", "🙂🙂 日本", " " * 40, "\n\n", "aaaa" * 30]
    rows = corpus + [(200 + k, t) for k, t in enumerate(odd)]
    df = docs_of(rows)
    got = sorted(map(tuple, sentencepiece_bpe.round_trip_digest(df.select("doc_id", "text"), registry.PIECE_MODEL).collect()), key=str)
    want = []
    for i, t in rows:
        ids = own.encode(t or "")
        want.append((i, len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids))))
    assert got == sorted(want, key=str)
    coded = sentencepiece_bpe.encode(df, registry.PIECE_MODEL)
    back = sentencepiece_bpe.decode(coded, registry.PIECE_MODEL)
    for r in back.collect():
        assert r.ids == own.encode(r.text or "") and r.decoded == own.decode(r.ids) and r.key == "x"
    wild = sentencepiece_bpe.load(registry.PIECE_MODEL)
    r = np.random.default_rng(3)
    for _ in range(200):
        ids = r.integers(0, 400, r.integers(0, 9)).tolist()
        assert sentencepiece_bpe.decode_ids(wild, ids) == own.decode(ids)


@needs_model
def test_sentencepiece_works_in_small_slices(spark, monkeypatch):
    r = np.random.default_rng(5)
    words = ["".join(map(chr, r.integers(97, 123, n))) for n in r.integers(2, 9, 5000)]
    texts = [" ".join(words[k] for k in r.integers(0, len(words), 2000)) for _ in range(1200)]
    df, got = spark.createDataFrame([], "doc_id long, text string, lang string"), []
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, run, schema: got.append((run, schema)) or spark.createDataFrame([], schema))
    sentencepiece_bpe.round_trip_digest(df, registry.PIECE_MODEL)
    run, schema = got[0]
    assert "text" not in schema.names  # the task doesn't send back what it read
    batch = pa.record_batch([pa.array(range(len(texts))), pa.array(texts), pa.array(["x"] * len(texts))], names=["doc_id", "text", "lang"])
    size = batch.column("text").nbytes
    assert size > 10 << 20
    work = run(iter([batch.slice(0, 10), batch]))
    rows = next(work).num_rows - 10  # by now the vocabulary has been read
    tracemalloc.start()
    rows += sum(b.num_rows for b in work)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == len(texts) and peak < 4 * size  # a slice's arrays take some ten times its bytes


@pytest.mark.parametrize("max_keys", [1000, 0])
@pytest.mark.parametrize("keep_first", [False, True])
def test_line_dedup(docs_of, corpus, max_keys, keep_first):
    key = lambda x: x.strip(SPACE).translate(LOWER)
    count = collections.Counter(k for _, t in corpus for k in {key(x) for x in (t or "").split("\n")} if k)
    first: dict = {}
    for i, t in sorted(corpus, key=lambda r: (r[0] is not None, r[0] or 0)):
        for n, x in enumerate((t or "").split("\n")):
            first.setdefault(key(x), (i, n))
    want = []
    for i, t in corpus:
        lines = (t or "").split("\n")
        kept = [x for n, x in enumerate(lines) if count[key(x)] < 10 or keep_first and first[key(x)] == (i, n)]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept) if t is not None else None))
    out = line_dedup.dedup_lines(docs_of(corpus), 10, keep_first, max_broadcast_keys=max_keys, max_bits=1 << 20)
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.text) for r in out.collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(r[2] for r in want)


def brute_components(rows):
    sets = []
    for i, t in rows:
        w = WORD.findall((t or "").translate(LOWER))
        sets.append((i, frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) > 4 else frozenset([tuple(w)] if w else [])))
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, s in sets:
        for b, t in sets:
            if a is not None and b is not None and a < b and s and t and 100 * len(s & t) >= 75 * len(s | t):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return sorted([(i, len(s), find(i) if i is not None else None) for i, s in sets], key=str)


@pytest.mark.parametrize("small,hot,chunk", [(4, 4096, 8 << 20), (2, 4096, 300), (2, 3, 100)])
def test_parity_join(docs_of, corpus, monkeypatch, small, hot, chunk):
    monkeypatch.setattr(parity_join, "SMALL_GROUP", small)
    monkeypatch.setattr(parity_join, "HOT", hot)
    monkeypatch.setattr(parity_join, "CHUNK_BYTES", chunk)
    out = parity_join.near_duplicates(docs_of(corpus))
    assert sorted([tuple(r) for r in out.collect()], key=str) == brute_components(corpus)


def test_sketch_distance_bounds_the_difference():
    r = np.random.default_rng(1)
    for _ in range(50):
        a = [str(x) for x in r.integers(0, 50, r.integers(5, 400))]
        b = a[: len(a) - 3] + [str(x) for x in r.integers(0, 50, 5)]
        x = parity_join.Sets(pa.array([" ".join(a), " ".join(b)]))
        s, t = (set(x.flat[x.start[k] : x.start[k + 1]].tolist()) for k in (0, 1))
        assert parity_join.distance(*x.sketches()) <= len(s ^ t)


def test_suffix_dedup(docs_of, corpus):
    rows = corpus + [(300, "ab" * 120), (301, "xyz" + "ab" * 60), (302, corpus[20][1] + corpus[21][1])]
    order = sorted({(i, t or "") for i, t in rows}, key=lambda r: (r[0] is not None, r[0] or 0))
    seen, want = set(), {}
    for i, t in order:
        raw = t.encode()
        mark = bytearray(len(raw))
        for k in range(len(raw) - 99):
            if raw[k : k + 100] in seen:
                mark[k : k + 100] = b"\1" * 100
            seen.add(raw[k : k + 100])
        spans = sum(1 for k in range(len(mark)) if mark[k] and not (k and mark[k - 1]))
        want[(i, len(raw))] = (sum(mark), spans, sha(bytes(c for c, m in zip(raw, mark) if not m)))
    out = suffix_dedup.remove_repeats(docs_of(rows)).collect()
    assert len(out) == len(rows)
    for r in out:
        assert (r.n_removed, r.n_spans, sha(bytes(r.kept))) == want[(r.doc_id, r.n_bytes)]
    assert sum(r.n_spans for r in out) > 20


def test_suffix_bucket_of_a_common_line_is_split(docs_of, monkeypatch):
    """One line between distinct neighbours in all documents: no bucket has more contexts
    than a block, and the result is that of brute force."""
    r = np.random.default_rng(8)
    text = lambda n: "".join(r.choice(list("abcdefghij"), n))
    line, common = text(60), text(130)
    rows = [(k, text(120) + (common if k % 3 == 0 else line) + text(120)) for k in range(300)]
    rows += [(300 + k, rows[k][1][60:240] + text(90)) for k in range(0, 60, 7)] + [(5, rows[5][1]), (None, rows[9][1])]
    monkeypatch.setattr(suffix_dedup, "BLOCK_BYTES", 1 << 13)
    seen, sort = [], suffix_dedup._bucket_spans
    monkeypatch.setattr(suffix_dedup, "_bucket_spans", lambda contexts: seen.append(contexts) or sort(contexts))
    out = suffix_dedup.remove_repeats(docs_of(rows)).collect()
    assert max(x["count"] for x in seen[0].filter("ctx is not null").groupBy("key").count().collect()) <= (1 << 13) // 128
    known, want = set(), collections.Counter()
    for i, t in sorted(set(rows), key=lambda x: (x[0] is not None, x[0] or 0)):
        mark = bytearray(len(t))
        for k in range(len(t) - 99):
            if t[k : k + 100] in known:
                mark[k : k + 100] = b"\1" * 100
            known.add(t[k : k + 100])
        n = 2 if i == 5 else 1
        want[(i, sum(mark), sha("".join(c for c, m in zip(t, mark) if not m)))] += n
    assert collections.Counter((x.doc_id, x.n_removed, sha(bytes(x.kept))) for x in out) == want
    assert sum(n for _, n, _ in want) > 10000


def test_difference_cover_decides_any_pair():
    for a in range(suffix_dedup.PERIOD):
        for b in range(suffix_dedup.PERIOD):
            assert 0 <= suffix_dedup._DELTA[a, b] < suffix_dedup.PERIOD


def test_hilbert_curve_steps_to_neighbours(spark):
    side = 8
    grid = spark.range(side**3).select(*((F.col("id") / side**k).cast("int") % side for k in range(3))).toDF("x", "y", "z")
    rows = grid.withColumn("h", hilbert_shards.hilbert_index([F.col(c) for c in "xyz"], 3)).orderBy("h").collect()
    assert [r.h for r in rows] == list(range(side**3))
    assert all(sum(abs(a[c] - b[c]) for c in "xyz") == 1 for a, b in zip(rows, rows[1:]))


def test_hilbert_shards(docs_of, corpus, tmp_path):
    df = docs_of(corpus)
    out = hilbert_shards.hilbert_shards(df, 24).collect()
    assert sorted([(r.doc_id, r.size, r.text_crc32) for r in out], key=str) == sorted(
        [(i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in corpus], key=str
    )
    slots = collections.defaultdict(list)
    for r in out:
        slots[r.shard].append(r.slot)
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    sizes = [len(slots[k]) for k in range(24)]
    assert max(sizes) - min(sizes) <= 1 and sum(sizes) == len(corpus)
    hilbert_shards.write_shards(df, str(tmp_path / "s"), 4)  # null and repeated ids too
    back = df.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.groupBy("shard").count().count() == 4
    assert sorted([(r.doc_id, r.text) for r in back.collect()], key=str) == sorted(corpus, key=str)
    assert set(df.columns) <= set(back.columns)


def test_hilbert_cells_of_whole_strings(spark):
    """Sources that share their first bytes are apart; a shard holds few of them."""
    rows = [(k, f"common_crawl_{k % 4}" if k % 50 else None, "en", k, "t") for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert hilbert_shards.string_borders(df, "source", 5) == [f"common_crawl_{k}" for k in (1, 2, 3)]
    out = hilbert_shards.hilbert_shards(df, 8, dims=("source",)).collect()
    held = collections.defaultdict(set)
    for r in out:
        held[r.shard].add(r.source)
    assert len(out) == 400 and max(map(len, held.values())) <= 3 and held[7] == {"common_crawl_3"}
    # Numbers likewise: along one dimension the curve is the order of the quantiles.
    out = sorted(hilbert_shards.hilbert_shards(df, 8, dims=("n_chars",)).collect(), key=lambda r: (r.shard, r.slot))
    cells = [r.n_chars // 13 for r in out]
    assert len({r.curve for r in out}) == 32 and all(a <= b + 1 for a, b in zip(cells, cells[1:]))
    many = spark.range(5000).select(F.lit("https://x/").alias("p"), F.concat(F.lit("https://x/"), F.lpad(F.col("id").cast("string"), 5, "0")).alias("s"))
    borders = hilbert_shards.string_borders(many, "s", 3)
    assert borders == [f"https://x/{k * 625:05d}" for k in range(1, 8)]
    assert hilbert_shards.string_borders(many, "p", 3) == [] and hilbert_shards.string_borders(many.limit(0), "s", 3) == []


def test_quality_statistics(docs_of, corpus):
    rows = corpus + [(400, "a b c a b c a b c"), (401, "#x | $y\nsame\nsame\n \n "), (402, "b c")]
    got = {(r.doc_id, r.n_words, r.word_chars): r for r in quality_rules.statistics(docs_of(rows)).collect()}
    for i, t in rows:
        w = WORD.findall(t or "")
        lines = [x for x in (t or "").split("\n") if WORD.search(x)]
        at = collections.defaultdict(list)
        for k in range(len(w) - 2):
            at[tuple(w[k : k + 3])].append(k)
        r = got[(i, len(w), sum(map(len, w)))]
        assert r.n_repeat_words == len({p + q for v in at.values() if len(v) > 1 for p in v for q in range(3)})
        assert r.n_dup_lines == len(lines) - len(set(lines)) and r.n_symbols == sum((t or "").count(c) for c in "#*$%&|<>")


def test_decision_list_finds_a_planted_rule(spark, docs_of):
    rows = [(k, " ".join(["word"] * 3 + [f"w{k}x{j}" for j in range(60)] + (["#"] * 40 if k % 4 == 0 else []))) for k in range(400)]
    labels = spark.createDataFrame([(k, 0 if k % 4 == 0 else 1) for k in range(400)], "doc_id long, quality int")
    out, rules = quality_rules.quality_rules(docs_of(rows), labels)
    assert rules and all(c.statistic in quality_rules.STATISTICS for rule in rules for c in rule)
    assert {r.doc_id for r in out.filter("not kept").collect()} == {k for k in range(400) if k % 4 == 0}
    none, rules = quality_rules.quality_rules(docs_of(rows), labels.limit(0))
    assert not rules and none.filter("not kept").count() == 0


def test_language_ppm(spark, docs_of, corpus):
    made = [(k, ("the cat and the dog sat on it " if k % 2 else "die katze und der hund sind da ") * 5, "en" if k % 2 else "de") for k in range(60)]
    train = spark.createDataFrame([*made, (None, None, "fr"), (99, "text", None)], "doc_id long, text string, lang string")
    model = language_ppm.learn(train.filter("lang is null or lang <> 'fr'"))
    out = {(r.doc_id, r.text): r for r in language_ppm.identify(docs_of([(1, "the dog"), (2, "der hund und die"), *corpus]), model).collect()}
    assert out[(1, "the dog")].lang_pred == "en" and out[(2, "der hund und die")].lang_pred == "de"
    assert all((r.lang_pred == "und") == (not re.search(r"[^\W\d_]", r.text or "")) and 0 <= float(r.score) <= 1 for r in out.values())
    assert {r.lang_pred for r in language_ppm.identify(docs_of(corpus), language_ppm.learn(train.limit(0))).collect()} == {"und"}


def test_ppm_code_length_is_exact():
    grams = {"x": (np.array([0x0A0A0A61, 0x0A0A6162, 0x0A616261, 0x61626162, 0x62616261]), np.array([4, 4, 2, 6, 5]))}
    m = language_ppm.Model(grams)
    got = m.code_lengths(pa.array(["ab", "", "ab", "zz", None]))[:, 0]
    assert got[0] == got[2] and got[1] == got[4] == 0 and got[3] > got[0] > 0
    # Every context's symbols share one whole, as code lengths must.
    cost = m.cost.reshape(-1, m.size).astype(float)
    rare = np.log2(256 - (m.size - 1))
    cost[:, 0] -= rare
    assert (np.exp2(-cost).sum(axis=1) <= 1 + 1e-5).all()


def test_toxicity_and_its_counterfactual_penalty(spark, docs_of, corpus):
    r = np.random.default_rng(0)
    rows = []
    for k in range(600):
        toxic = k % 3 == 0
        w = [f"w{x}" for x in r.integers(0, 400, 30)]
        if toxic:
            w[5] = "idiot"
        if k % 6 == 0 or k % 29 == 0:
            w[9] = "muslims"  # mentioned in toxic texts more than in others
        elif k % 31 == 0:
            w[9] = "christians"
        rows.append((k, " ".join(w), int(toxic)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    fair, plain = toxicity.fit(df, fairness=10.0), toxicity.fit(df, fairness=0.0)

    def gap(m):  # how much the log odds change by the swap
        a, b = m.scores(pa.array(["many muslims live here", "many christians live here"]))
        return abs(np.log(a / (1 - a)) - np.log(b / (1 - b)))

    assert gap(fair) < 0.3 * gap(plain)
    scored = toxicity.score(docs_of([(1, "you are an idiot w1 w2"), (2, "many muslims live here w3"), *corpus]), fair).collect()
    by = {(x.doc_id, x.text): x for x in scored}
    assert by[(1, "you are an idiot w1 w2")].predicted == 1 and by[(2, "many muslims live here w3")].predicted == 0
    assert all(0 <= x.score <= 1 for x in scored) and len(scored) == len(corpus) + 2
    assert toxicity.fit(df.filter("toxic = 1")).scores is not None
    empty = toxicity.score(docs_of([]), toxicity.fit(df.limit(0)))
    assert empty.count() == 0


@pytest.mark.parametrize("most", [toxicity.MAX_BROADCAST_ROWS, 0])
def test_toxicity_labels_meet_texts_without_a_shuffle(spark, monkeypatch, most):
    monkeypatch.setattr(toxicity, "MAX_BROADCAST_ROWS", most)
    monkeypatch.setattr(toxicity, "MAX_FEATURES", 50)
    r = np.random.default_rng(1)
    texts = [(k, " ".join(f"w{x}" for x in r.integers(0, 50, 20)) + (" idiot" if k % 3 == 0 else "")) for k in range(600)]
    docs = spark.createDataFrame([*texts, (7, "a second text of one id"), (None, "no id")], "doc_id long, text string")
    marks = [(k, int(k % 3 == 0)) for k in range(0, 600, 2)] + [(7, 1), (7, 0), (8, None), (9, 2), (None, 1), (7000, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, toxic int")
    joined = docs.join(labels, "doc_id")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        some = toxicity.sampled(docs, labels, 0.5)
        plan = some._jdf.queryExecution().executedPlan().toString()
        assert ("SortMergeJoin" in plan) == (most == 0) and ("BroadcastHashJoin" in plan) == (most > 0)
        want = toxicity.sampled(joined, None, 0.5)
        assert sorted(map(tuple, some.collect())) == sorted(map(tuple, want.select("doc_id", "text", "toxic").collect()))
        assert 0 < some.count() < toxicity.labelled(docs, labels).count() == 304
        a, b = toxicity.fit(docs, max_rows=200, labels=labels), toxicity.fit(joined, max_rows=200)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert a.names == b.names and np.allclose(a.weight, b.weight) and abs(a.bias - b.bias) < 1e-6


def test_benchmark_lsi(spark, docs_of, corpus):
    r = np.random.default_rng(2)
    vocab = [f"{a}{b}{c}" for a in "bdfgk" for b in ("ara", "elo", "imu") for c in "lmnrst"]
    item = [" ".join(r.choice(vocab, r.integers(14, 50))) + ". " + " ".join(r.choice(vocab, 4)) + "." for _ in range(12)]
    noise = lambda n: " ".join(f"n{x}" for x in r.integers(0, 3000, n))
    rows = [(1000 + k, f"{noise(50)} {item[k].upper() if k % 2 else item[k]} {noise(70)}") for k in range(12)]
    reworded = item[3].split()
    reworded[2] = reworded[7] = "changed"
    rows += [(2000, noise(20) + " " + " ".join(reworded) + " " + noise(20)), (2001, noise(300))]
    bench = spark.createDataFrame([(k, t) for k, t in enumerate(item)] + [(98, None), (99, " ")], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in benchmark_lsi.contaminated(docs_of(rows + corpus), bench).collect()}
    assert got == {(1000 + k, k) for k in range(12)} | {(2000, 3)}
    assert benchmark_lsi.contaminated(docs_of([]), bench).count() == 0
    assert benchmark_lsi.contaminated(docs_of(rows), bench.limit(0)).count() == 0


def test_benchmark_item_in_a_third_of_all_documents(spark, docs_of):
    """Copies count however frequent the item is and whatever lies beside it; all pairs
    that a search of every region for every item finds are there."""
    r = np.random.default_rng(6)
    items = [" ".join(f"i{k}x{j}" for j in range(24)) + ". yes it is." for k in range(40)]
    noise = lambda n: [f"n{x}" for x in r.integers(0, 400, n)]
    rows = []
    for k in range(240):
        beside = [f"i{r.integers(1, 40)}x{r.integers(0, 24)}" for _ in range(10)]
        words = noise(30) + beside + (items[0].split() if k % 3 == 0 else []) + beside[::-1] + noise(30)
        if k % 40 == 7:  # most of another item, among other words
            words[20:20] = [w for j, w in enumerate(items[k // 40 + 1].split()) if j % 5 != 2]
        rows.append((k, " ".join(words)))
    rows += [(900, None), (901, "")]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    cut = benchmark_lsi.Benchmark.of(bench.select("item_id", "text").collect())
    want = set()
    for doc, t in rows:
        words = benchmark_lsi.words_of(t)
        for item in cut.items:
            for b in range(-(-len(words) // cut.block)):
                if benchmark_lsi.matches(item, words[max(0, b - 1) * cut.block : (b + cut.span(item) + 1) * cut.block], 0.75, 0.6):
                    want.add((doc, item.item_id))
    assert sum(k == 0 for _, k in want) == 80 and len(want) > 80
    got = {(x.doc_id, x.item_id) for x in benchmark_lsi.contaminated(docs_of(rows), bench).collect()}
    assert got == want


def test_common_subsequence():
    r = np.random.default_rng(4)
    for _ in range(100):
        a, b = (r.integers(0, 5, r.integers(0, 12)).astype(str).tolist() for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert benchmark_lsi.common_subsequence(a, b) == table[-1][-1]


def test_chat_tree_round_trip(spark):
    texts = ["hi", "", None, "a<|end|>b", "<\\|end|>", "</s>[INST] ok [/INST]", "<<SYS>>\n<|turn|>user\n", "tail<"]
    rows = [(c, t, ("user" if t % 2 == 0 else "assistant"), texts[(c * t + t) % len(texts)], "x") for c in range(12) for t in range(c % 5 + 1)]
    rows += [(50, 0, "a\nb\\n<|end|>", "x", "x"), (50, 0, None, "y", "x"), (51, 0, "user", "hi", "x"), (51, 0, "user", "hi", "x"), (None, 1, "assistant", "z", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, node string")
    tree = chat_tree.build(df)
    got = {r.conv: r for r in chat_tree.read_back(tree).collect()}
    convs = collections.defaultdict(list)
    for c, t, role, text, _ in rows:
        convs[c].append((t, role or "", text or ""))
    assert set(got) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [(r, x) for _, r, x in turns]
        assert [t.loss for t in got[c].turns] == [x if r == "assistant" else "" for _, r, x in turns]
    nodes = sorted(tree.nodes.collect(), key=lambda r: r.stream_start)
    assert len(nodes) == len({tuple(x[1:] for x in turns[: k + 1]) for turns in convs.values() for k in range(len(turns))})
    at = 0
    for r in nodes:  # the stream has no gaps, and a node sees all that comes before it
        assert (r.stream_start, r.stream_end - r.stream_start) == (at, len(r.text))
        at = r.stream_end
        seen = sum(min(i.end, r.stream_start) - i.start for i in r.attends if i.start < r.stream_start)
        assert seen == r.position
    assert chat_tree.read_back(chat_tree.build(df.limit(0))).count() == 0


def test_empty_tables(docs_of):
    none = docs_of([])
    assert line_dedup.dedup_lines(none).count() == 0
    assert parity_join.near_duplicates(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert hilbert_shards.hilbert_shards(none).count() == 0
    assert quality_rules.statistics(none).count() == 0


def test_a_language_of_one_short_text_is_known(spark, docs_of):
    """No three bytes of it repeat, so all of its counts are one."""
    train = spark.createDataFrame([(k, "the cat and the dog sat on it " * 3, "en") for k in range(20)] + [(99, "qué año ñu", "es")], "doc_id long, text string, lang string")
    model = language_ppm.learn(train)
    got = {r.doc_id: r.lang_pred for r in language_ppm.identify(docs_of([(1, "año ñu"), (2, "the dog sat")]), model).collect()}
    assert got == {1: "es", 2: "en"}
    assert language_ppm.identify(docs_of([]), model).collect() == []


def dictionary_ppm(counts, langs, text):
    """Bits of a text under every language: byte by byte with dictionaries, orders 3 to 0, method C.
    ``counts``: {language: {(four bytes): n}}; an order-3 context counts if seen twice in all."""
    out = []
    seen = collections.Counter()
    for grams in counts.values():
        for gram, n in grams.items():
            seen[gram[:3]] += n
    for lang in langs:
        by = [collections.defaultdict(collections.Counter) for _ in range(4)]
        for gram, n in counts[lang].items():
            for order in range(4):
                by[order][gram[3 - order : 3]][gram[3]] += n

        def p(order, before, x):
            if order < 0:
                return 1 / 256
            here = by[order].get(before[3 - order :])
            if not here or (order == 3 and seen[before] < 2):
                return p(order - 1, before, x)
            n, d = sum(here.values()), len(here)
            return here[x] / (n + d) if x in here else d / (n + d) * p(order - 1, before, x)

        raw = b"\n\n\n" + text.encode()
        out.append(-sum(np.log2(p(3, raw[k - 3 : k], raw[k])) for k in range(3, len(raw))))
    return out


def test_code_lengths_equal_a_dictionary_ppm(docs_of):
    r = np.random.default_rng(8)
    texts = {"x": ["abra cadabra", "a", "bar bar bar é"], "y": ["hocus pocus", "o", "cus cus " * 5]}
    counts, arrays = {}, {}
    for lang, own in texts.items():
        grams = collections.Counter()
        for t in own:
            raw = b"\n\n\n" + t.encode()
            grams.update(raw[k - 3 : k + 1] for k in range(3, len(raw)))
        counts[lang] = grams
        arrays[lang] = (np.array([int.from_bytes(g, "big") for g in grams]), np.array(list(grams.values())))
    m = language_ppm.Model(arrays)
    odd = ["", "abra", "pocus bar", "éé", "☃ unseen", "o" * 50, *("".join(r.choice(list("abcrdous \n"), 20)) for _ in range(20))]
    got = m.code_lengths(pa.array(odd))
    assert m.langs == ["x", "y"]
    for t, bits in zip(odd, got):
        assert np.allclose(bits, dictionary_ppm(counts, m.langs, t), rtol=1e-5, atol=1e-3), t


def covering_by_brute_force(rows, borders, max_rules, max_conditions, precision, min_cover):
    """The covering of ``quality_rules.learn`` row by row: ``rows`` hold (values, bad, prune)."""
    fires = lambda c, v: (v[c[0]] > c[2]) == c[1]
    count = lambda group: (sum(y for _, y, _ in group), sum(not y for _, y, _ in group))
    worth = lambda rule, group: (lambda p, n: (p - n) / (p + n) if p + n else -1.0)(*count([r for r in group if all(fires(c, r[0]) for c in rule)]))
    found = []
    while len(found) < max_rules:
        rule, group = [], [r for r in rows if not r[2]]
        while len(rule) < max_conditions:
            p0, n0 = count(group)
            if not p0 or not n0:
                break
            best, gain = None, 1e-9
            for k, own in enumerate(borders):
                for b in own:
                    for above in (False, True):
                        p, n = count([r for r in group if fires((k, above, b), r[0])])
                        if p >= min_cover and p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))) > gain + 1e-12:
                            best, gain = (k, above, b), p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0)))
            if best is None:
                break
            rule.append(best)
            group = [r for r in group if fires(best, r[0])]
        if not rule:
            break
        held = [r for r in rows if r[2]]
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r, held))
        p, n = count([r for r in rows if all(fires(c, r[0]) for c in rule)])
        if p < min_cover or p < precision * (p + n) or worth(rule, held) < 2 * precision - 1:
            break
        found.append(tuple(rule))
        rows = [r for r in rows if not all(fires(c, r[0]) for c in rule)]
    return found


def test_decision_list_equals_covering_by_brute_force(spark):
    names = quality_rules.STATISTICS
    r = np.random.default_rng(12)
    values = r.integers(0, 40, (400, len(names))).astype(float)
    bad = ((values[:, 1] > 30) & (values[:, 2] <= 20)) | (values[:, 0] <= 5) | (r.random(400) < 0.01)
    data = [(k, *map(float, v), int(not y)) for k, (v, y) in enumerate(zip(values, bad))]
    df = spark.createDataFrame(data, "doc_id long, " + ", ".join(f"{n} double" for n in names) + ", quality int")
    rules = quality_rules.learn(df, bins=8, precision=0.8, min_cover=4)
    prune = {x.doc_id: x.p for x in df.select("doc_id", (F.pmod(F.xxhash64(F.lit("prune"), "doc_id"), F.lit(3)) == 0).alias("p")).collect()}
    found = df.select(*(F.percentile_approx(n, [k / 8 for k in range(1, 8)], 10_000).alias(n) for n in names)).first()
    borders = [sorted(set(found[n])) for n in names]
    rows = [(v, bool(y), prune[k]) for k, (v, y) in enumerate(zip(values.tolist(), bad))]
    want = covering_by_brute_force(rows, borders, 8, 3, 0.8, 4)
    assert len(want) >= 2
    assert [tuple((names.index(c.statistic), c.above, c.threshold) for c in rule) for rule in rules] == want


def test_anchors_are_the_same_in_pieces_of_any_size():
    """A window's anchor doesn't depend on the text around it, nor on where a piece ends; ties of
    the leading bits go to the leftmost place."""
    r = np.random.default_rng(5)
    h = suffix_dedup.grams(r.integers(97, 100, 5000).astype(np.uint8))
    h[::7] &= np.uint64((1 << 24) - 1)  # many ties
    need = suffix_dedup.WINDOW - suffix_dedup.GRAM + 1
    want = [k + int(np.argmin(h[k : k + need] >> np.uint64(24))) for k in range(len(h) - need + 1)]
    for piece in (need, need + 1, 333, 4999, 1 << 24):
        assert suffix_dedup._anchors(h, piece).tolist() == want
    assert len(suffix_dedup._anchors(h[: need - 1])) == 0
    long = np.tile(r.integers(97, 123, 1 << 10).astype(np.uint8), 17 << 10)  # over 16 MiB
    text, lo, count, off, _ = suffix_dedup.runs_of(long, np.array([0, len(long)]))
    assert count.sum() == len(long) - suffix_dedup.WINDOW + 1
    anchors = np.repeat(lo + off, count)[: 1 << 23]
    assert (anchors[1 << 10 :] - anchors[: -(1 << 10)] == 1 << 10).all()  # equal windows, equal anchors
