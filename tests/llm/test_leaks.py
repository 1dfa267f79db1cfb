"""Decontamination: the cosine's own recall, ids of other kinds, rows without ids."""

from __future__ import annotations

import corpus_pipeline
import numpy as np

from stockyard.llm import benchmark_lsi
from stockyard.llm.common import table

SF = "/root/testdata/sf0.01"


def brute(rows, items):
    """Every region of every text against every item that shares enough words."""
    cut = benchmark_lsi.Benchmark.of(items)
    want = set()
    for doc, t in rows:
        words = benchmark_lsi.words_of(t)
        have = set(words)
        for item in cut.items:
            if sum(w in have for w in item.words) < 0.6 * len(item.words):
                continue
            for b in range(-(-len(words) // cut.block)):
                if benchmark_lsi.matches(item, words[max(0, b - 1) * cut.block : (b + cut.span(item) + 1) * cut.block], 0.75, 0.6):
                    want.add((doc, item.item_id))
                    break
    return want


def test_recall_of_the_cosine_alone(spark):
    """With counting off for all items, over the whole tables and reworded copies of items."""
    docs, bench = table(spark, SF, "documents").select("doc_id", "text"), table(spark, SF, "benchmark")
    r = np.random.default_rng(9)
    items = bench.collect()
    extra = []
    for k, item in enumerate(items):
        w = item.text.split()
        for at in r.choice(len(w), len(w) // 6, replace=False):
            w[at] = f"other{r.integers(0, 99)}"
        beside = [f"word{x}" for x in r.integers(0, 500, 60)]
        extra.append((1_000_000 + k, " ".join(beside[:30] + w + beside[30:])))
    rows = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    want = brute([(x.doc_id, x.text) for x in rows.collect()], items)
    assert len(want) >= len(items) // 2
    found = {(x.doc_id, x.item_id) for x in benchmark_lsi.contaminated(rows, bench, frequent=1).collect()}
    assert found <= want and len(found) >= 0.9 * len(want)
    whole = {(x.doc_id, x.item_id) for x in benchmark_lsi.contaminated(rows, bench).collect()}
    assert whole <= want and len(whole) >= 0.95 * len(want)


def test_ids_of_any_kind(spark):
    item = " ".join(f"q{k}" for k in range(30)) + ". the answer is here."
    noise = " ".join(f"n{k}" for k in range(90))
    docs = spark.createDataFrame([("a", f"{noise} {item} {noise}"), (None, item), (None, noise), ("b", noise), ("b", item)], "doc_id string, text string")
    bench = spark.createDataFrame([("x1", item), ("x2", None), (None, "nothing alike at all")], "item_id string, text string")
    got = {(x.doc_id, x.item_id) for x in benchmark_lsi.contaminated(docs, bench).collect()}
    assert got == {("a", "x1"), (None, "x1"), ("b", "x1")}


def test_the_pipeline_drops_only_the_rows_that_leak(spark, tmp_path):
    item = " ".join(f"q{k}" for k in range(30)) + ". the answer is here."
    clean = " ".join(f"n{k}" for k in range(90))
    rows = [(None, item), (None, clean), (4, item + " " + clean), (4, clean + " more"), (4, clean + " more"), (5, None), (None, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = corpus_pipeline.decontaminate(spark, docs, str(tmp_path))
    assert left.columns == docs.columns
    want = [(None, clean), (4, clean + " more"), (4, clean + " more"), (5, None), (None, None)]
    assert sorted(((r.doc_id, r.text) for r in left.collect()), key=str) == sorted(want, key=str)
