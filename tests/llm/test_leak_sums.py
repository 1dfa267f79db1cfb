"""Decontamination: what its passes over the corpus cost, and that they count the same."""

from __future__ import annotations

import time

import numpy as np
import pytest

from stockyard.llm import benchmark_lsi


def _runs(r, sizes):
    first = np.cumsum(sizes) - sizes
    return first, r.integers(0, 500, int(np.sum(sizes)))


@pytest.mark.parametrize("sizes", [[], [1], [3, 1, 2], [1] * 2000, [400, 1, 1, 250, 2], [1, 2, 3, 4, 5] * 400 + [900, 30] * 5])
def test_sums_over_runs(sizes):
    r = np.random.default_rng(3)
    first, index = _runs(r, np.array(sizes, np.int64))
    rows = r.standard_normal((500, 7)).astype(np.float32)
    want = np.zeros((len(sizes), 7))
    np.add.at(want, np.repeat(np.arange(len(sizes)), sizes), rows[index].astype(np.float64))
    got = benchmark_lsi._sums(rows, index, first)
    assert got.dtype == rows.dtype and np.allclose(got, want, atol=1e-3)
    if sizes:
        assert (got == np.add.reduceat(rows[index], first, axis=0)).all()


def test_sums_cost_less_than_run_after_run():
    """Blocks have few words each: they are summed all at once, not block after block."""
    r = np.random.default_rng(4)
    first, index = _runs(r, r.integers(1, 8, 6000))
    rows = r.standard_normal((500, 320)).astype(np.float32)

    def cost(run):
        took = []
        for _ in range(7):
            at = time.process_time()
            run()
            took.append(time.process_time() - at)
        return min(took)

    ends = np.r_[first, len(index)]

    def one_after_the_other():
        for a in range(0, len(first), 256):
            z = min(a + 256, len(first))
            np.add.reduceat(rows[index[ends[a] : ends[z]]], first[a:z] - ends[a], axis=0)

    assert cost(lambda: benchmark_lsi._sums(rows, index, first)) < 0.7 * cost(one_after_the_other)


def test_frequencies_count_a_term_once_a_block(spark, docs_of):
    r = np.random.default_rng(5)
    texts = [" ".join(f"T{x}," for x in r.integers(0, 60, n)) for n in (1, 15, 16, 17, 300, 64)] + [" ".join(["t1"] * 40), "none here"]
    bench = benchmark_lsi.Benchmark([], sorted(f"t{x}" for x in range(40)))
    want, n = np.zeros(40, int), 0
    for t in texts:
        words = benchmark_lsi.words_of(t)
        for a in range(0, len(words), bench.block):
            n += 1
            for w in set(words[a : a + bench.block]) & set(bench.terms):
                want[bench.terms.index(w)] += 1
    df, blocks = benchmark_lsi._frequencies(docs_of(list(enumerate(texts))), bench, "text")
    assert blocks == n and df.tolist() == want.tolist()


def test_words_in_lower_case_whatever_is_beside_them():
    for text in ("One, TWO\n(three)", "ΟΔΟΣ. ΟΔΟΣ.Α «ΣΑΣ» Σ", "İSTANBUL, Ǆ K. ß ẞ\x1fX", "", None):
        clean = [x.strip(benchmark_lsi.MARKS) for x in benchmark_lsi._lowered(text)]
        assert clean == [x.strip(benchmark_lsi.MARKS).lower() for x in (text or "").split()]
