"""Groups of copies near the threshold: work put out grows with the members, no row is lost."""

from __future__ import annotations

import random

import pytest

from stockyard.llm import parity_join

from .test_operators import brute_components


def variants(members: int, changed: int, words: int = 120, seed: int = 3):
    """Texts that differ in ``changed`` words each from one text."""
    r = random.Random(seed)
    base = [f"w{k}" for k in range(words)]
    out = []
    for i in range(members):
        w = list(base)
        for k in r.sample(range(words), changed):
            w[k] = f"x{i}_{k}"
        out.append((i, " ".join(w)))
    return out


@pytest.mark.parametrize("changed", [2, 3, 4])
def test_rows_put_out_grow_with_the_members(docs_of, monkeypatch, changed):
    """Copies on either side of the threshold; four times the members give about four times the
    rows, and the components are right."""
    counts: dict[str, int] = {}
    whole = parity_join.written

    def written(df, what):
        out = whole(df, what)
        counts[what] = counts.get(what, 0) + out.count()
        return out

    monkeypatch.setattr(parity_join, "written", written)
    seen = []
    for members in (60, 240):
        counts.clear()
        rows = variants(members, changed)
        got = parity_join.near_duplicates(docs_of(rows)).collect()
        if members == 60 or changed == 3:
            assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)
        seen.append(dict(counts))
    # A class shows a number of segments that its size alone decides; no step has more rows.
    assert seen[1]["candidates"] <= 5 * seen[0]["candidates"]
    for counts in seen:
        assert all(n <= counts["candidates"] for what, n in counts.items() if what != "shingle-sets"), seen
    assert seen[1].get("near-edges", 0) <= 12 * 240, seen


def test_all_pairs_of_small_and_large_groups(docs_of):
    rows = variants(9, 2) + [(100 + i, t) for i, t in variants(3, 3, seed=5)] + [(200, "w1 w2 w3 w4 w5 w6")]
    rows += [(i + 300, " ".join(f"y{k}" for k in range(120 - 4 * i))) for i in range(12)]  # a chain by size
    got = parity_join.near_duplicates(docs_of(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_components(rows)


def test_null_ids_link_too(docs_of):
    text, near = " ".join(f"w{k}" for k in range(100)), " ".join(f"w{k}" for k in range(98))
    got = sorted(map(tuple, parity_join.near_duplicates(docs_of([(None, text), (7, near), (None, "only one here"), (None, None)])).collect()), key=str)
    assert got == sorted([(None, 96, 7), (7, 94, 7), (None, 1, None), (None, 0, None)], key=str)


def test_keep_one_row_of_each_group(docs_of):
    text = " ".join(f"w{k}" for k in range(100))
    other = " ".join(f"z{k}" for k in range(50))
    near = text + " more"
    rows = [(3, text), (5, text), (5, other), (5, other), (9, near), (None, text), (None, "alone in null"), (None, "alone in null"), (6, None), (6, ""), (6, None), (8, "Alone IN null")]
    kept = [(r.doc_id, r.text) for r in parity_join.keep_one(docs_of(rows)).collect()]
    # 3 stands for its group; the other text of 5 stays once; ids come before null; rows without words stay.
    want = [(3, text), (5, other), (8, "Alone IN null"), (6, None), (6, ""), (6, None)]
    assert sorted(kept, key=str) == sorted(want, key=str)
    nulls = [(None, text), (None, text), (None, near)]
    assert len(parity_join.keep_one(docs_of(nulls)).collect()) == 1
    assert parity_join.keep_one(docs_of([])).collect() == []
