"""The pipeline stage by stage against brute-force versions, on the smallest tables."""

from __future__ import annotations

import collections
import os

import corpus_pipeline
import pytest

from stockyard.llm import benchmark_lsi, registry
from stockyard.llm.common import held_out, table

from .test_operators import LOWER, SPACE, brute_components, sha

SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.exists(registry.PIECE_MODEL), reason="no vocabulary file")
def test_stages_against_brute_force(spark, tmp_path):
    import sentencepiece

    docs = table(spark, SF, "documents")
    columns, stages = docs.columns, dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "sentencepiece"]

    def step(name, df):
        stages[name](spark, df, SF).write.parquet(str(tmp_path / name))
        return spark.read.parquet(str(tmp_path / name))

    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    clean = step("toxicity", docs)
    insults = {"idiot", "moron", "scum", "loser", "pathetic", "worthless"}
    kept = texts(clean)
    for i, t in texts(docs.filter(held_out())).items():
        if not insults & set((t or "").lower().split()) and i not in kept:
            assert t  # only texts with words can be rejected
    assert 0.8 * docs.count() <= len(kept) <= docs.count() and clean.columns == columns

    lines = step("line_dedup", clean)
    key = lambda x: x.strip(SPACE).translate(LOWER)
    count = collections.Counter(k for t in kept.values() for k in {key(x) for x in (t or "").split("\n")} if k)
    want = {i: None if t is None else "\n".join(x for x in t.split("\n") if count[key(x)] < 10) for i, t in kept.items()}
    assert texts(lines) == want and lines.columns == columns

    single = step("ngram_jaccard_join", lines)
    roots = {i: root for i, _, root in brute_components(list(want.items()))}
    want = {i: t for i, t in want.items() if roots[i] == i}
    assert texts(single) == want and single.columns == columns

    fresh = step("benchmark_decontamination", single)
    items = [" ".join(benchmark_lsi.words_of(r.text)) for r in table(spark, SF, "benchmark").collect()]
    want = {i: t for i, t in want.items() if not any(x and f" {x} " in f" {' '.join(benchmark_lsi.words_of(t))} " for x in items)}
    assert texts(fresh) == want and fresh.columns == columns

    own = sentencepiece.SentencePieceProcessor(model_file=registry.PIECE_MODEL)
    for r in step("sentencepiece", fresh).collect():
        ids = own.encode(want[r.doc_id] or "")
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(",".join(map(str, ids))), sha(own.decode(ids)))
