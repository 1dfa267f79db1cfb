"""What the corpus operators bring to the driver, and that their folders can go."""

from __future__ import annotations

import os
import re

import stockyard.llm

#: The collects of the corpus operators, by file and line; each is bounded by a parameter,
#: the benchmark, the sample or the model.
COLLECTS = [
    ('benchmark_lsi.py', 'rows = documents.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()'),
    ('benchmark_lsi.py', 'for r in sums.collect():  # terms x width in all, bounded by the benchmark'),
    ('benchmark_lsi.py', 'rows = benchmark.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text")).collect()  # the query set'),
    ('centroid_ns.py', 'found = rows.orderBy(by.asc_nulls_last(), F.col("parts")).limit(k).collect()  # k rows'),
    ('centroid_ns.py', 'sums = {r.place: int(r.value) for r in total.collect()}  # k * (dims + 1) + 1 numbers'),
    ('centroid_ns.py', 'per = found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")).collect()  # k rows'),
    ('hilbert_shards.py', 'return [r.first for r in cells.filter("cell > 0 and first is not null").orderBy("cell").select("first").collect()]  # below 2 ** bits'),
    ('language_ppm.py', 'known = {r[0]: r[1] for r in rows.groupBy(lang).count().collect()}  # one row a language'),
    ('language_ppm.py', 'grams = count_grams(some, lang, text).toArrow()  # bounded by the sample'),
    ('line_dedup.py', 'for c, t in merged.collect():  # at most 2 * max_bits / 8 bytes in all'),
    ('line_dedup.py', 'rows = keys.select("h1", "h2", "first.doc", "first.line").collect()  # bounded just above'),
    ('parity_join.py', 'rows = frequent.toArrow()  # at most ORDER_SIZE rows'),
    ('phrases_cqf.py', 'for r in words.toArrow().to_pylist():  # at most BITMAP / 32768 + 1 rows of 4 KB'),
    ('quality_ftrl.py', 'done = train.coalesce(shards).mapInArrow(run, "rows long, z binary, n binary").collect()  # one state a shard'),
    ('quality_rules.py', 'rows = [(tuple(r[s] for s in STATISTICS), r["__y"] == 0, r["__p"], r["__n"]) for r in counted.collect()]  # at most max_rows'),
    ('toxicity.py', 'n = {int(r[0]): r[1] for r in rows.groupBy(label).count().collect()}'),
    ('toxicity.py', 'names = sorted({r.name for r in chosen.collect()} | set(_PEERS))'),
    ('toxicity.py', 'sample = some.select(text, "__y").mapInArrow(vectors, "y int, n_words long, f array<long>, c array<long>, swaps array<string>").collect()'),
]


def _collects(folder):
    pattern = re.compile(r"\.(collect|toPandas|toLocalIterator|toArrow)\(")
    found = []
    for f in sorted(os.listdir(folder)):
        if f.endswith(".py"):
            with open(os.path.join(folder, f)) as lines:
                found += [(f, line.strip()) for line in lines if pattern.search(line)]
    return found


def test_driver_collects_are_listed(tmp_path):
    assert _collects(os.path.dirname(stockyard.llm.__file__)) == COLLECTS
    (tmp_path / "new.py").write_text("rows = documents.collect()\nmore = documents.toArrow()\n")
    assert _collects(tmp_path) == [("new.py", "rows = documents.collect()"), ("new.py", "more = documents.toArrow()")]
