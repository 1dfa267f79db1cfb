"""Small tables for the corpus operators' tests."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType().add("doc_id", T.LongType()).add("text", T.StringType())


@pytest.fixture(scope="session")
def docs_of(spark):
    def make(rows, extra: bool = True):
        df = spark.createDataFrame([(i, t) for i, t in rows], SCHEMA)
        if extra:  # names that the operators use themselves
            from pyspark.sql import functions as F

            for c in ("key", "n", "position", "score", "n_lines", "root", "lang", "source"):
                df = df.withColumn(c, F.lit("x"))
            df = df.withColumn("n_chars", F.length("text").cast("long"))
        return df

    return make


@pytest.fixture(scope="session")
def corpus():
    """Rows with copies, near copies, shared lines, empty, null and long texts."""
    r = random.Random(5)
    words = ["".join(r.choice("abcdeäß") for _ in range(r.randint(1, 7))) for _ in range(300)]
    line = lambda n: " ".join(r.choice(words) for _ in range(n))
    shared, passage = "All Rights Reserved, worldwide.", line(60)
    rows = [(0, None), (1, ""), (2, " \n\t "), (3, "one two"), (4, "one  two"), (5, "one two")]
    for k in range(6, 60):
        lines = [line(r.randint(3, 40)) for _ in range(r.randint(1, 5))]
        if k % 3 == 0:
            lines.insert(r.randrange(len(lines) + 1), f"  {shared.upper() if k % 2 else shared}\t")
        if k % 7 == 0:
            lines.append(passage)
        rows.append((k, "\n".join(lines)))
    base = line(80)
    for k in range(60, 90):  # near copies of one text, some further away
        w = base.split()
        for _ in range(k % 6):
            w[r.randrange(len(w))] = r.choice(words)
        rows.append((k, " ".join(w)))
    rows += [(k, rows[10][1]) for k in range(90, 110)]
    rows += [(110, " ".join(words * 20)), (110, " ".join(words * 20)), (111, "a" * 700), (None, line(30))]
    return rows
