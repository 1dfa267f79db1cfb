"""A corpus pipeline over ``documents``: five stages, each one of the operators in
``stockyard/llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet to the shared checkpoint folder and rereads them as the next
one's docs, so a lost executor never costs more than the current stage. All stages
but the last keep the columns of ``documents``; the last adds the digests of the
SentencePiece round trip. Null texts pass every filter. Rows are judged by their text, also
where ids are null or repeat; of rows that repeat id and text, and of near duplicates whatever
their ids, one stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockyard.llm import benchmark_lsi, line_dedup, parity_join, registry, sentencepiece_bpe, toxicity
from stockyard.llm.common import held_out, ship, table, written


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier marks (operator 3)."""
    model = toxicity.fit(docs.filter(~held_out()), labels=table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).filter(F.col("predicted") == 0).select(*docs.columns)


def line_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the lines that ten documents or more have (operator 10)."""
    return line_dedup.dedup_lines(docs, min_docs=10).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (operator 8)."""
    return parity_join.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark item (operator 2), each by its own text: the
    operator is asked by a hash of it, so rows without an id or with a repeated one are told apart."""
    rows = docs.select(F.xxhash64("text").alias("__hash"), "text")
    found = benchmark_lsi.contaminated(rows, table(spark, sf_dir, "benchmark"), doc_id="__hash")
    leaked = found.select("__hash").distinct()
    return docs.join(leaked, F.xxhash64("text") == F.col("__hash"), "left_anti")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode and decode the texts (operator 1)."""
    return sentencepiece_bpe.round_trip_digest(docs, registry.PIECE_MODEL)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", line_filter),
    ("ngram_jaccard_join", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("sentencepiece", tokenize),
]

# The classifier, the latent space and the tokenizer can't be said in SQL; the stages are
# tested against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
