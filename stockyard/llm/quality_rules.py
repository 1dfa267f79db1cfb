"""Operator 6 [native]: quality rules as a learned decision list.

Text statistics come from array functions on each row, without a shuffle. A list
of rules that reject low quality is learned from labelled statistics by
sequential covering: a rule grows by the threshold condition of best information
gain, is pruned on rows kept apart, and takes the rows it covers out of the
table; growing ends when no rule is precise enough. The list becomes one ordered
Spark conditional expression.

Learning sees a contingency table of the binned statistics of at most about
``max_rows`` labelled rows (a documented bound; rows are chosen by a hash of the
id). The statistics of the documents are computed once, written to the shared
folder and read by learning and by the final expression.

Defined results: a null or empty text has no word and fails the base rules; ids
that occur more than once or are null get a row each; with no labelled rows the
list is empty and keeps what the base rules keep; an empty table gives an empty
result; columns other than the id and the text don't take part.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stockyard.llm.common import SPACE, keep_fraction, written

SYMBOLS = "#*$%&|<>"
#: Statistics that conditions may test; each is a ratio, so long and short texts compare.
STATISTICS = ("n_words", "word_length", "symbol_rate", "dup_line_rate", "repeat_rate")
MAX_ROWS = 20_000


def statistics(documents: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines (lines
    with a word)."""
    words = F.filter(F.split("__text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    lines = F.filter(F.split("__text", "\n"), lambda x: F.trim(x, F.lit(SPACE)) != "")
    base = documents.select(doc_id, F.coalesce(F.col(text), F.lit("")).alias("__text"))
    split = base.select(doc_id, "__text", words.alias("__words"), lines.alias("__lines"))
    # Each step reads the arrays of the step before as columns, so that none of them is
    # computed again inside a lambda.
    window = lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2))
    counted = split.select(
        doc_id,
        F.size("__words").cast("long").alias("n_words"),
        F.length(F.translate("__text", SPACE, "")).cast("long").alias("word_chars"),
        (F.length("__text") - F.length(F.translate("__text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long").alias("n_dup_lines"),
        F.size("__lines").cast("long").alias("n_lines"),
        F.when(F.size("__words") >= 3, F.transform(F.sequence(F.lit(0), F.size("__words") - 3), window)).alias("__keys"),
    )
    # Words in a 3-word window found twice or more: windows are compared by 64-bit hash, and
    # sorting brings equal ones together. Most texts have none, which a set shows sooner.
    repeated = F.size(F.array_distinct("__keys")) < F.size("__keys")
    order = F.sort_array(F.transform("__keys", lambda k, i: F.struct(k.alias("k"), i.alias("i"))))
    sorted_keys = counted.withColumn("__order", F.when(repeated, order)).drop("__keys")
    same = lambda x, at: F.get("__order", at)["k"].eqNullSafe(x["k"])
    none = F.array().cast("array<int>")
    spread = F.transform(
        "__order",
        lambda x, at: F.when(same(x, at - 1) | same(x, at + 1), F.array(x["i"], x["i"] + 1, x["i"] + 2)).otherwise(none),
    )
    n_repeat = F.coalesce(F.size(F.array_distinct(F.flatten(spread))), F.lit(0))
    return sorted_keys.withColumn("n_repeat_words", F.when(F.col("__order").isNull(), 0).otherwise(n_repeat).cast("long")).drop("__order")


def ratios(stats: DataFrame) -> DataFrame:
    per_word = F.greatest(F.col("n_words"), F.lit(1))
    return stats.withColumns(
        {
            "word_length": F.col("word_chars") / per_word,
            "symbol_rate": F.col("n_symbols") / per_word,
            "dup_line_rate": F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1)),
            "repeat_rate": F.col("n_repeat_words") / per_word,
        }
    )


@dataclass(frozen=True)
class Condition:
    statistic: str
    above: bool  # value > threshold, else value <= threshold
    threshold: float

    def column(self) -> Column:
        c = F.col(self.statistic)
        return c > self.threshold if self.above else c <= self.threshold


Rule = tuple[Condition, ...]


def as_expression(rules: list[Rule]) -> Column:
    """The ordered list as one conditional: the first rule that fires rejects."""
    out = None
    for rule in rules:
        test = rule[0].column()
        for c in rule[1:]:
            test = test & c.column()
        out = F.when(test, F.lit(False)) if out is None else out.when(test, F.lit(False))
    return F.lit(True) if out is None else out.otherwise(F.lit(True))


def learn(
    labelled: DataFrame, label: str = "quality", doc_id: str = "doc_id", bins: int = 16, max_rules: int = 8,
    max_conditions: int = 3, precision: float = 0.9, min_cover: int = 8,
) -> list[Rule]:
    """Rules for ``label`` = 0 from rows with the columns of ``ratios``."""
    shares = [k / bins for k in range(1, bins)]
    row = labelled.select(*(F.percentile_approx(F.col(s).cast("double"), shares, 10_000).alias(s) for s in STATISTICS)).first()
    borders = {s: sorted(set(row[s] or [])) for s in STATISTICS}
    cell = lambda s: F.size(F.filter(F.array(*(F.lit(float(b)) for b in borders[s])), lambda b: b < F.col(s).cast("double")))
    part = F.pmod(F.xxhash64(F.lit("prune"), doc_id), F.lit(3)) == 0
    counted = (
        labelled.select(*((cell(s) if borders[s] else F.lit(0)).alias(s) for s in STATISTICS), F.col(label).alias("__y"), part.alias("__p"))
        .groupBy(*STATISTICS, "__y", "__p").agg(F.count(F.lit(1)).alias("__n"))
    )
    rows = [(tuple(r[s] for s in STATISTICS), r["__y"] == 0, r["__p"], r["__n"]) for r in counted.collect()]  # at most max_rows
    tests = [(k, above, b) for k, s in enumerate(STATISTICS) for b in range(len(borders[s])) for above in (True, False)]
    fires = lambda t, cells: (cells[t[0]] > t[2]) == t[1]

    def totals(group: list) -> tuple[int, int]:
        bad = sum(n for _, y, _, n in group if y)
        return bad, sum(n for *_, n in group) - bad

    def grow(group: list) -> list:
        rule: list = []
        while len(rule) < max_conditions:
            p0, n0 = totals(group)
            if not p0 or not n0:
                break
            best, gain = None, 1e-9
            # Counts per cell of each statistic, then running sums: every threshold at once.
            for k, s in enumerate(STATISTICS):
                bad, good = [0] * (len(borders[s]) + 1), [0] * (len(borders[s]) + 1)
                for cells, y, _, n in group:
                    (bad if y else good)[cells[k]] += n
                low_p = low_n = 0
                for b in range(len(borders[s])):
                    low_p, low_n = low_p + bad[b], low_n + good[b]
                    for above, p, q in ((False, low_p, low_n), (True, p0 - low_p, n0 - low_n)):
                        if p >= min_cover:
                            g = p * (math.log2(p / (p + q)) - math.log2(p0 / (p0 + n0)))
                            if g > gain:
                                best, gain = (k, above, b), g
            if best is None:
                break
            rule.append(best)
            group = [r for r in group if fires(best, r[0])]
        return rule

    def worth(rule: list, group: list) -> float:
        p, n = totals([r for r in group if all(fires(t, r[0]) for t in rule)])
        return (p - n) / (p + n) if p + n else -1.0

    found: list[Rule] = []
    while len(found) < max_rules and tests:
        rule = grow([r for r in rows if not r[2]])
        if not rule:
            break
        held = [r for r in rows if r[2]]
        rule = max((rule[:k] for k in range(len(rule), 0, -1)), key=lambda r: worth(r, held))
        p, n = totals([r for r in rows if all(fires(t, r[0]) for t in rule)])
        if p < min_cover or p < precision * (p + n) or worth(rule, held) < 2 * precision - 1:
            break
        found.append(tuple(Condition(STATISTICS[k], above, float(borders[STATISTICS[k]][b])) for k, above, b in rule))
        rows = [r for r in rows if not all(fires(t, r[0]) for t in rule)]
    return found


def quality_rules(
    documents: DataFrame, labels: DataFrame, label: str = "quality", doc_id: str = "doc_id", text: str = "text",
    max_rows: int = MAX_ROWS,
) -> tuple[DataFrame, list[Rule]]:
    """Per document the statistics, base_failed and kept; and the learned rules."""
    stats = ratios(written(statistics(documents, doc_id, text), "quality"))
    marks = labels.filter(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
    # A few conflicting labels of one id count as the worse one.
    marks = marks.groupBy(doc_id).agg(F.min(label).alias("__label"))
    share = min(1.0, max_rows / max(1, marks.count()))
    some = marks.filter(keep_fraction(doc_id, share)).withColumnRenamed(doc_id, "__id")
    labelled = stats.join(some, F.col(doc_id) == F.col("__id")).drop("__id")
    rules = learn(written(labelled, "quality-labelled"), "__label", doc_id)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & as_expression(rules)), rules
