"""Operator 5 [native]: shards along a Hilbert curve over several metadata dimensions.

Each dimension is quantised into ``2**bits`` cells by its own quantiles (strings by
their order as whole values: distinct values with their counts, sorted, and the share of rows
before each of them), the cell coordinates give an index on the Hilbert curve, rows
are sorted by that index, and the sorted order is cut into runs of equal row
counts. Rows of one shard are then close in every dimension, so the min/max
statistics of its files prune filters on any of them.

The sort is a range partitioning on (index, id, ...): a hot cell splits over as
many partitions as its rows need. Row numbers come from the place of each row in
its partition plus the sizes of the partitions before it (one row per partition).
DataFrame functions only.

Defined results: law ``rows``, shard sizes differ by one at most; a null
dimension counts as its smallest value; a null text has size 8 and the crc32 of
the empty text; ``write_shards`` writes every row once, whatever its id; rows that agree in index and id are ordered by text hash, size
and crc32; repeated rows get a slot each; columns of the input other than the
named ones don't take part; an empty table gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockyard.llm.common import partitions, written


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """The Hilbert curve as a state machine. For state s = entry * dims + direction and
    the bits of one level as an octant o: index digit and next state at [s << dims | o]
    (the entry points and directions of Hamilton's compact Hilbert indices)."""
    size, full = 1 << dims, (1 << dims) - 1

    def turn(x: int, k: int) -> int:  # rotate right within dims bits
        k %= dims
        return ((x >> k) | (x << (dims - k))) & full

    def ungray(g: int) -> int:
        i = 0
        while g:
            i ^= g
            g >>= 1
        return i

    def trailing_ones(i: int) -> int:
        n = 0
        while i & 1:
            n, i = n + 1, i >> 1
        return n

    digit, following = [], []
    for entry in range(size):
        for direction in range(dims):
            for octant in range(size):
                w = ungray(turn(octant ^ entry, direction + 1))
                enter = 0 if w == 0 else (lambda k: k ^ (k >> 1))(2 * ((w - 1) // 2))
                along = 0 if w == 0 else (trailing_ones(w - 1) if w % 2 == 0 else trailing_ones(w)) % dims
                e = entry ^ turn(enter, -(direction + 1))
                digit.append(w)
                following.append(e * dims + (direction + along + 1) % dims)
    return digit, following


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """Index on the Hilbert curve of integer cell coordinates below ``2**bits``."""
    dims = len(cells)
    digit, following = curve_tables(dims)
    array = lambda xs: F.array(*(F.lit(x) for x in xs))
    octants = [
        reduce(lambda a, b: a.bitwiseOR(b), [F.shiftleft(F.shiftright(c, level).bitwiseAND(F.lit(1)), k) for k, c in enumerate(cells)])
        for level in range(bits - 1, -1, -1)
    ]

    def step(acc: Column, octant: Column) -> Column:
        at = F.shiftleft(acc["state"], dims).bitwiseOR(octant)
        return F.struct(
            F.get(array(following), at).alias("state"),
            F.shiftleft(acc["index"], dims).bitwiseOR(F.get(array(digit), at).cast("long")).alias("index"),
        )

    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))
    return F.aggregate(F.array(*octants), start, step, lambda acc: acc["index"])


def _is_number(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, (T.NumericType, T.DateType, T.TimestampType))


def _number(df: DataFrame, name: str) -> Column:
    """A number, date or time as a double in its own order."""
    c = F.col(name)
    return (c if isinstance(df.schema[name].dataType, T.NumericType) else c.cast("timestamp")).cast("double")


def _below(borders: Column, x: Column, equal: bool) -> Column:
    """How many borders are below x. (A function of two parameters, defaults included, would
    get the place of each border as its second.)"""
    return F.size(F.filter(borders, lambda b: b <= x if equal else b < x))


def string_borders(df: DataFrame, name: str, bits: int) -> list[str]:
    """The values at which the cells 1, 2, ... of a string dimension begin, ascending (less than
    ``2**bits``): a value's cell is the share of rows with a smaller one, in ``2**bits``ths."""
    spark = df.sparkSession
    value = F.col(name).cast("string")
    counts = df.groupBy(value.alias("value")).agg(F.count(F.lit(1)).alias("n"))
    # Distinct values may be many: sorted by ranges, and summed within each range first.
    ranges = counts.repartitionByRange(partitions(spark), F.col("value").asc_nulls_first()).sortWithinPartitions(F.col("value").asc_nulls_first())
    placed = written(ranges.withColumn("part", F.spark_partition_id()), "hilbert-values")
    sums = placed.groupBy("part").agg(F.sum("n").alias("n"))
    before = sums.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"), F.sum("n").over(Window.partitionBy()).alias("total"))
    within = Window.partitionBy("part").orderBy(F.col("value").asc_nulls_first())  # no larger than a range of the sort
    smaller = placed.withColumn("smaller", F.sum("n").over(within) - F.col("n")).join(F.broadcast(before), "part")  # one row a range
    cell = F.expr(f"((before + smaller) * {1 << bits}L) div total")
    cells = smaller.select("value", cell.alias("cell")).groupBy("cell").agg(F.min("value").alias("first"))
    return [r.first for r in cells.filter("cell > 0 and first is not null").orderBy("cell").select("first").collect()]  # below 2 ** bits


def ordered(df: DataFrame, dims: list[str], by: list[str], bits: int = 5, accuracy: int = 10_000) -> DataFrame:
    """``df`` with ``curve`` (Hilbert index over ``dims``) and ``position`` (from 0, without
    gaps) in the order of the index, then of the columns ``by``."""
    spark = df.sparkSession
    numbers = {d: F.coalesce(_number(df, d), F.lit(float("-inf"))) for d in dims if _is_number(df, d)}
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    cuts = {}
    if numbers:
        found = df.select(*(F.percentile_approx(x, shares, accuracy).alias(f"__{k}") for k, x in enumerate(numbers.values()))).first()
        cuts = {d: sorted(set(found[k] or [])) for k, d in enumerate(numbers)}
    cells = []
    for d in dims:
        if d in numbers:
            steps = F.array(*(F.lit(float(b)) for b in cuts[d]))
            cells.append(_below(steps, numbers[d], False) if cuts[d] else F.lit(0))
        else:
            borders = string_borders(df, d, bits)
            cells.append(_below(F.array(*map(F.lit, borders)), F.col(d).cast("string"), True) if borders else F.lit(0))
        cells[-1] = F.when(F.col(d).isNull(), F.lit(0)).otherwise(cells[-1])
    keyed = df.withColumn("curve", hilbert_index(cells, bits))
    n = partitions(spark)
    spread = keyed.repartitionByRange(n, "curve", *by).sortWithinPartitions("curve", *by)
    # The id holds the partition and the row's place in it; written once, it can't change.
    placed = written(spread.withColumn("__at", F.monotonically_increasing_id()), "hilbert")
    part = F.shiftright("__at", 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = sizes.select("__part", (F.sum("__n").over(Window.orderBy("__part")) - F.col("__n")).alias("__before"))
    # One row per partition of the sort above, so its size is bounded by their number.
    numbered = placed.withColumn("__part", part).join(F.broadcast(before), "__part")
    within = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return numbered.withColumn("position", F.col("__before") + within).drop("__part", "__before", "__at")


def cut(df: DataFrame, n_shards: int) -> DataFrame:
    """``df`` with ``position`` cut into runs: adds shard and slot, counts one apart at most."""
    total = max(1, df.count())
    # Integer division keeps the borders exact for any number of rows.
    with_shard = df.withColumn("shard", F.expr(f"cast((position * {n_shards}L) div {total}L as int)"))
    start = F.expr(f"(cast(shard as long) * {total}L + {n_shards - 1}L) div {n_shards}L")
    return with_shard.withColumn("slot", F.col("position") - start)


def hilbert_shards(
    documents: DataFrame, n_shards: int = 24, dims: tuple[str, ...] = ("source", "lang", "n_chars"), bits: int = 5,
    doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, the dimensions, curve, position,
    shard and slot."""
    raw = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = documents.select(
        doc_id, *(F.col(d) for d in dims), (F.octet_length(raw) + 8).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"), F.xxhash64(text).alias("__text"),
    )
    return cut(ordered(rows, list(dims), [doc_id, "__text", "size", "text_crc32"], bits), n_shards).drop("__text")


def write_shards(
    documents: DataFrame, path: str, n_shards: int = 24, dims: tuple[str, ...] = ("source", "lang", "n_chars"), bits: int = 5,
    doc_id: str = "doc_id", text: str = "text",
) -> None:
    """Write the documents, all their columns with them, as one sorted run of files per shard."""
    row = F.struct(*(F.col(c) for c in documents.columns)).alias("__row")
    keys = documents.select(F.col(doc_id).alias("__id"), F.xxhash64(text).alias("__text"), *(F.col(d).alias(f"__{d}") for d in dims), row)
    placed = cut(ordered(keys, [f"__{d}" for d in dims], ["__id", "__text"], bits), n_shards)
    # Columns of the documents keep their names; a shard column of their own gives way.
    names = [c if c not in documents.columns else f"__{c}" for c in ("shard", "slot")]
    whole = placed.select(*(F.col("__row")[c].alias(c) for c in documents.columns), *(F.col(c).alias(n) for c, n in zip(("shard", "slot"), names)))
    runs = whole.repartitionByRange(partitions(documents.sparkSession), *names)
    runs.sortWithinPartitions(*names).write.partitionBy(names[0]).parquet(path)
