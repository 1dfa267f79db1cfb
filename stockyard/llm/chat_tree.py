"""Operator 9: chat formatting as a prefix tree.

Conversations that begin with the same turns share these turns' text. A turn's
identity is the hash chain of all turns up to it, so equal beginnings meet by
grouping on one key. Each tree of shared beginnings is written out depth first,
every node once. A node is owned by the smallest conversation that has it; the
nodes that a conversation owns are one run at the end of its path, a *chain*.
Depth-first order is chain by chain: a chain's key lists where its path leaves
other chains (deepest branch first), and keys compare like arrays. Positions in
the stream are running sums over a range-partitioned sort, so one tree may hold
any share of all rows.

Per node: its place in the stream, its position id (how much of its conversation
comes before it) and, as the intervals it may attend to, the parts of the
stream that hold its ancestors: one interval per chain on its path. The unit
of places, positions and loss is the code point.

Template: ``<|turn|>role\\ntext<|end|>`` per turn. Inside roles and texts, control
strings get a backslash after their first character; those that already have
backslashes there get one more, so unescaping is exact. A role's line feeds are
escaped too. Loss covers the texts of assistant turns.

Defined results: null roles and texts count as empty; turns are ordered by
(turn, role, text), nulls first, so ties and repeated rows stay as further turns;
rows with a null conversation form one conversation; other columns don't take
part; an empty table gives empty results.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockyard.llm.common import partitions, written

#: The template's marks and strings that other templates use.
OPEN, CLOSE = "<|turn|>", "<|end|>"
CONTROL = (OPEN, CLOSE, "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
_TAILS = "|".join(sorted({re.escape(c[1:]) for c in CONTROL}))
_PLAIN = rf"([<\[])(\\*)(?={_TAILS})"
_ESCAPED = rf"([<\[])\\(\\*)(?={_TAILS})"


def escape(c: Column) -> Column:
    return F.regexp_replace(c, _PLAIN, r"$1\\$2")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, _ESCAPED, "$1$2")


def escape_role(c: Column) -> Column:
    """As ``escape``, with backslashes doubled and line feeds as backslash and n."""
    return escape(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(c: Column) -> Column:
    # An n behind an odd number of backslashes is a line feed; then pairs become single.
    lines = F.regexp_replace(unescape(c), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(lines, F.lit("\\\\"), F.lit("\\"))


@dataclass(frozen=True)
class ChatTree:
    """``nodes``: owner, depth, text (formatted), stream_start, stream_end, position,
    loss_start and loss_end (in the node's text), attends (array of stream intervals).
    ``paths``: conv, n_turns, runs (array of owner, first and last depth): the chains that
    hold the conversation."""

    nodes: DataFrame
    paths: DataFrame


def build(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> ChatTree:
    role_c, text_c = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    rows = conversations.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), role_c.alias("role"), text_c.alias("text"))
    in_conv = Window.partitionBy("conv").orderBy("turn", "role", "text")
    head, tail = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n")), F.lit(CLOSE)
    body = escape(F.col("text"))
    turns = rows.withColumn("depth", F.row_number().over(in_conv) - 1).select(
        "conv", "depth", F.concat(head, body, tail).alias("text"),
        F.length(head).alias("loss_start"),
        F.when(F.col("role") == "assistant", F.length(head) + F.length(body)).otherwise(F.length(head)).alias("loss_end"),
    )
    turns = turns.withColumn("own", F.md5("text")).withColumn("size", F.length("text").cast("long"))
    chained = written(_chain(turns.select("conv", "depth", "own", "size")), "chat-chained")
    owners = chained.groupBy("node").agg(F.min(F.struct(F.col("conv").isNotNull(), "conv")).alias("__o"))
    owned = chained.join(owners, "node").select("conv", "depth", "size", "position", F.col("__o.conv").alias("owner"))
    owned = written(owned, "chat-owned")
    # A path's runs: one row per chain on it, in order of depth.
    runs = owned.groupBy("conv", "owner").agg(F.min("depth").alias("first"), F.max("depth").alias("last"))
    listed = F.sort_array(F.collect_list(F.struct("first", "last", "owner")))
    paths = runs.groupBy("conv").agg(listed.alias("runs"), (F.max("last") + 1).alias("n_turns"))
    # Key of a chain: owner of the root, then for each branch its depth (deeper first) and owner.
    key = F.flatten(F.transform("runs", lambda r: F.array((-r["first"]).cast("long"), r["owner"].cast("long"))))
    known = paths.withColumn("order", F.transform(key, lambda x: F.coalesce(x, F.lit(-(2**63)))))
    mine = owned.filter(F.col("owner").eqNullSafe(F.col("conv"))).select("conv", "depth", "size", "position")
    ordered = mine.join(known.select(F.col("conv").alias("__c"), "order"), F.col("conv").eqNullSafe(F.col("__c"))).drop("__c")
    placed = _running(ordered)
    # Where each chain lies: its first node's depth and place tell the place of all its nodes.
    spans = placed.select(F.col("conv").alias("owner"), "depth", "stream_start", "stream_end")
    placed = written(spans, "chat-placed")
    attends = _attends(paths, placed)
    own_text = turns.select(F.col("conv").alias("__c"), F.col("depth").alias("__d"), "text", "loss_start", "loss_end")
    starts = mine.select(F.col("conv").alias("__c2"), F.col("depth").alias("__d2"), "position")
    nodes = (
        placed.join(own_text, F.col("owner").eqNullSafe(F.col("__c")) & (F.col("depth") == F.col("__d")))
        .join(starts, F.col("owner").eqNullSafe(F.col("__c2")) & (F.col("depth") == F.col("__d2")))
        .select("owner", "depth", "text", "stream_start", "stream_end", "position", "loss_start", "loss_end")
    )
    nodes = nodes.join(attends, nodes["owner"].eqNullSafe(attends["__owner"]), "left").drop("__owner")
    return ChatTree(nodes, paths.select("conv", "n_turns", "runs"))


def _chain(light: DataFrame) -> DataFrame:
    """conv, depth, size, node (hash of all turns up to it), position (sizes before it),
    by one pass over the sorted turns of each partition."""
    n = partitions(light.sparkSession)
    dealt = light.repartition(n, "conv").sortWithinPartitions("conv", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, node, position = object(), b"", 0
        for b in batches:
            nodes, places = [], []
            for c, own, size in zip(b.column("conv").to_pylist(), b.column("own").to_pylist(), b.column("size").to_pylist()):
                if c != last:
                    last, node, position = c, b"", 0
                node = hashlib.md5(node + own.encode()).digest()
                nodes.append(node)
                places.append(position)
                position += size
            yield pa.RecordBatch.from_arrays(
                [b.column("conv"), b.column("depth"), b.column("size"), pa.array(nodes, pa.binary()), pa.array(places, pa.int64())],
                names=["conv", "depth", "size", "node", "position"],
            )

    kind = light.schema["conv"].dataType.simpleString()
    return dealt.mapInArrow(run, f"conv {kind}, depth int, size long, node binary, position long")


def _running(ordered: DataFrame) -> DataFrame:
    """stream_start and stream_end: running sums of size in the order of (order, depth)."""
    spark = ordered.sparkSession
    spread = ordered.repartitionByRange(partitions(spark), "order", "depth").sortWithinPartitions("order", "depth")
    kind = ordered.schema["conv"].dataType.simpleString()

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = 0
        for b in batches:
            ends = []
            for size in b.column("size").to_pylist():
                total += size
                ends.append(total)
            yield pa.RecordBatch.from_arrays([b.column("conv"), b.column("depth"), b.column("size"), pa.array(ends, pa.int64()), b.column("part")], names=["conv", "depth", "size", "within", "part"])

    columns = spread.select("conv", "depth", "size", F.spark_partition_id().alias("part"))
    summed = written(columns.mapInArrow(sums, f"conv {kind}, depth int, size long, within long, part int"), "chat-sums")
    totals = summed.groupBy("part").agg(F.max("within").alias("total"))
    before = totals.select("part", (F.sum("total").over(Window.orderBy("part")) - F.col("total")).alias("before"))
    # One row per partition of the sort above.
    placed = summed.join(F.broadcast(before), "part")
    end = F.col("before") + F.col("within")
    return placed.select("conv", "depth", (end - F.col("size")).alias("stream_start"), end.alias("stream_end"))


def _attends(paths: DataFrame, placed: DataFrame) -> DataFrame:
    """For the owner of a chain: the stream intervals of the chains that its path has come
    through before (its own nodes see these and what precedes them in their chain)."""
    owners = paths.filter(F.element_at("runs", -1)["owner"].eqNullSafe(F.col("conv")))
    each = owners.select(F.col("conv").alias("__owner"), F.posexplode("runs").alias("k", "run"))
    each = each.select("__owner", "k", F.col("run.owner").alias("chain"), F.col("run.first").alias("first"), F.col("run.last").alias("last"))
    edge = placed.select(F.col("owner").alias("__o"), F.col("depth").alias("__d"), "stream_start", "stream_end")
    a, b = edge.alias("a"), edge.alias("b")
    hit = each.join(a, (F.col("chain").eqNullSafe(F.col("a.__o"))) & (F.col("first") == F.col("a.__d")))
    hit = hit.join(b, (F.col("chain").eqNullSafe(F.col("b.__o"))) & (F.col("last") == F.col("b.__d")))
    rows = hit.select("__owner", F.struct("k", F.col("a.stream_start").alias("start"), F.col("b.stream_end").alias("end")).alias("x"))
    listed = F.sort_array(F.collect_list("x"))
    return rows.groupBy("__owner").agg(F.transform(listed, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("attends"))


def read_back(tree: ChatTree) -> DataFrame:
    """The conversations as the tree's output has them: conv, n_turns, turns (array of role,
    text, in_loss), formatted_chars."""
    each = tree.paths.select("conv", "n_turns", F.explode("runs").alias("run"))
    each = each.select("conv", "n_turns", F.col("run.owner").alias("owner"), F.explode(F.sequence("run.first", "run.last")).alias("depth"))
    node = tree.nodes.select(F.col("owner").alias("__o"), F.col("depth").alias("__d"), "text", "loss_start", "loss_end")
    joined = each.join(node, F.col("owner").eqNullSafe(F.col("__o")) & (F.col("depth") == F.col("__d")))
    whole = F.expr(f"substring(text, {len(OPEN) + 1}, length(text) - {len(OPEN) + len(CLOSE)})")
    role = unescape_role(F.substring_index(whole, "\n", 1))
    body = F.expr("substring(text, loss_start + 1, length(text) - loss_start - %d)" % len(CLOSE))
    loss = F.expr("substring(text, loss_start + 1, loss_end - loss_start)")
    turn = F.struct("depth", role.alias("role"), unescape(body).alias("text"), unescape(loss).alias("loss"))
    rows = joined.select("conv", "n_turns", turn.alias("turn"), F.length("text").alias("chars"))
    out = rows.groupBy("conv", "n_turns").agg(F.sort_array(F.collect_list("turn")).alias("turns"), F.sum("chars").alias("formatted_chars"))
    return out
