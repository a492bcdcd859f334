"""Sharding by a hierarchical weighted hash tree, in DataFrame functions only.

A document descends from the root through region and rack to a shard.  At each
level every child draws -ln(u) / weight from a hash of the document's key and
the child's name, and the least draw wins, so a child gets documents in
proportion to its weight.  A draw depends on nothing but key, name and weight:
at every level, raising one child's weight, or adding a child, moves documents
only into it, lowering it only out of it, and subtrees whose weights stay as
they are exchange nothing with each other.

Defined cases: a null key is the word ``null``; a null text has size 1 and the
crc32 of an empty text; repeated rows go to one shard and take different
slots; a text of any length counts as one row; columns of other names or of
clashing ones are not read; an empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlens.llm.common import texts

#: Rows that a slot bin has on average, and the longest run of slots that is unfolded at a time.
BIN_ROWS = 65_536
#: Bins' worth of rows that a task unfolds.
TASK_BINS = 32


@dataclass(frozen=True)
class Node:
    """A subtree: ``children``, or a shard.  A node's weight is its shards' sum."""

    name: str
    children: tuple["Node", ...] = ()
    shard: int | None = None
    own_weight: float = 1.0

    @property
    def weight(self) -> float:
        return sum(c.weight for c in self.children) if self.children else self.own_weight


def even_tree(regions: int = 2, racks: int = 2, shards: int = 2) -> Node:
    return Node("root", tuple(
        Node(f"{a}", tuple(
            Node(f"{a}.{b}", tuple(
                Node(f"{a}.{b}.{c}", shard=(a * racks + b) * shards + c) for c in range(shards)))
            for b in range(racks)))
        for a in range(regions)))


def with_shard(tree: Node, shard: int, weight: float = 1.0) -> Node:
    """The tree with one more shard, in a region and rack of its own, so that
    no other subtree's weight changes and documents move into it alone."""
    a = f"{len(tree.children)}"
    return Node(tree.name, (*tree.children, Node(a, (Node(f"{a}.0", (Node(f"{a}.0.0", shard=shard, own_weight=weight),)),))))


def draw(key: Column, child: Node) -> Column:
    """-ln(u) / weight with u in (0, 1) from 52 bits of the md5 of key and name."""
    bits = F.conv(F.substring(F.md5(F.concat(key, F.lit(f"|{child.name}")).cast("binary")), 1, 13), 16, 10).cast("double")
    return -F.log((bits + 0.5) / float(2**52)) / float(child.weight)


def descend(key: Column, node: Node) -> Column:
    """The shard that the key reaches below node."""
    if not node.children:
        return F.lit(node.shard).cast("int")
    if len(node.children) == 1:
        return descend(key, node.children[0])
    draws = F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i")) for i, c in enumerate(node.children)])
    won = F.array_min(draws)["i"]
    out = F.when(won == 0, descend(key, node.children[0]))
    for i, child in enumerate(node.children[1:], 1):
        out = out.when(won == i, descend(key, child))
    return out


def key_of(doc_id: Column) -> Column:
    return F.coalesce(doc_id.cast("string"), F.lit("null"))


def assign(docs: DataFrame, tree: Node, grown: Node | None = None, bin_rows: int = BIN_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every document.

    Slots number a shard's documents from 0 without gaps.  Rows equal in all
    that is returned are counted first.  These counted rows are dealt into bins by a hash
    of all three values, so many texts of one id (or of none) do not meet; a
    small table of bin sizes, summed along each shard, gives every bin its
    first slot.  A counted row stands for a run of slots, which is cut into
    stretches of ``bin_rows`` that are dealt anew and unfolded, so that
    no task writes all copies of one row.
    """
    rows = texts(docs)
    count = rows.count()
    bins = count // bin_rows + 1
    # a number of its own: coalescing would go by the bytes before unfolding
    tasks = max(docs.sparkSession.sparkContext.defaultParallelism, count // (TASK_BINS * bin_rows) + 1)
    key = key_of(F.col("doc_id"))
    spread = F.md5(F.concat_ws("|", key, "text_crc32", "size", F.lit("bin")).cast("binary"))
    dealt = (rows.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"))
        .groupBy("doc_id", "size", "text_crc32").agg(F.count(F.lit(1)).alias("rows"))
        # never null, and told so: a join's null filter would reach one side's scan only, and the texts be read twice
        .withColumns({
            "shard": F.coalesce(descend(key, tree), F.lit(0)),
            "grown_shard": descend(key, grown) if grown else F.lit(None).cast("int"),
            "bin": F.coalesce(F.conv(F.substring(spread, 1, 13), 16, 10).cast("long") % bins, F.lit(0))}))
    in_bin = Window.partitionBy("shard", "bin").orderBy("doc_id", "text_crc32", "size").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("shard").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    first = (dealt.groupBy("shard", "bin").agg(F.sum("rows").alias("rows"))
             .select("shard", "bin", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("first")))
    runs = (dealt.withColumn("place", F.coalesce(F.sum("rows").over(in_bin), F.lit(0)))
            .join(first, ["shard", "bin"])
            .withColumns({"from": F.col("first") + F.col("place"), "end": F.col("first") + F.col("place") + F.col("rows")}))
    stretches = (runs.withColumn("slot", F.explode(F.expr(f"sequence(from, end - 1, {bin_rows}L)")))
                 .withColumn("end", F.least("end", F.col("slot") + bin_rows))
                 .repartition(tasks, "shard", "slot"))
    return (stretches.withColumn("slot", F.explode(F.expr("sequence(slot, end - 1)")))
            .select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), "grown_shard"))
