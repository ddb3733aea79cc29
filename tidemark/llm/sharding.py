"""Sharding by a hierarchical weighted hash tree.

A row descends region, rack and shard levels.  At each node every child draws
``-ln(u) / weight`` with ``u`` in (0, 1) from a hash of the row's key and the child's name;
the smallest draw wins (a child wins with probability weight / sum of its siblings'
weights).  A draw depends on the key and that child alone, so a changed weight moves rows
only into or out of its own subtree, and a new child takes rows only into itself.

A shard that is added to the default layout opens a region of its own: rows move to it and
nowhere else.  Put into an existing rack it would also raise the weights above it, and the
rows these pull in would spread over the whole subtree; no other subtree would change.

Everything is Spark SQL: the draws are expressions, and slots come from ranks within
(range partition, shard) cells plus a running sum of cell counts, so neither a shard nor a
repeated key is ever ranked in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shuffle_partitions, take, text_of


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; a shard has a number, the others have children."""

    name: str
    weight: float = 1.0
    children: tuple["Node", ...] = field(default_factory=tuple)
    shard: int | None = None


def group(name: str, children: list[Node]) -> Node:
    """An inner node; its weight is the sum of its children's weights."""
    return Node(name, sum(c.weight for c in children), tuple(children))


def default_tree(shards: int, grown: int = 0, racks: int = 2, per_rack: int = 2) -> Node:
    """``shards`` shards of weight 1 in full regions of racks, then ``grown`` more shards,
    each in a new region of its own."""
    if shards < 1:
        raise ValueError("a tree needs a shard")
    leaf = [Node(f"shard{i}", 1.0, (), i) for i in range(shards + grown)]
    racked = [group(f"rack{i // per_rack}", leaf[i:min(i + per_rack, shards)])
              for i in range(0, shards, per_rack)]
    regions = [group(f"region{i // racks}", racked[i:i + racks]) for i in range(0, len(racked), racks)]
    regions += [group(f"grown-region{s.shard}", [group(f"grown-rack{s.shard}", [s])]) for s in leaf[shards:]]
    return group("root", regions)


def draw(key: Column, node: Node) -> Column:
    """Exponential draw of one child: 52 hash bits as u in (0, 1)."""
    bits = F.conv(F.substring(F.md5(F.concat(F.lit(f"{node.name}|"), key)), 1, 13), 16, 10).cast("double")
    return -F.ln((bits + 0.5) / F.lit(float(2 ** 52))) / F.lit(float(node.weight))


def shard_of(key: Column, node: Node) -> Column:
    """The shard the key descends to."""
    if node.shard is not None:
        return F.lit(node.shard)
    live = [c for c in node.children if c.weight > 0]
    if not live:
        raise ValueError(f"{node.name} has no child with a weight")
    if len(live) == 1:
        return shard_of(key, live[0])
    best = F.array_min(F.array(*[F.struct(draw(key, c).alias("d"), F.lit(i).alias("i"))
                                 for i, c in enumerate(live)]))["i"]
    out = F.when(best == 0, shard_of(key, live[0]))
    for i, c in enumerate(live[1:], 1):
        out = out.when(best == i, shard_of(key, c))
    return out


def key_text(col: str) -> Column:
    return F.coalesce(F.col(col).cast("string"), F.lit("null"))


def with_slots(rows: DataFrame, order: list[str], shard: str = "shard") -> DataFrame:
    """``rows`` plus ``slot``: rank by ``order`` within the shard, gapless from 0.

    Rows are range partitioned by ``order`` (a row number breaks ties, so a repeated key is
    split), ranked in each (partition, shard) cell, and shifted by the rows of the shard in
    earlier partitions.
    """
    parts = shuffle_partitions(rows)
    keyed = rows.withColumn("tie", F.monotonically_increasing_id())
    ranged = materialize(keyed.repartitionByRange(parts, *[F.col(c).asc_nulls_first() for c in order], "tie")
                         .withColumn("cell", F.spark_partition_id()), "shard-cells")
    before = Window.partitionBy(shard).orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (ranged.groupBy(shard, "cell").agg(F.count(F.lit(1)).alias("n"))
               .select(shard, "cell", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead")))
    rank = F.row_number().over(Window.partitionBy("cell", shard).orderBy(
        *[F.col(c).asc_nulls_first() for c in order], "tie"))
    return (ranged.withColumn("rank", rank).join(offsets, ["cell", shard])
            .withColumn("slot", F.col("ahead") + F.col("rank") - 1).drop("cell", "rank", "ahead", "tie"))


def assign_shards(docs: DataFrame, tree: Node, grown: Node | None = None,
                  id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, size, text_crc32, shard, grown_shard, slot``.

    The key (``id_col`` as text) and the tree alone decide the shard; ``grown_shard`` is the
    shard in the grown tree, null without one.  ``size`` is the text's UTF-8 bytes plus 1.
    Null texts count as empty; rows without an identifier share the key ``null`` and so one
    shard; repeated rows get the same shard and slots of their own, ranked by identifier,
    checksum and size.  An empty table gives an empty result; other columns are ignored.
    """
    rows = take(docs, id=id_col, text=text_col)
    key = key_text("id")
    slim = rows.select(
        "id", (F.octet_length(text_of("text")).cast("long") + 1).alias("size"),
        F.crc32(text_of("text").cast("binary")).alias("text_crc32"),
        shard_of(key, tree).cast("int").alias("shard"),
        (shard_of(key, grown) if grown else F.lit(None)).cast("int").alias("grown_shard"))
    return with_slots(materialize(slim, "shard-rows"), ["id", "text_crc32", "size"])
