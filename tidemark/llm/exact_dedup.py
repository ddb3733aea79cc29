"""Exact dedup: a tree merge of sorted digest runs.

Every text is reduced to a digest key: SHA-256 of the normalised text, plus an
independent 64-bit hash and the byte length that verify it.  Texts never move; the tree
works on about 60 bytes per row.

Level 0: rows are dealt to ``fan_in ** rounds`` blocks by row number, and each block keeps
a sorted run with one entry per key: smallest identifier and count.  In each round
``fan_in`` neighbouring blocks exchange their runs (block number divided by ``fan_in``) and
merge them by key: the verified smallest identifier and the summed count survive, at every
level.  After the last round one block number is left and each key has one entry.  All
runs stay partitioned by (block, key), so no task ever holds a whole run, and a key gets at
most ``fan_in`` entries per merge: a text that a third of all rows share is merged by its
blocks first and never meets in one task.

The winners go back down the same tree, again ``fan_in`` entries per key and block, so the
final lookup is on (block, key) and has no hot key either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import flat_name, flatten, materialize, restore, shuffle_partitions, take, text_of

WHITE = r"[\x20\x09-\x0D]+"
KEY = ("digest", "check", "n_bytes")


def normalise(text: Column) -> Column:
    """Each run of ASCII white space as one space."""
    return F.regexp_replace(text, WHITE, " ")


def digest_key(text: Column) -> list[Column]:
    """Digest, verifying hash and byte length of the normalised text."""
    norm = normalise(text)
    return [F.unhex(F.sha2(norm, 256)).alias("digest"), F.xxhash64(norm).alias("check"),
            F.octet_length(norm).alias("n_bytes")]


def tree_rounds(partitions: int, fan_in: int) -> int:
    """Rounds after which ``fan_in ** rounds`` blocks are at least the partitions."""
    rounds = 1
    while fan_in ** rounds < partitions:
        rounds += 1
    return rounds


def digest_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                uid_col: str | None = None) -> DataFrame:
    """One row per input row: ``id, uid, digest, check, n_bytes``, written to the shared folder.

    ``uid`` is the row number, or the column ``uid_col`` if the rows have one."""
    rows = take(docs, id=id_col, text=text_col, **({"uid": uid_col} if uid_col else {}))
    uid = F.col("uid") if uid_col else F.monotonically_increasing_id().alias("uid")
    return materialize(rows.select("id", uid, *digest_key(text_of("text"))), "digests")


def merge_tree(runs: DataFrame, fan_in: int = 8) -> DataFrame:
    """``runs`` plus ``keep`` (struct: no id, id, uid) and ``group_size`` of each row's key."""
    rounds = tree_rounds(shuffle_partitions(runs), fan_in)
    blocks = fan_in ** rounds
    leaf = F.pmod(F.xxhash64("uid"), F.lit(blocks)).alias("block")
    entry = F.struct(F.col("id").isNull().alias("no_id"), "id", "uid")
    level = materialize(
        runs.groupBy(leaf, *KEY).agg(F.min(entry).alias("keep"), F.count(F.lit(1)).alias("group_size")),
        "run0")
    levels = [level]
    for r in range(1, rounds + 1):
        up = F.expr(f"block div {fan_in}").alias("block")
        level = level.groupBy(up, *KEY).agg(F.min("keep").alias("keep"),
                                            F.sum("group_size").alias("group_size"))
        if r < rounds:
            level = materialize(level, f"run{r}")
            levels.append(level)
    for below in reversed(levels):
        lower = below.select("block", *KEY, F.expr(f"block div {fan_in}").alias("up"))
        upper = level.withColumnRenamed("block", "up")
        level = lower.join(upper, ["up", *KEY]).drop("up")
    return runs.withColumn("block", leaf).join(level, ["block", *KEY]).drop("block")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 fan_in: int = 8) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, digest, check, n_bytes``.

    Null texts count as empty, and empty texts are equal to one another.  A row without an
    identifier ranks after all rows with one; of rows with the same identifier and text
    (repeated rows) exactly one is kept.  An empty table gives an empty result; columns
    other than the two named are ignored, whatever they are called.
    """
    runs = merge_tree(digest_runs(docs, id_col, text_col), fan_in)
    return runs.select("id", F.col("keep.id").alias("keep_id"), "group_size",
                       (F.col("uid") == F.col("keep.uid")).alias("kept"), *KEY)


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      fan_in: int = 8) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns.

    One row per text: the one with the smallest identifier, rows without one last; of several
    rows with that identifier the first in the order in which ``docs`` was read.  The rows are
    numbered in a written table first, so the row that stays, other columns included, is the
    one whose number won the merge, and a text that many rows share is no join key.
    """
    numbered = materialize(flatten(docs).withColumn("uid", F.monotonically_increasing_id()), "exact-copies")
    runs = merge_tree(digest_runs(numbered, flat_name(docs, id_col), flat_name(docs, text_col), "uid"), fan_in)
    gone = runs.where(F.col("uid") != F.col("keep.uid")).select("uid")
    return restore(numbered.join(gone, "uid", "left_anti"), docs)
