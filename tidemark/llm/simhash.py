"""SimHash near-dedup by the generalised pigeonhole principle.

1. Fingerprints: one Arrow pass over the texts (shingle hashes and bit votes in numpy).
2. Equal fingerprints become one representative; only representatives are searched.
3. The 64 bits are grouped into partitions of correlated bits (bit co-occurrence counts
   over all representatives).  If two fingerprints differ in at most d bits and the
   partitions' thresholds t_i add up to d - m + 1, then some partition i has them differing
   in at most t_i of its bits.  The unequal thresholds (-1: the partition is not probed)
   come from a dynamic program over the estimated candidate counts of each partition and
   threshold: the patterns of each partition are counted over all representatives, and a
   dependence tree over the 64 bits (from the pair counts) carries the counts on to larger
   thresholds and further levels.
4. A partition with threshold t is probed with one mask per choice of t of its bits to
   leave out: fingerprints equal under a mask are candidates of that mask.  While the chance
   candidates expected under a mask cost more than its probes, its remaining bits are
   partitioned and allocated in the same way.
5. Verify without pairs: two fingerprints differ in at most 2r bits exactly if their balls
   of radius r meet, and of candidates of a mask only bits outside it can differ.  Each
   candidate puts its ball (1 + at most 64 keys for d = 2) under hash keys; the at most 65
   fingerprints around a key form a chain of links, each checked by its bit count.  The
   work is linear in the fingerprints, however large a group of near copies is, and no link
   between different fingerprints is lost: linked ones are in one chain or joined by chains.
6. Components by minimum labels with hooking and pointer jumping, one table per round.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import flat_name, flatten, materialize, restore, take, text_of
from tidemark.session import ship_package

BITS = 64
SEED = 42
FEWEST_FREE = 20  # a mask with fewer bits outside it is not refined (over 2^44 patterns)


def fingerprint(text: str, shingle: int) -> int:
    """SimHash of one text as an unsigned integer; 0 without words.

    Words are split at ASCII white space and lower-cased in A-Z only; a text with fewer
    words than ``shingle`` is one shingle.
    """
    words = text.encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), SEED)
    join, digest = b" ".join, xxhash.xxh64_intdigest
    votes, total = np.zeros(BITS, np.int64), len(words) - shingle + 1
    for at in range(0, total, 1 << 16):
        part = words[at:at + (1 << 16) + shingle - 1]
        runs = zip(*[part[i:len(part) - shingle + 1 + i] for i in range(shingle)])
        h = np.fromiter((digest(join(r), SEED) for r in runs), np.uint64)
        bits = np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(votes * 2 > total, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, fp`` (the fingerprint's 64 bits as a long) per row, written to the shared folder."""
    ship_package(docs.sparkSession)
    rows = take(docs, id=id_col, text=text_col)
    schema = rows.select("id", F.lit(0).cast("long").alias("fp")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            fp = np.array([fingerprint(t.as_py() or "", shingle) for t in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["id", "fp"])

    return materialize(rows.select("id", text_of("text").alias("text")).mapInArrow(run, schema), "fingerprints")


def bit_counts(fps: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and how many have bits i and j both set (64 x 64)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, both = 0, np.zeros((BITS, BITS), np.int64)
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).astype("<i8")
            bits = np.unpackbits(fp.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float32)
            n += len(fp)
            both += (bits.T @ bits).astype(np.int64)
        at = np.arange(BITS * BITS + 1)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(both.ravel(), n))], names=["cell", "n"])

    rows = (fps.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell")
            .agg(F.sum("n").alias("n")).collect())  # 4,097 numbers at any size
    flat = np.zeros(BITS * BITS + 1, np.int64)
    for r in rows:
        flat[r["cell"]] = r["n"]
    return int(flat[-1]), flat[:-1].reshape(BITS, BITS)


def group_bits(n: int, both: np.ndarray, bits: list[int], parts: int) -> list[list[int]]:
    """The given bits in ``parts`` groups of near equal size, correlated bits together.

    Greedy: a group starts with the strongest remaining bit and takes the bits with the
    largest absolute correlation to those it has.
    """
    p = np.diag(both) / max(n, 1)
    var = p * (1 - p)
    cov = both / max(n, 1) - np.outer(p, p)
    scale = np.sqrt(np.outer(var, var))
    corr = np.abs(np.divide(cov, scale, out=np.zeros_like(cov), where=scale > 0))
    left, groups = set(bits), []
    for g in range(parts):
        size = len(left) // (parts - g)
        first = max(left, key=lambda b: (sum(corr[b, c] for c in left if c != b), -b))
        group = [first]
        left.remove(first)
        while len(group) < size:
            best = max(left, key=lambda b: (sum(corr[b, c] for c in group), -b))
            group.append(best)
            left.remove(best)
        groups.append(sorted(group))
    return groups


class BitModel:
    """Joint distribution of the bits as a dependence tree, from their measured pair counts.

    Each bit depends on one other bit, and the tree has the largest total mutual information
    (a maximum spanning tree).  Pair counts are smoothed by a quarter of a fingerprint a cell.
    """

    def __init__(self, n: int, both: np.ndarray) -> None:
        self.n = n
        one = (np.diag(both) + 0.5) / (n + 1)
        cell = np.empty((2, 2, BITS, BITS))  # cell[x, y, i, j] = P(bit i is x, bit j is y)
        cell[1, 1] = (both + 0.25) / (n + 1)
        cell[1, 0] = one[:, None] - cell[1, 1]
        cell[0, 1] = one[None, :] - cell[1, 1]
        cell[0, 0] = 1 - cell[1, 1] - cell[1, 0] - cell[0, 1]
        side = np.stack([1 - one, one])
        apart = side[:, None, :, None] * side[None, :, None, :]
        off = ~np.eye(BITS, dtype=bool)
        info = np.sum(np.where(off, cell * np.log(np.where(off, cell / apart, 1.0)), 0.0), axis=(0, 1))
        self.order, self.parent = [0], {}
        gain, via = info[0].copy(), np.zeros(BITS, int)
        left = set(range(1, BITS))
        while left:
            b = max(left, key=lambda i: (gain[i], -i))
            left.remove(b)
            self.order.append(b)
            self.parent[b] = int(via[b])
            closer = info[b] > gain
            gain[closer], via[closer] = info[b][closer], b
        # states are (bit of one fingerprint, bit of the other), numbered 2 x + y
        self.root = np.kron(side[:, 0], side[:, 0])
        self.step = {}
        for b, up in self.parent.items():
            given = cell[:, :, up, b] / side[:, up][:, None]  # row: value of the bit above
            self.step[b] = np.kron(given, given)

    def pairs(self, held: int, group: list[int], most: int) -> list[float]:
        """Expected pairs of fingerprints that agree on the bits of ``held`` and differ in at
        most 0..``most`` bits of ``group``; the other bits are free."""
        differ = np.array([False, True, True, False])
        inside = set(group)
        up = {b: np.eye(1, most + 1).repeat(4, axis=0) for b in self.order}
        for b in reversed(self.order):
            local = up[b]
            if held >> b & 1:
                local[differ] = 0.0
            elif b in inside:
                local[differ, 1:] = local[differ, :-1]
                local[differ, 0] = 0.0
            if b not in self.parent:
                return list(np.cumsum(self.root @ local) * self.n * max(self.n - 1, 0) / 2)
            message, old = self.step[b] @ local, up[self.parent[b]]
            up[self.parent[b]] = np.stack(
                [sum(old[:, i] * message[:, d - i] for i in range(d + 1)) for d in range(most + 1)], axis=1)
        raise AssertionError("a tree has a root")


def allocate_thresholds(costs: list[list[float]], probes: list[list[float]], budget: int) -> list[int]:
    """Thresholds >= -1 that add up to ``budget`` at the least cost (dynamic program).

    The cost of threshold t >= 0 in a group is its estimated candidates plus its probes.
    """
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for cost, probe in zip(costs, probes):
        nxt: dict[int, tuple[float, list[int]]] = {}
        for total, (c, chosen) in best.items():
            for t in range(-1, len(cost)):
                new = c + (cost[t] + probe[t] if t >= 0 else 0.0)
                if total + t not in nxt or new < nxt[total + t][0]:
                    nxt[total + t] = (new, [*chosen, t])
        best = nxt
    return best[budget][1]


def bits_mask(bits: list[int]) -> int:
    return sum(1 << b for b in bits)


def masked(masks: list[int], **more: list[int]) -> Column:
    """One row per mask: its number ``mask``, the fingerprint under it ``key``, and ``more``'s value of it."""
    return F.explode(F.array(*[
        F.struct(F.lit(i).alias("mask"), F.col("fp").bitwiseAND(F.lit(signed(m))).alias("key"),
                 *[F.lit(signed(v[i])).alias(k) for k, v in more.items()]) for i, m in enumerate(masks)]))


def crowded_patterns(fps: DataFrame, groups: list[list[int]]) -> list[int]:
    """For each group of bits, the fingerprints that agree on it with another one (all are counted)."""
    patterns = (fps.select(masked([bits_mask(g) for g in groups]).alias("p")).select("p.mask", "p.key")
                .groupBy("mask", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    found = {r["mask"]: r["n"] for r in patterns.groupBy("mask").agg(F.sum("n").alias("n")).collect()}
    return [found.get(i, 0) for i in range(len(groups))]  # one number per group


def plan_masks(fps: DataFrame, distance: int, parts: int) -> list[int]:
    """Bit masks such that fingerprints within ``distance`` bits agree under one of them."""
    return masks_of(*bit_counts(fps), distance, parts, lambda groups: crowded_patterns(fps, groups))


def masks_of(n: int, both: np.ndarray, distance: int, parts: int,
             measure: Callable[[list[list[int]]], list[int]]) -> list[int]:
    """The masks for ``n`` fingerprints with the pair counts ``both``.

    ``measure`` counts the fingerprints that agree with another one on each group of the first
    partition.  Near copies agree on all groups, so the smallest count is due whatever is
    probed; where the rest exceeds the tree's estimate, the group's estimates are scaled up to
    it, at larger thresholds and at further levels inside the group too.

    Costs are in probed rows: a probe is one, and a fingerprint that becomes a candidate puts
    out a ball of at most 65 keys, once, however many pairs or masks it is in.  The principle
    is applied again to the bits outside a mask (fingerprints that agree under it differ only
    there) while the tree expects the balls of its chance candidates to cost more than the
    probes, and while there are no more than 65 masks in all: more would cost more than all
    balls.  A mask's candidates count at most ``parts`` times its probes: refining it costs that.
    So the number of levels follows from the measured counts, and the work is linear in the
    fingerprints at any of them.
    """
    model, ball = BitModel(n, both), BITS + 1

    def split(held: int, scale: float | None) -> list[tuple[int, float]]:
        free = [b for b in range(BITS) if not held >> b & 1]
        groups = group_bits(n, both, free, parts)
        pairs = [model.pairs(held, g, distance) for g in groups]
        scales = [scale] * parts
        if scale is None:
            seen = measure(groups)
            scales = [max(1.0, (s - min(seen)) / max(2 * tree[0], 1.0)) for s, tree in zip(seen, pairs)]
        probes = [[float(n) * math.comb(len(g), t) for t in range(distance + 1)] for g in groups]
        balls = [[ball * min(float(n), 2 * x * r) for x in tree] for tree, r in zip(pairs, scales)]
        costs = [[min(b, parts * p) for b, p in zip(*group)] for group in zip(balls, probes)]
        thresholds = allocate_thresholds(costs, probes, distance - parts + 1)
        return [(held | bits_mask([b for b in group if b not in left_out]), r)
                for group, t, r in zip(groups, thresholds, scales) if t >= 0
                for left_out in itertools.combinations(group, t)]

    def settled(held: int) -> bool:
        return BITS - held.bit_count() < FEWEST_FREE or ball * 2 * model.pairs(held, [], 0)[0] <= n

    masks, deeper = {}, dict(split(0, None))
    while len(deeper) <= ball:
        masks, deeper = deeper, {}
        for held, scale in masks.items():
            deeper.update([(held, scale)] if settled(held) else split(held, scale))
        if deeper == masks:
            break
    return sorted(masks or deeper)


def signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def links(fps: DataFrame, distance: int = 2, parts: int = 3) -> DataFrame:
    """Chains of links ``a, b`` between distinct fingerprints at most ``distance`` bits apart.

    The transitive closure of the chains is that of all links.  ``fps`` has distinct ``fp``.
    Distances 1 and 2 use balls of radius 1; 0 has no links between distinct fingerprints.
    """
    if distance not in (0, 1, 2):
        raise ValueError("distances 0 to 2 are supported")
    if distance == 0:
        return fps.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where("false")
    masks = plan_masks(fps, distance, parts)
    full = (1 << 64) - 1
    probed = fps.select("fp", masked(masks, free=[full ^ m for m in masks]).alias("p")).select("fp", "p.*")
    crowded = (probed.groupBy("mask", "key").agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
               .where("lo <> hi").select("mask", "key"))
    candidates = (probed.join(crowded, ["mask", "key"], "left_semi")
                  .groupBy("fp").agg(F.bit_or("free").alias("free")))
    bits = F.expr("transform(filter(sequence(0, 63), i -> getbit(free, i) = 1), i -> fp ^ shiftleft(1L, i))")
    ball = candidates.select("fp", F.explode(F.concat(F.array("fp"), bits)).alias("at"))
    if distance == 1:  # a ball of radius 1 reaches the other fingerprint itself
        return (ball.where("fp < at").join(fps.select(F.col("fp").alias("at")), "at", "left_semi")
                .select(F.col("fp").alias("a"), F.col("at").alias("b")))
    before = F.lag("fp").over(Window.partitionBy("at").orderBy("fp"))
    chain = ball.select(before.alias("a"), F.col("fp").alias("b")).where("a is not null")
    return chain.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance).distinct()


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``node, label`` for every node of ``edges`` (a, b); label = smallest node reachable.

    Each round: every node takes the smallest label around it, the node its label names is
    hooked to that label too, and labels are followed one step.  Stops when nothing changes.
    Labels meet in joins whose label side has one row per node, which adaptive execution
    can split, and in minima that are combined before the shuffle.
    """
    both = materialize(edges.union(edges.select("b", "a")).distinct(), "links")
    label = materialize(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"))
                        .select("node", F.least("node", "m").alias("label")), "labels")
    for _ in range(max_rounds):
        near = (both.join(label.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node"))
                .agg(F.min("label").alias("near")))
        seen = label.join(near, "node").select("node", "label", F.least("label", "near").alias("new"))
        hooks = seen.groupBy(F.col("label").alias("root")).agg(F.min("new").alias("hook"))
        hooked = (seen.join(hooks, F.col("label") == F.col("root"))
                  .select("node", "label", F.least("new", "hook").alias("new")))
        follow = hooks.select(F.col("root").alias("via"), F.col("hook").alias("further"))
        new = (hooked.join(follow, F.col("new") == F.col("via"), "left")
               .select("node", F.least("new", F.coalesce("further", "new")).alias("label"),
                       (F.least("new", F.coalesce("further", "new")) != F.col("label")).alias("moved")))
        new = materialize(new, "labels")
        moved = new.where("moved").limit(1).count()
        label = new.drop("moved")
        if not moved:
            return label
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def named_components(rows: DataFrame, distance: int, parts: int) -> DataFrame:
    """``fp, component_id`` for every fingerprint of ``rows`` (id, fp): the smallest ``id`` of its component."""
    reps = materialize(rows.groupBy("fp").agg(F.min("id").alias("least")), "representatives")
    label = components(links(reps.select("fp"), distance, parts))
    labelled = (reps.join(label.withColumnRenamed("node", "fp"), "fp", "left")
                .select("fp", "least", F.coalesce("label", "fp").alias("label")))
    named = labelled.groupBy("label").agg(F.min("least").alias("component_id"))
    return labelled.join(named, "label").select("fp", "component_id")


def near_groups(docs: DataFrame, shingle: int = 3, distance: int = 2, parts: int = 3,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, fp, component_id``.

    ``component_id`` is the smallest identifier reachable over links of at most ``distance``
    differing bits, itself included.  Null and empty texts have fingerprint 0 and are linked
    like any other; rows without an identifier take part but never name a component unless
    it has no identifier at all (then null).  Repeated rows stay repeated.  An empty table
    gives an empty result; other columns are ignored, whatever they are called.
    """
    rows = fingerprints(docs, shingle, id_col, text_col)
    return rows.join(named_components(rows, distance, parts), "fp").select("id", "fp", "component_id")


def drop_near_copies(docs: DataFrame, shingle: int = 3, distance: int = 2, parts: int = 3,
                     id_col: str = "doc_id", text_col: str = "text", unnamed: str = "keep") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns: one of each component.

    The rows are numbered in a written table first, so that repeated identifiers do not
    matter: of each component the row with the smallest identifier stays, and of several
    rows with it the first by number.  A row without an identifier goes if its component
    has a row with one.  ``unnamed`` says what happens to components without any identifier:
    ``"keep"`` leaves all their rows, ``"drop"`` leaves the first of each by number.
    """
    if unnamed not in ("keep", "drop"):
        raise ValueError("unnamed is 'keep' or 'drop'")
    ident = flat_name(docs, id_col)
    numbered = materialize(flatten(docs).withColumn("uid", F.monotonically_increasing_id()), "near-copies")
    order = F.struct(F.col(ident).isNull().alias("unnamed"), F.col(ident).alias("id"), F.col("uid"))
    rows = fingerprints(numbered.select(order.alias("id"), F.col(flat_name(docs, text_col)).alias("text")),
                        shingle, "id", "text")
    first = materialize(named_components(rows, distance, parts), "near-first")
    if unnamed == "drop":
        stay = first.select("component_id.uid").distinct()
    else:
        named = first.where("not component_id.unnamed").select("component_id.uid").distinct()
        stay = named.unionByName(rows.where("id.unnamed").join(
            first.where("component_id.unnamed"), "fp", "left_semi").select("id.uid"))
    return restore(numbered.join(stay, "uid", "left_semi"), docs)
