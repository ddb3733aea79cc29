"""Benchmark decontamination: size-partitioned MinHash containment search.

Items of more than 4 shingles are grouped by size into classes of shingle counts up to 8,
16, 32, ...  For a class of size u, every document is covered by windows of 2u shingles, one every u shingles, so an
item's passage lies whole in a window: the search compares sets of like size, however long
the document is.  An item with q shingles, u/2 < q <= u, that a window holds at containment
c has Jaccard similarity of at least c q / (2u + (1 - c) q) with it, at least 0.19 for
c = 0.8.  With one row per band, ``permutations`` = 128 independent minima miss such a
window with probability below (1 - 0.19) ** 128 = 2e-12.  Minima of windows are built from
minima of 4-shingle cells shared by all classes.

Items of 1 to 4 shingles are too few beside a window's for that bound: a document that holds
any of their shingle hashes is a candidate directly, so none is missed.

A window that holds no shingle of any item has no minimum in common with one either, so
signatures are only made for the stretches around shingles whose hash is that of an
item's shingle (a bit table is asked first); this changes no result.

Candidates are verified: the exact share of the item's shingles, compared as text, in the
whole document.

The benchmark is the query set.  It is handled in blocks of at most ``block_items`` items;
each block is searched in one pass over the documents, without any shuffle.  Items are the
only data that the driver or a broadcast holds, a block at a time.
"""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import flat_name, flatten, materialize, restore, take, text_of
from tidemark.session import ship_package

WORD = re.compile(r"[^\W_]+")
CELL = 4
SMALLEST = 8
FILTER_BITS = 22
CELLS_AT_ONCE = 1 << 22


def words_of(text: str) -> list[str]:
    """Runs of letters and digits, lower-cased."""
    return WORD.findall(text.lower())


def permutation_keys(permutations: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the permutations h -> a h + b mod 2^64, then the high half."""
    rng = np.random.default_rng(20240601)
    a = rng.integers(0, 1 << 63, permutations, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, permutations, dtype=np.uint64)


class Hasher:
    """64-bit shingle hashes from cached word hashes."""

    def __init__(self, cache_words: int = 200_000):
        self.cache: dict[str, int] = {}
        self.cache_words = cache_words

    def words(self, words: list[str]) -> np.ndarray:
        cache = self.cache
        missing = set(words).difference(cache)
        if len(cache) + len(missing) > self.cache_words:
            cache.clear()
            missing = set(words)
        cache.update((w, xxhash.xxh64_intdigest(w)) for w in missing)
        return np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))

    def shingles(self, word_hashes: np.ndarray, n: int) -> np.ndarray:
        """Hash of every n-word shingle; fewer words than n have none."""
        count = len(word_hashes) - n + 1
        if count <= 0:
            return np.empty(0, np.uint64)
        out = np.zeros(count, np.uint64)
        for i in range(n):
            out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + word_hashes[i:i + count]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0xD6E8FEB86659FD93)
        return out ^ (out >> np.uint64(32))


class ItemIndex:
    """The items of a block: by shingle length, minima of each size class, hashes of short items."""

    def __init__(self, items: list[tuple[object, str]], shingle: int, threshold: float, permutations: int):
        self.threshold = threshold
        self.a, self.b = permutation_keys(permutations)
        hasher = Hasher()
        self.items: list[tuple[object, int, frozenset[str]]] = []
        grouped: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        self.known: dict[int, np.ndarray] = {}
        exact: dict[int, list[np.ndarray]] = {}
        short: dict[int, list[tuple[int, np.ndarray]]] = {}
        for ident, text in items:
            words = words_of(text)
            if not words:
                continue
            n = min(shingle, len(words))
            shingles = frozenset(" ".join(words[i:i + n]) for i in range(len(words) - n + 1))
            size = SMALLEST
            while size < len(shingles):
                size *= 2
            hashes = hasher.shingles(hasher.words(words), n)
            if n not in self.known:
                self.known[n] = np.zeros(1 << FILTER_BITS, bool)
            self.known[n][hashes >> np.uint64(64 - FILTER_BITS)] = True
            if 2 * len(shingles) <= SMALLEST:
                short.setdefault(n, []).append((len(self.items), hashes))
            else:
                grouped.setdefault((n, size), []).append((len(self.items), self.permuted(hashes).min(axis=1)))
                exact.setdefault(n, []).append(hashes)
            self.items.append((ident, n, shingles))
        self.exact = {n: np.unique(np.concatenate(h)) for n, h in exact.items()}
        #: by shingle length: size class, sorted (permutation, minimum) keys and their items
        self.classes: dict[int, list[tuple[int, np.ndarray, np.ndarray]]] = {n: [] for n in self.known}
        for (n, size), members in sorted(grouped.items()):
            keys = np.concatenate([m | self.row(0, len(self.a))[:, 0] for _, m in members])
            owner = np.repeat([k for k, _ in members], len(self.a))
            order = np.argsort(keys, kind="stable")
            self.classes[n].append((size, keys[order], owner[order]))
        #: by shingle length: sorted shingle hashes of the items of at most 4 shingles, and their items
        self.short: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for n, members in short.items():
            keys = np.concatenate([h for _, h in members])
            owner = np.repeat([k for k, _ in members], [len(h) for _, h in members])
            order = np.argsort(keys, kind="stable")
            self.short[n] = keys[order], owner[order]

    def row(self, first: int, last: int) -> np.ndarray:
        """The number of each permutation, in the high half of a key."""
        return np.arange(first, last, dtype=np.uint64)[:, None] << np.uint64(32)

    def permuted(self, hashes: np.ndarray, first: int = 0, last: int | None = None) -> np.ndarray:
        """32-bit values (as 64-bit) of the hashes under permutations first to last."""
        a, b = self.a[first:last, None], self.b[first:last, None]
        return (hashes * a + b) >> np.uint64(32)

    def possible(self, hashes: np.ndarray, n: int) -> np.ndarray:
        """Positions of the shingles that the bit table does not rule out."""
        return np.flatnonzero(self.known[n][hashes >> np.uint64(64 - FILTER_BITS)])

    def stretches(self, hashes: np.ndarray, at: np.ndarray, n: int) -> Iterator[np.ndarray]:
        """The runs of shingles that reach twice the largest class around a known one, of those ``at``."""
        if n not in self.exact:
            return
        hits = at[self.exact[n][np.minimum(np.searchsorted(self.exact[n], hashes[at]), len(self.exact[n]) - 1)]
                  == hashes[at]]
        if not len(hits):
            return
        reach = 2 * self.classes[n][-1][0]
        breaks = np.flatnonzero(np.diff(hits) > 2 * reach) + 1
        for run in np.split(hits, breaks):
            yield hashes[max(0, run[0] - reach):run[-1] + reach + 1]

    def held(self, hashes: np.ndarray, n: int) -> set[int]:
        """The short items that have one of the hashes."""
        if n not in self.short:
            return set()
        keys, owners = self.short[n]
        hashes = np.unique(hashes)
        lo, hi = np.searchsorted(keys, hashes), np.searchsorted(keys, hashes, "right")
        return {k for i in np.flatnonzero(hi > lo) for k in owners[lo[i]:hi[i]].tolist()}

    def candidates(self, word_hashes: np.ndarray, hasher: Hasher) -> set[int]:
        """Short items with a shingle in the document, others with a minimum in common with a window of it."""
        found: set[int] = set()
        for n, classes in self.classes.items():
            hashes = hasher.shingles(word_hashes, n)
            at = self.possible(hashes, n)
            found |= self.held(hashes[at], n)
            for part in self.stretches(hashes, at, n):
                step = max(1, CELLS_AT_ONCE // len(part))
                for first in range(0, len(self.a), step):
                    last = min(first + step, len(self.a))
                    self.probe(self.permuted(part, first, last), self.row(first, last), classes, found)
        return found

    def probe(self, values: np.ndarray, row: np.ndarray, classes: list, found: set[int]) -> None:
        low = np.minimum.reduceat(values, np.arange(0, values.shape[1], CELL), axis=1)
        width = CELL  # ``low`` has the minima of each ``width`` shingles
        for size, keys, owners in classes:
            while width < size:
                if low.shape[1] % 2:
                    low = np.concatenate((low, low[:, -1:]), axis=1)
                low = np.minimum(low[:, 0::2], low[:, 1::2])
                width *= 2
            window = np.minimum(low[:, :-1], low[:, 1:]) if low.shape[1] > 1 else low
            key = (window | row).ravel()
            at = np.searchsorted(keys, key)
            at[at == len(keys)] = 0
            hit = np.unique(key[keys[at] == key])
            for lo, hi in zip(np.searchsorted(keys, hit), np.searchsorted(keys, hit, "right")):
                found.update(owners[lo:hi].tolist())

    def matches(self, text: str, hasher: Hasher) -> Iterator[tuple[object, int, float]]:
        """(item, shared shingles, containment) of the items that the text holds."""
        words = words_of(text)
        by_length: dict[int, set[str]] = {}
        for k in sorted(self.candidates(hasher.words(words), hasher)):
            ident, n, shingles = self.items[k]
            if n not in by_length:
                by_length[n] = set(map(" ".join, zip(*[words[i:] for i in range(n)])))
            shared = len(shingles & by_length[n])
            if shared >= math.ceil(self.threshold * len(shingles) - 1e-9):
                yield ident, shared, shared / len(shingles)


def blocks(items: DataFrame, block_items: int, block_bytes: int) -> Iterator[list[tuple[object, str]]]:
    """The items in blocks, one at a time on the driver: at most ``block_items`` items and,
    unless one item is longer, ``block_bytes`` characters of text."""
    block: list[tuple[object, str]] = []
    size = 0
    for row in items.toLocalIterator():
        if block and (len(block) == block_items or size + len(row["text"]) > block_bytes):
            yield block
            block, size = [], 0
        block.append((row["id"], row["text"]))
        size += len(row["text"])
    if block:
        yield block


def contained_items(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8,
                    permutations: int = 128, block_items: int = 20_000, block_bytes: int = 16 << 20,
                    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row per document row and item it holds: ``id, item_id, shared, containment``.

    A document holds an item if at least ``threshold`` of the item's distinct ``shingle``-word
    shingles occur in it (words: runs of letters and digits, lower-cased; an item with fewer
    words is one shingle of all its words).  Items without a word, null texts included, are in
    no document.  Repeated rows and items are reported each for themselves; identifiers may be
    null.  Without items or documents the result is empty.  Other columns are ignored.

    Items reach the tasks in blocks of bounded size; with more than one block, the hits of a
    block are written before the next one is read, and its broadcast is given back.
    """
    ship_package(docs.sparkSession)
    rows = take(docs, id=id_col, text=text_col).select("id", text_of("text").alias("text"))
    queries = take(items, id=item_col, text=item_text_col).select("id", text_of("text").alias("text"))
    schema = (rows.select("id").join(queries.select(F.col("id").alias("item_id")))
              .select("id", "item_id", F.lit(0).cast("long").alias("shared"), F.lit(0.0).alias("containment")).schema)
    types = [pa_type(rows, "id"), pa_type(queries, "id"), pa.int64(), pa.float64()]
    found, pending = [], None
    for block in blocks(queries, block_items, block_bytes):
        if pending is not None:
            found.append(settle(*pending))
        key = uuid.uuid4().hex
        shared = docs.sparkSession.sparkContext.broadcast((block, shingle, threshold, permutations))

        def run(batches: Iterator[pa.RecordBatch], key=key, shared=shared) -> Iterator[pa.RecordBatch]:
            index, hasher = _index(key, shared)
            for batch in batches:
                out = []
                ids = batch.column(0)
                for i, t in enumerate(batch.column(1)):
                    out += [(ids[i].as_py(), *m) for m in index.matches(t.as_py(), hasher)]
                columns = list(zip(*out)) if out else [(), (), (), ()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types)], names=schema.names)

        pending = rows.mapInArrow(run, schema), shared
    if pending is None:
        return docs.sparkSession.createDataFrame([], schema)
    if found:
        return reduce(DataFrame.unionAll, [*found, settle(*pending)])
    return pending[0]


def settle(hits: DataFrame, shared) -> DataFrame:
    """The hits of one block from a written table; the block is forgotten."""
    out = materialize(hits, "block-hits")
    shared.destroy()
    return out


def pa_type(df: DataFrame, col: str) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(df.schema[col].dataType)


_INDEX: dict[str, tuple[ItemIndex, Hasher]] = {}


def _index(key: str, shared) -> tuple[ItemIndex, Hasher]:
    if key not in _INDEX:
        _INDEX.clear()
        _INDEX[key] = (ItemIndex(*shared.value), Hasher())
    return _INDEX[key]


def drop_contaminated(docs: DataFrame, items: DataFrame, shingle: int = 5, threshold: float = 0.8,
                      id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                      item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no item, with all their columns.

    The rows are numbered in a written table first, so that null and repeated identifiers do
    not matter: a row goes if and only if its own text holds an item.
    """
    numbered = materialize(flatten(docs).withColumn("uid", F.monotonically_increasing_id()), "decontaminate")
    hits = contained_items(numbered, items, shingle, threshold, id_col="uid",
                           text_col=flat_name(docs, text_col), item_col=item_col, item_text_col=item_text_col)
    return restore(numbered.join(hits.select(F.col("id").alias("uid")).distinct(), "uid", "left_anti"), docs)
