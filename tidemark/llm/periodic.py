"""Periodic run detection: maximal pairs of a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q, at least ``least`` words and ``powers``
periods long, that no neighbouring word extends.  It is the same thing as a maximal pair:
two equal substrings at distance q, ``l`` words long, with different words before them and
behind them.  The run then starts at the first of the two and is ``l + q`` words long, so
its length bounds become bounds on the distance: q <= l / (powers - 1), q + l >= least.

1. Documents are dealt into batches of about ``BATCH_WORDS`` words; a word's number is that
   of (document, word), so nothing matches across documents.
2. Suffixes are sorted by prefix doubling in numpy.  Only positions that share their prefix
   with another one are sorted on; after two rounds that is a small part of ordinary text.
3. The LCP of neighbouring suffixes comes from the ranks of the rounds, largest first.
4. A stack over the LCPs visits the intervals bottom up.  An interval keeps its positions
   in order, also listed by their left word.  Where two children meet at depth ``l``, each
   position of the smaller one looks up the larger one's positions within the allowed
   distance and under another left word: a pair found is maximal as it stands, nothing is
   extended or compared.
5. A stretch with period q also has the periods 2q, 3q, ...; of runs with the same ends the
   one with the smallest period is the run.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import take
from tidemark.session import ship_package

BATCH_WORDS = 1 << 18
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Interval:
    """Positions of an LCP interval: in order, and in order by the word to their left."""

    __slots__ = ("places", "by_left")

    def __init__(self, place: int, left: int):
        self.places = [place]
        self.by_left = {left: [place]}

    def absorb(self, other: Interval) -> None:
        for left, places in other.by_left.items():
            mine = self.by_left.setdefault(left, [])
            for p in places:
                insort(mine, p)
                insort(self.places, p)

    def near(self, place: int, left: int, reach: int, lefts: np.ndarray) -> Iterator[int]:
        """Positions at most ``reach`` away whose left word is another than ``left``."""
        lo, hi = bisect_left(self.places, place - reach), bisect_right(self.places, place + reach)
        if hi - lo <= len(self.by_left):
            for p in self.places[lo:hi]:
                if lefts[p] != left:
                    yield p
            return
        for other, places in self.by_left.items():
            if other != left:
                yield from places[bisect_left(places, place - reach):bisect_right(places, place + reach)]


def maximal_pairs(places: list[int], lcps: list[int], lefts: list[int], powers: int,
                  least: int) -> Iterator[tuple[int, int, int]]:
    """(first place, distance, length) of the maximal pairs within the length bounds.

    ``places`` are suffixes in sorted order, ``lcps[i]`` is the LCP of suffixes i and i + 1,
    and ``lefts`` the left words of all places (by place).
    """
    stack: list[tuple[int, Interval]] = []
    for at, place in enumerate(places):
        node = Interval(place, lefts[place])
        ahead = lcps[at] if at < len(lcps) else 0
        while stack and stack[-1][0] >= ahead:
            depth, other = stack.pop()
            small, large = (node, other) if len(node.places) <= len(other.places) else (other, node)
            reach = depth // (powers - 1)
            for left, group in small.by_left.items():
                for p in group:
                    for q in large.near(p, left, reach, lefts):
                        if abs(p - q) + depth >= least:
                            yield min(p, q), abs(p - q), depth
            large.absorb(small)
            node = large
        if ahead:
            stack.append((ahead, node))


def sorted_suffixes(words: np.ndarray, ends: np.ndarray, shared: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes that share at least ``shared`` words with another one, sorted, and the LCPs
    of neighbours (0 where fewer than ``shared`` words agree).

    ``words`` holds numbers that no two documents share, ``ends[i]`` is the end of the
    document of position i.
    """
    n = len(words)
    order = np.argsort(words, kind="stable")
    fresh = np.r_[True, words[order][1:] != words[order][:-1]]
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    levels, width = [], 1
    live = np.arange(n)
    settled = np.empty(0, np.int64)  # ranked alone by now, but sharing ``shared`` words with another place

    def crowded(places: np.ndarray) -> np.ndarray:
        """Of places in ascending order those whose rank another one has too."""
        _, inverse, count = np.unique(rank[places], return_inverse=True, return_counts=True)
        return places[count[inverse] > 1]

    while True:
        rest = crowded(live)
        if width > shared:
            settled = np.r_[settled, np.setdiff1d(live, rest, assume_unique=True)]
        live = rest
        levels.append((width, live, rank[live].copy()))
        if not len(live):
            break
        after = live + width
        inside = after < ends[live]
        nxt = np.where(inside, rank[np.minimum(after, n - 1)], -1)
        by = np.lexsort((nxt, rank[live]))
        a, b = rank[live][by], nxt[by]
        new_class = np.r_[True, a[1:] != a[:-1]]
        new_part = new_class | np.r_[True, b[1:] != b[:-1]]
        at = np.arange(len(by))
        start = np.maximum.accumulate(np.where(new_class, at, 0))
        part = np.maximum.accumulate(np.where(new_part, at, 0))
        rank[live[by]] = a + part - start
        width *= 2
    settled.sort()
    suffixes = settled[np.argsort(rank[settled], kind="stable")]
    one, two = suffixes[:-1], suffixes[1:]
    lcp = np.zeros(len(one), np.int64)
    for width, places, ranks in reversed(levels):
        if not len(places):
            continue
        x, y = one + lcp, two + lcp
        i, j = (np.minimum(np.searchsorted(places, z), len(places) - 1) for z in (x, y))
        lcp += width * ((places[i] == x) & (places[j] == y) & (ranks[i] == ranks[j]))
    lcp[lcp < shared] = 0
    return suffixes, lcp


def batch_runs(docs: list[list[bytes]], powers: int, least: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each document, by start, then period."""
    sizes = np.array([len(d) for d in docs], np.int64)
    out: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    if not sizes.sum():
        return out
    vocabulary: dict[bytes, int] = {}
    word = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for d in docs for w in d), np.int64, sizes.sum())
    doc = np.repeat(np.arange(len(docs)), sizes)
    start = np.cumsum(sizes) - sizes
    # the shortest shared stretch of a run: distance 1 or the first that meets both bounds
    shared = min(max(least - q, q * (powers - 1)) for q in range(1, least + 1))
    suffixes, lcp = sorted_suffixes(doc * len(vocabulary) + word, (start + sizes)[doc], shared)
    left = np.r_[-1, word[:-1]]
    left[start[sizes > 0]] = -1
    lefts = left.tolist()
    cuts = np.flatnonzero(np.r_[lcp, 0] == 0) + 1
    best: dict[tuple[int, int], int] = {}
    for lo, hi in zip(np.r_[0, cuts[:-1]], cuts):
        if hi - lo > 1:
            for first, gap, length in maximal_pairs(suffixes[lo:hi].tolist(), lcp[lo:hi - 1].tolist(), lefts,
                                                    powers, least):
                ends = (first, first + length + gap)
                best[ends] = min(gap, best.get(ends, gap))
    for (first, end), period in sorted(best.items(), key=lambda r: (r[0][0], r[1])):
        d = int(doc[first])
        out[d].append((first - int(start[d]), end - first, period))
    return out


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words, joined by one space, without those behind the first period of a run."""
    if not runs:
        return b" ".join(words)
    edge = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        edge[start + period] += 1
        edge[start + length] -= 1
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(edge[:-1]) == 0)])


def periodic_runs(docs: DataFrame, powers: int = 4, least: int = 6, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, n_words, runs, collapsed``.

    ``runs`` is an array of (start, length, period), word numbers from 0, ordered by start,
    then period; ``collapsed`` the text's words joined by one space without those that a
    run repeats.  Words are split at ASCII white space and compared as they are.  Null and
    empty texts have no words, no runs and an empty collapsed text.  Identifiers may be null
    or repeated, repeated rows stay repeated; other columns are ignored; an empty table
    gives an empty result.  A document is worked on whole, however long it is.
    """
    if powers < 2 or least < 1:
        raise ValueError("powers of at least 2 and a least length of at least 1 are needed")
    ship_package(docs.sparkSession)
    rows = take(docs, id=id_col, text=text_col)
    schema = rows.select("id", F.lit(0).cast("long").alias("n_words"), F.lit(None).cast(RUNS).alias("runs"),
                         F.lit("").alias("collapsed")).schema
    kind = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                words, total, first = [], 0, at
                while at < batch.num_rows and total < BATCH_WORDS:
                    words.append((batch.column(1)[at].as_py() or "").encode("utf-8", "surrogatepass").split())
                    total += len(words[-1])
                    at += 1
                runs = batch_runs(words, powers, least)
                cut = [collapse(w, r) for w, r in zip(words, runs)]
                starts, lengths, periods = ([r[k] for rs in runs for r in rs] for k in range(3))
                items = pa.StructArray.from_arrays([pa.array(x, pa.int64()) for x in (starts, lengths, periods)],
                                                   fields=list(kind.value_type))
                offsets = pa.array(np.r_[0, np.cumsum([len(r) for r in runs])].astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, at - first), pa.array([len(w) for w in words], pa.int64()),
                     pa.ListArray.from_arrays(offsets, items, type=kind),
                     pa.array(cut, pa.binary()).cast(pa.string())], names=["id", "n_words", "runs", "collapsed"])

    return rows.mapInArrow(run, schema)
