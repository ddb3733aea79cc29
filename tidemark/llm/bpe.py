"""Byte-level BPE encoding and decoding by corpus-level merge replay.

A task splits its texts with the tokenizer's pattern and gathers the words it has not seen
yet.  Their bytes are laid out as one sequence of positions.  An inverted index maps every
token pair to the positions where it stands, so a pair's rank is looked up once however
often it occurs.  Merges are replayed over all words at once, for every word in rank order
(lowest rank first, then leftmost), and each merge touches only its two neighbours:

* Ordinary words go in waves (numpy): a wave applies the next merge of each word, then only
  the pairs left and right of the merges are indexed and ranked anew.
* Words of more than ``WAVE_BYTES`` bytes are replayed rank by rank: the positions of a rank
  are taken from left to right and new pairs go into the index; a pair that ranks no higher
  than the one being replayed is taken first.  A word of n bytes takes O(n log n).

Encoded words are kept in a store with a bounded number of entries per Python worker; ids
of whole texts and decoded bytes are gathered from it with array operations.  Tokenizers are
not trained: ranks and pattern are parameters.
"""

from __future__ import annotations

import base64
import heapq
import uuid
from collections import defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import flat_name, flatten, take, text_of
from tidemark.session import ship_package

#: Bounds of a worker's memory, none of the results: words and pairs it remembers, and the
#: characters it works on at once.
STORE_WORDS = 200_000
STORE_PAIRS = 300_000
CHUNK_CHARS = 1 << 21
WAVE_BYTES = 256
NO_RANK = np.int64(1) << 31


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a rank file (a base64 token and its rank per line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def ragged(offsets: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices offset, offset + 1, ... of every (offset, length), one after the other."""
    ends = np.cumsum(lengths)
    return np.repeat(offsets - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)


class MergeReplay:
    """Encoder of texts and decoder of ids for one rank table."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, store_words: int = STORE_WORDS):
        self.ranks = ranks
        self.tokens = {r: t for t, r in ranks.items()}
        self.split = regex.compile(pattern).findall
        self.byte_ids = np.array([ranks[bytes([i])] for i in range(256)], np.int64)
        self.size = max(self.tokens) + 1
        self.token_lengths = np.array([len(self.tokens.get(i, b"")) for i in range(self.size)], np.int64)
        self.token_offsets = np.cumsum(self.token_lengths) - self.token_lengths
        self.token_bytes = np.frombuffer(b"".join(self.tokens.get(i, b"") for i in range(self.size)), np.uint8)
        self.made: dict[int, int] = {}
        self.store_words = store_words
        self.clear()

    def clear(self) -> None:
        self.slots: dict[str, int] = {}
        self.ids = np.empty(0, np.int32)
        self.offsets = np.empty(0, np.int64)
        self.lengths = np.empty(0, np.int64)

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The rank of each pair's merge: by an index from distinct pairs to their positions."""
        pairs, places = np.unique(a * self.size + b, return_inverse=True)
        made, ranks, tokens = self.made, self.ranks, self.tokens
        if len(made) > STORE_PAIRS:
            made.clear()
        of = []
        for pair in pairs.tolist():
            if pair not in made:
                made[pair] = ranks.get(tokens[pair // self.size] + tokens[pair % self.size], int(NO_RANK))
            of.append(made[pair])
        return np.array(of, np.int64)[places] if of else np.empty(0, np.int64)

    def replay_waves(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids per word, all ids): one merge of every unfinished word per wave."""
        count = np.array([len(w) for w in words], np.int64)
        out = np.zeros(len(words), np.int64)
        done_ids: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        tok = self.byte_ids[np.frombuffer(b"".join(words), np.uint8)]
        word = np.arange(len(words))
        start = np.cumsum(count) - count
        rank = np.full(len(tok), NO_RANK)
        inner = np.ones(len(tok), bool)
        inner[start + count - 1] = False
        at = np.flatnonzero(inner)
        rank[at] = self.pair_ranks(tok[at], tok[at + 1])
        while len(word):
            best = np.minimum.reduceat((rank << np.int64(31)) | np.arange(len(tok)), start)
            live = (best >> np.int64(31)) < NO_RANK
            if not live.all():
                ended = ~live
                n = count[ended]
                out[word[ended]] = n
                done_ids.append((word[ended], n, tok[ragged(start[ended], n)]))
                keep = ragged(start[live], count[live])
                back = np.full(len(tok), -1)
                back[keep] = np.arange(len(keep))
                tok, rank = tok[keep], rank[keep]
                best, word, count = best[live], word[live], count[live]
                start = np.cumsum(count) - count
                if not len(word):
                    break
                i = back[best & np.int64((1 << 31) - 1)]
            else:
                i = best & np.int64((1 << 31) - 1)
            tok[i] = rank[i]
            keep = np.ones(len(tok), bool)
            keep[i + 1] = False
            tok, rank = tok[keep], rank[keep]
            i = i - np.arange(len(word))
            count = count - 1
            start = np.cumsum(count) - count
            right = i + 1 < start + count
            rank[i] = NO_RANK
            left = i > start
            at = np.concatenate((i[right], i[left] - 1))
            rank[at] = self.pair_ranks(tok[at], tok[at + 1])
        offsets = np.cumsum(out) - out
        ids = np.empty(int(out.sum()), np.int32)
        for w, n, t in done_ids:
            ids[ragged(offsets[w], n)] = t
        return out, ids

    def replay_ranks(self, data: bytes) -> list[int]:
        """The ids of one long word, rank by rank."""
        ranks, tokens = self.ranks, self.tokens
        n = len(data)
        tok = [ranks[data[i:i + 1]] for i in range(n)]  # -1 once merged into an earlier one
        nxt = [*range(1, n), -1]
        prv = [*range(-1, n - 1)]

        def rank(a: int, b: int) -> int | None:
            return ranks.get(tokens[tok[a]] + tokens[tok[b]])

        index: dict[int, list[int]] = defaultdict(list)
        for i in range(n - 1):
            r = rank(i, i + 1)
            if r is not None:
                index[r].append(i)
        due = list(index)
        heapq.heapify(due)
        while due:
            r = heapq.heappop(due)
            places = sorted(index.pop(r, ()))
            for done, i in enumerate(places):
                j = nxt[i] if tok[i] >= 0 else -1
                if j < 0 or rank(i, j) != r:
                    continue
                after = nxt[j]
                tok[i], tok[j], nxt[i] = r, -1, after
                if after >= 0:
                    prv[after] = i
                sooner = False
                for a, b in ((prv[i], i), (i, after)):
                    new = rank(a, b) if a >= 0 and b >= 0 else None
                    if new is not None:
                        if new not in index:
                            heapq.heappush(due, new)
                        index[new].append(a)
                        sooner |= new <= r
                if sooner:
                    if r not in index:
                        heapq.heappush(due, r)
                    index[r].extend(places[done + 1:])
                    break
        return [t for t in tok if t >= 0]

    def replay(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids per word, all ids)."""
        data = [w.encode("utf-8") for w in words]
        lengths = np.ones(len(data), np.int64)
        whole = np.array([self.ranks.get(w, -1) for w in data], np.int64)
        short = [k for k, w in enumerate(data) if whole[k] < 0 and len(w) <= WAVE_BYTES]
        long = {k: np.array(self.replay_ranks(w), np.int32)
                for k, w in enumerate(data) if whole[k] < 0 and len(w) > WAVE_BYTES}
        n, waves = self.replay_waves([data[k] for k in short]) if short else (np.empty(0, np.int64), None)
        lengths[short] = n
        for k, ids in long.items():
            lengths[k] = len(ids)
        offsets = np.cumsum(lengths) - lengths
        out = np.empty(int(lengths.sum()), np.int32)
        known = np.flatnonzero(whole >= 0)
        out[offsets[known]] = whole[known]
        if short:
            out[ragged(offsets[short], n)] = waves
        for k, ids in long.items():
            out[offsets[k]:offsets[k] + len(ids)] = ids
        return lengths, out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(end of each text in the ids, ids of all texts); all new words are replayed at once."""
        split = [self.split(t) for t in texts]
        new = [w for w in dict.fromkeys(chain.from_iterable(split)) if w not in self.slots]
        if len(self.slots) + len(new) > self.store_words:
            self.clear()
            new = list(dict.fromkeys(chain.from_iterable(split)))
        lengths, ids = self.replay(new)
        self.slots.update(zip(new, range(len(self.slots), len(self.slots) + len(new))))
        self.offsets = np.concatenate((self.offsets, len(self.ids) + np.cumsum(lengths) - lengths))
        self.lengths = np.concatenate((self.lengths, lengths))
        self.ids = np.concatenate((self.ids, ids))
        words = np.array([len(s) for s in split], np.int64)
        at = np.fromiter(map(self.slots.__getitem__, chain.from_iterable(split)), np.int64, int(words.sum()))
        lengths = self.lengths[at]
        ends = np.concatenate(([0], np.cumsum(lengths)))[np.cumsum(words)]
        ids = self.ids[ragged(self.offsets[at], lengths)]
        if len(self.slots) > self.store_words or len(self.ids) > 32 * self.store_words:
            self.clear()  # one batch, or one very long word, can be larger than the store
        return ends, ids

    def decode(self, ends: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(end of each text in the bytes, bytes of all texts)."""
        lengths = self.token_lengths[ids]
        at = np.concatenate(([0], np.cumsum(lengths)))[ends]
        return at, self.token_bytes[ragged(self.token_offsets[ids], lengths)]


_REPLAYS: dict[int, MergeReplay] = {}


def replay_of(shared) -> MergeReplay:
    """The worker's replay for a broadcast (ranks, pattern); its cache outlives a task."""
    if shared.id not in _REPLAYS:
        _REPLAYS.clear()
        _REPLAYS[shared.id] = MergeReplay(*shared.value)
    return _REPLAYS[shared.id]


class _Keyed:
    """A broadcast with its number, which survives pickling."""

    def __init__(self, broadcast, number: int):
        self.broadcast, self.id = broadcast, number

    @property
    def value(self):
        return self.broadcast.value


def share(df: DataFrame, ranks: dict[bytes, int], pattern: str) -> _Keyed:
    """Ranks and pattern for the tasks; a vocabulary has a fixed size."""
    ship_package(df.sparkSession)
    return _Keyed(df.sparkSession.sparkContext.broadcast((ranks, pattern)), uuid.uuid4().int)


def chunks(batch: pa.RecordBatch, column: int) -> Iterator[tuple[int, list[str]]]:
    """Row ranges (first row, texts) of at most CHUNK_CHARS characters, or one text."""
    first, texts, size = 0, [], 0
    for i, t in enumerate(batch.column(column)):
        t = t.as_py()
        if texts and size + len(t) > CHUNK_CHARS:
            yield first, texts
            first, texts, size = i, [], 0
        texts.append(t)
        size += len(t)
    if texts:
        yield first, texts


def encode_documents(docs: DataFrame, ranks: dict[bytes, int], pattern: str, decoded: bool = False,
                     keep: tuple[str, ...] = (), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id``, the columns to ``keep``, ``ids`` (array of token ids),
    with ``decoded`` also the ``bytes`` that the ids decode to.

    Null and empty texts have no ids and decode to no bytes.  Identifiers are passed through
    (null and repeated ones too); an empty table gives an empty result; other columns are
    ignored, whatever they are called.
    """
    shared = share(docs, ranks, pattern)
    names = [f"keep{i}" for i in range(len(keep))]
    rows = take(docs, text=text_col, id=id_col, **dict(zip(names, keep))).select(
        text_of("text").alias("text"), "id", *names)
    extra = [F.lit(None).cast("binary").alias("bytes")] if decoded else []
    schema = rows.select("id", *names, F.array().cast("array<int>").alias("ids"), *extra).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = replay_of(shared)
        for batch in batches:
            for first, texts in chunks(batch, 0):
                ends, ids = replay.encode(texts)
                out = [*[c.slice(first, len(texts)) for c in batch.columns[1:]],
                       pa.ListArray.from_arrays(offsets_of(ends), pa.array(ids, pa.int32()))]
                if decoded:
                    out.append(binary(*replay.decode(ends, ids)))
                yield pa.RecordBatch.from_arrays(out, names=schema.names)

    out = rows.mapInArrow(run, schema)
    return out.toDF("id", *keep, *out.columns[1 + len(keep):])


def offsets_of(ends: np.ndarray) -> pa.Array:
    return pa.array(np.concatenate(([0], ends)).astype(np.int32))


def binary(ends: np.ndarray, data: np.ndarray) -> pa.Array:
    """A binary array from the end of each value and the bytes of all."""
    return pa.Array.from_buffers(pa.binary(), len(ends),
                                 [None, offsets_of(ends).buffers()[1], pa.py_buffer(data.tobytes())])


def decode_documents(encoded: DataFrame, ranks: dict[bytes, int], pattern: str,
                     ids_col: str = "ids") -> DataFrame:
    """``encoded`` with the column ``ids_col`` replaced by the decoded bytes (null stays null)."""
    shared = share(encoded, ranks, pattern)
    flat = flatten(encoded)
    at = int(flat_name(encoded, ids_col)[2:])
    schema = flat.withColumn(f"_c{at}", F.lit(None).cast("binary")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = replay_of(shared)
        for batch in batches:
            ids = batch.column(at)
            lengths = np.array([0 if v is None else v for v in pc.list_value_length(ids).to_pylist()], np.int64)
            flat_ids = ids.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            done = binary(*replay.decode(np.cumsum(lengths), flat_ids))
            done = pc.if_else(ids.is_valid(), done, pa.scalar(None, pa.binary()))
            columns = [done if i == at else c for i, c in enumerate(batch.columns)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return flat.mapInArrow(run, schema).toDF(*encoded.columns)


def ids_text(ids: str):
    """Decimal ids joined by one space."""
    return F.array_join(F.col(ids).cast("array<string>"), " ")
