"""Target-distribution importance resampling: rows drawn by hashed n-gram weights.

Features are all runs of one and two consecutive words; a feature's bucket is its CRC-32
modulo the number of buckets.  The gain of a bucket is a smoothed log ratio of its share in
the target texts and in all documents, and a document's weight the mean gain of its
features.  Gumbel noise from a hash of the identifier makes "the k largest scores" a draw
without replacement in proportion to the weights.

1. One Arrow pass counts the buckets of all documents: numpy arrays, one partial count per
   task, summed by Spark.  Another one does so for the target texts.
2. A second pass scores every document with the array of gains (one number per bucket) and
   writes ``uid, id, n_words, n_features, weight, score`` to the shared folder.
3. The cutoff of the k largest scores is bisected: each step is an exact count over the
   written table.  Rows tied at the cutoff score are bisected by identifier, rows tied in
   both by row number.  Nothing is sorted for it and only counts reach the driver.
4. The drawn rows are range partitioned by (score, identifier, row number); a rank is the
   place in its partition plus the rows of the partitions before.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import materialize, shuffle_partitions, take, text_of
from tidemark.session import ship_package

BUCKETS = 10_000
PIECE = 1 << 20
#: Words up to this length are hashed a byte of all words at a time, longer ones by zlib.
LONG = 48
#: Other bytes than digits, letters and those of non-ASCII characters separate words.
FOLD = bytes(b if b >= 128 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32
             for b in range(256))
CRC = np.array([zlib.crc32(bytes([b])) ^ zlib.crc32(b"\0") for b in range(256)], np.uint32)
ONES = np.uint32(0xFFFFFFFF)


def crc_over(state: np.ndarray, text: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """CRC registers after another ``size`` bytes of ``text`` from ``start`` each."""
    state = state.copy()
    live = np.arange(len(state))
    step = 0
    while True:
        live = live[size[live] > step]
        if not len(live):
            return state
        s = state[live]
        state[live] = CRC[(s ^ text[start[live] + step]) & 255] ^ (s >> np.uint32(8))
        step += 1


def pieces(text: str) -> Iterator[tuple[bytes, bool]]:
    """Folded text in pieces cut at separators; with True, a piece opens with the word before it."""
    raw = text.encode("utf-8", "surrogatepass").translate(FOLD)
    at, last = 0, b""
    while at < len(raw):
        end = raw.rfind(b" ", at, at + PIECE) if len(raw) - at > PIECE else len(raw)
        if end < 0:
            end = raw.find(b" ", at)
            end = len(raw) if end < 0 else end
        part = raw[at:end]
        yield (last + b" " + part if last else part), bool(last)
        last = (part.rsplit(None, 1) or [last])[-1]
        at = end + 1


def hashes(parts: list[bytes], follows: list[bool]) -> tuple[np.ndarray, ...]:
    """Part and CRC-32 of each word, then part and CRC-32 of each pair of neighbours.

    The first word of a part that follows another one only opens its first pair.
    """
    raw = b" ".join(parts)
    text = np.frombuffer(raw, np.uint8)
    inside = np.r_[False, text != 32, False]
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    start, size = edges[::2], edges[1::2] - edges[::2]
    begin = np.cumsum([0, *(len(p) + 1 for p in parts[:-1])])
    part = np.searchsorted(begin, start, side="right") - 1
    short = np.where(size <= LONG, size, 0)
    register = crc_over(np.full(len(start), ONES), text, start, short)
    gap = CRC[(register[:-1] ^ np.uint32(32)) & 255] ^ (register[:-1] >> np.uint32(8))
    one, two = register ^ ONES, crc_over(gap, text, start[1:], short[1:]) ^ ONES
    for i in np.flatnonzero(size > LONG).tolist():
        word = raw[start[i]:start[i] + size[i]]
        one[i] = zlib.crc32(word)
        if i:
            two[i - 1] = zlib.crc32(b" " + word, int(one[i - 1]))
        if i + 1 < len(start):
            two[i] = zlib.crc32(b" " + raw[start[i + 1]:start[i + 1] + size[i + 1]], int(one[i]))
    opens = np.r_[True, part[1:] != part[:-1]] if len(part) else np.empty(0, bool)
    counted = ~(opens & np.array(follows, bool)[part])
    same = ~opens[1:]
    return part[counted], one[counted], part[:-1][same], two[same]


def features(texts: Iterator[str]) -> Iterator[tuple[np.ndarray, ...]]:
    """Text number and hash of every word, and of every pair, in chunks of about ``PIECE`` bytes."""
    parts: list[bytes] = []
    follows: list[bool] = []
    owner: list[int] = []
    total = 0

    def flush() -> tuple[np.ndarray, ...]:
        own = np.array(owner)
        word, one, pair, two = hashes(parts, follows)
        return own[word], one, own[pair], two

    for i, text in enumerate(texts):
        for part, after in pieces(text):
            parts.append(part)
            follows.append(after)
            owner.append(i)
            total += len(part)
            if total >= PIECE:
                yield flush()
                parts, follows, owner, total = [], [], [], 0
    if parts:
        yield flush()


def bucket_counts(texts: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts fall into each bucket."""
    ship_package(texts.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, one, _, two in features(t.as_py() for t in batch.column(0)):
                n += np.bincount(np.r_[one, two] % np.uint32(buckets), minlength=buckets)
        used = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(n[used])], names=["bucket", "n"])

    rows = (take(texts, text=text_col).select(text_of("text").alias("text"))
            .mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
            .collect())  # at most one row per bucket
    out = np.zeros(buckets, np.int64)
    for r in rows:
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray, scale: int = 1000) -> np.ndarray:
    """Floored ``scale`` times log ratio of the smoothed bucket shares."""
    up = (target + 1.0) * (float(source.sum()) + len(source))
    down = (source + 1.0) * (float(target.sum()) + len(target))
    return np.array([math.floor(scale * math.log(x)) for x in (up / down).tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """``uid, id, n_words, n_features, weight`` of every document (weight 0 without features)."""
    rows = take(docs, id=id_col, text=text_col)
    schema = rows.select("id", *[F.lit(0).cast("long").alias(c) for c in ("n_words", "n_features", "weight")]).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            words, pairs, total = (np.zeros(n, np.int64) for _ in range(3))
            for word, one, pair, two in features(t.as_py() for t in batch.column(1)):
                words += np.bincount(word, minlength=n)
                pairs += np.bincount(pair, minlength=n)
                for at, h in ((word, one), (pair, two)):
                    # exact: a chunk's sums stay far below 2 ** 53
                    total += np.bincount(at, weights=gain[h % np.uint32(len(gain))], minlength=n).astype(np.int64)
            count = words + pairs
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(words), pa.array(count), pa.array(total // np.maximum(count, 1))],
                names=["id", "n_words", "n_features", "weight"])

    return (rows.select("id", text_of("text").alias("text")).mapInArrow(run, schema)
            .select(F.monotonically_increasing_id().alias("uid"), "*"))


def noise(ident: Column, seed: int = 7, scale: int = 1000) -> Column:
    """Floored Gumbel noise from the first 32 bits of sha256("seed:id")."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(ident.cast("string"), F.lit(""))), 256)
    u = (F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") + 0.5) / F.lit(4294967296.0)
    return F.floor(F.lit(float(-scale)) * F.log(-F.log(u))).cast("long")


def bisect(rows: DataFrame, value: Column, k: int) -> tuple[int, int]:
    """The k-th smallest ``value`` (whole numbers without nulls) of ``rows``, and how many
    are below it: the interval of possible values is halved by an exact count each time."""
    lo, hi = rows.agg(F.min(value), F.max(value)).first()
    below = 0
    while lo < hi:
        mid = (lo + hi) // 2
        n = rows.where(value <= F.lit(mid)).count()
        if n >= k:
            hi = mid
        else:
            lo, below = mid + 1, n
    return lo, below


def resample(docs: DataFrame, target: DataFrame, share: int = 25, least_words: int = 20, buckets: int = BUCKETS,
             seed: int = 7, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """One row per input row: ``id, n_words, n_features, weight, score, rank``.

    Of the N rows with at least ``least_words`` words the floor(share * N / 100) with the
    highest scores are drawn and ranked 1, 2, 3, ...; ties go to the smaller identifier,
    rows without one come last, and repeated rows (same score and identifier) rank in the
    order in which they were read.  All other rows have a null rank.  Null and empty texts have
    no features and weight 0.  Identifiers must be whole numbers (the cutoff is bisected).
    Without target texts gains come from the smoothing alone; an empty table gives an empty
    result.  Other columns are ignored, whatever they are called.
    """
    if not isinstance(take(docs, id=id_col).schema["id"].dataType, T.IntegralType):
        raise ValueError("identifiers must be whole numbers")
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text, buckets))
    rows = materialize(weigh(docs, gain, id_col, text_col)
                       .withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "resampling")
    out = ["id", "n_words", "n_features", "weight", "score"]
    able = rows.where(F.col("n_words") >= least_words).select("uid", "id", "score")
    k = share * able.count() // 100
    if not k:
        return rows.select(*out, F.lit(None).cast("long").alias("rank"))
    # the drawn rows are the k first by (-score, id is null, id, uid); each key is settled in turn
    first, tied, left = F.lit(False), F.lit(True), k
    for key in (-F.col("score"), F.col("id").isNull().cast("int"), F.coalesce("id", F.lit(0)), F.col("uid")):
        cut, below = bisect(able.where(tied), key, left)
        first, tied, left = first | (tied & (key < F.lit(cut))), tied & (key == F.lit(cut)), left - below
        if able.where(tied).count() == left:
            break
    drawn = (F.col("n_words") >= least_words) & (first | tied)
    order = [F.col("score").desc(), F.col("id").asc_nulls_last(), F.col("uid").asc()]
    # after the sort the row counter holds the partition in its upper bits and the place in its lower 33
    place = F.monotonically_increasing_id()
    ordered = materialize(rows.where(drawn).repartitionByRange(shuffle_partitions(rows), *order)
                          .sortWithinPartitions(*order).select(*out, place.alias("place")), "resampled")
    part = F.shiftright("place", 33)
    sizes = ordered.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()  # one row per partition
    ahead, total = [], 0
    for r in sorted(sizes, key=lambda r: r["part"]):
        ahead.append((r["part"], total))
        total += r["n"]
    offsets = docs.sparkSession.createDataFrame(ahead, "part long, ahead long")
    rank = F.col("ahead") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    ranked = (ordered.withColumn("part", part).join(F.broadcast(offsets), "part")  # one row per partition
              .select(*out, rank.alias("rank")))
    return ranked.unionByName(rows.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))
