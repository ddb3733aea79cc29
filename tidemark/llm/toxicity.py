"""Toxicity: class-conditional Kneser-Ney models over the characters of words.

A text's score is the length-normalised difference of its log-likelihoods under a toxic and
an ordinary model.  Both are interpolated Kneser-Ney models of the bytes of words (``ORDER``
bytes, with marks for a word's start and end).  The upper orders are counted per class; the
lower ones come from all documents and are shared, so an expression that a class has hardly
seen is smoothed by how the whole corpus goes on, and contributes next to nothing.

1. Documents are gathered into blocks of about ``BLOCK_BYTES`` of text: the block's distinct
   words and each document's word counts, packed, written once.
2. A block's labels (places of its labelled documents) are joined to it, and its distinct
   n-grams are counted: in toxic, in ordinary and in all documents.  Spark sums them up.
3. The orders' tables are DataFrames keyed by n-gram: continuation counts go down the
   orders, interpolated probabilities come back up by joins on context and shorter n-gram.
4. Each block gets the log ratios of its own n-grams and scores its documents.
5. A logistic curve over scores of labelled documents that took no part in the counts makes
   the score a probability (fitted on a bounded sample, ``sample_rows``).

No table of n-grams is ever collected or broadcast: it grows with the corpus.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, take, text_of
from tidemark.llm.resampling import FOLD
from tidemark.session import ship_package

ORDER = 4
#: Orders from this one on are counted per class, those below are shared.
CLASS_ORDER = 3
DISCOUNT = 0.75
BLOCK_BYTES = 16 << 20
BLOCK_DOCS = 4096
#: n-grams added to a text's length when it is normalised: short texts say little.
EXTRA = 300
SAMPLE_ROWS = 20_000
START, END = 1, 2


def held_out(ident: Column) -> Column:
    """Rows that nothing learns labels from: crc32 of the identifier as text, mod 5, is 0."""
    return fold(ident) == 0


def fold(ident: Column) -> Column:
    return F.crc32(F.coalesce(ident.cast("string"), F.lit("")).cast("binary")) % 5


def pack(words: list[bytes], word: list[np.ndarray], n: list[np.ndarray]) -> bytes:
    """A block as a compressed Arrow stream of one row: its distinct words, the more documents
    hold one the earlier; how many each document has; their numbers, ascending within a
    document and stored as steps; and their counts."""
    distinct = np.array([len(w) for w in word], np.int32)
    flat = np.concatenate(word)
    rank = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
    number = np.empty(len(words), np.int32)
    number[rank] = np.arange(len(words), dtype=np.int32)
    flat = number[flat]
    by = np.lexsort((flat, np.repeat(np.arange(len(word)), distinct)))
    flat, counts = flat[by], np.concatenate(n)[by]
    every = [pa.array([words[i] for i in rank], pa.binary())]
    every += [pa.array(x) for x in (distinct, np.diff(flat, prepend=np.int32(0)), counts)]
    columns = [pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x) for x in every]
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays(columns, names=["words", "distinct", "step", "n"])
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words, distinct words per document, word numbers and counts."""
    batch = pa.ipc.open_stream(data).read_next_batch()
    words, distinct, step, n = (c.values for c in batch.columns)
    return (words.to_pylist(), distinct.to_numpy().astype(np.int64),
            np.cumsum(step.to_numpy(), dtype=np.int64), n.to_numpy().astype(np.int64))


def blocks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``block, ids, bag``: every document is in one block, written to the shared folder."""
    ship_package(docs.sparkSession)
    rows = take(docs, id=id_col, text=text_col)
    schema = rows.select(F.lit(0).cast("long").alias("block"), F.array("id").alias("ids"),
                         F.lit(b"").alias("bag")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        ids: list[pa.Array] = []
        word: list[np.ndarray] = []
        n: list[np.ndarray] = []
        number: dict[bytes, int] = {}
        size = 0

        def flush() -> pa.RecordBatch:
            packed = pack(list(number), word, n)
            values = pa.concat_arrays(ids)
            return pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values),
                 pa.array([packed], pa.binary())], names=["block", "ids", "bag"])

        for batch in batches:
            for i in range(batch.num_rows):
                raw = (batch.column(1)[i].as_py() or "").encode("utf-8", "surrogatepass")
                ids.append(batch.column(0).slice(i, 1))
                bag = Counter(raw.translate(FOLD).split())
                word.append(np.fromiter((number.setdefault(w, len(number)) for w in bag), np.int32, len(bag)))
                n.append(np.fromiter(bag.values(), np.int32, len(bag)))
                size += len(raw)
                if size >= BLOCK_BYTES or len(ids) >= BLOCK_DOCS:
                    yield flush()
                    ids, word, n, number, size, block = [], [], [], {}, 0, block + 1
        if ids:
            yield flush()

    return materialize(rows.select("id", text_of("text").alias("text")).mapInArrow(run, schema), "toxicity-blocks")


def word_grams(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all words in turn (ORDER bytes as a whole number), and how many each has."""
    sizes = np.array([len(w) + 1 for w in words], np.int64)
    pad = ORDER - 1
    text = np.frombuffer(b"".join(bytes([START]) * pad + w + bytes([END]) for w in words), np.uint8).astype(np.int64)
    at = np.arange(sizes.sum()) + pad * (np.repeat(np.arange(len(words)), sizes) + 1)
    gram = np.zeros(len(at), np.int64)
    for back in range(pad, -1, -1):
        gram = gram << 8 | text[at - back]
    return gram, sizes


def count_grams(labelled: DataFrame) -> DataFrame:
    """``block, gram, toxic, ordinary, every`` from blocks with ``roles`` (place, toxic?)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, distinct, word, n = unpack(row["bag"])
                if not words:
                    continue
                role = np.full(len(distinct), -1)
                for r in row["roles"] or ():
                    role[r["place"]] = r["toxic"]
                of_doc = np.repeat(role, distinct)
                gram, sizes = word_grams(words)
                grams, at = np.unique(gram, return_inverse=True)
                counts = []
                for keep in (of_doc == 1, of_doc == 0, slice(None)):
                    per_word = np.bincount(word[keep], weights=n[keep], minlength=len(words))
                    per_gram = np.bincount(at, weights=np.repeat(per_word, sizes), minlength=len(grams))
                    counts.append(pa.array(per_gram.astype(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(grams), row["block"])), pa.array(grams), *counts],
                    names=["block", "gram", "toxic", "ordinary", "every"])

    return labelled.mapInArrow(run, "block long, gram long, toxic long, ordinary long, every long")


POPULATIONS = ("toxic", "ordinary", "every")


def shorter(gram: str, order: int) -> Column:
    """The n-gram without its first byte."""
    return F.col(gram).bitwiseAND((1 << 8 * (order - 1)) - 1)


def log_ratios(counts: DataFrame) -> DataFrame:
    """``gram, ratio``: log of the toxic over the ordinary probability of a gram's last byte."""
    table = materialize(counts.groupBy("gram").agg(*[F.sum(p).alias(p) for p in POPULATIONS]), "toxicity-order")
    orders = [table]
    for order in range(ORDER, 1, -1):
        # Kneser-Ney: a shorter n-gram counts the different bytes seen before it
        table = materialize(table.groupBy(shorter("gram", order).alias("gram")).agg(
            *[F.count_if(F.col(p) > 0).alias(p) for p in POPULATIONS]), "toxicity-order")
        orders.append(table)
    below = None
    for order, table in enumerate(reversed(orders), 1):
        context = F.shiftright("gram", 8).alias("context")
        sums = table.groupBy(context).agg(
            *[F.sum(p).alias(f"{p}_sum") for p in POPULATIONS],
            *[F.count_if(F.col(p) > 0).alias(f"{p}_kinds") for p in POPULATIONS])
        rows = table.select("*", context, shorter("gram", order).alias("tail")).join(sums, "context")
        if below is None:
            rows = rows.select("*", *[F.lit(1.0 / 256).alias(f"{p}_low") for p in POPULATIONS])
        else:
            rows = rows.join(below.select(F.col("gram").alias("tail"), *[F.col(f"{p}_p").alias(f"{p}_low")
                                                                         for p in POPULATIONS]), "tail")

        def smoothed(p: str) -> Column:
            seen = (F.greatest(F.col(p) - DISCOUNT, F.lit(0.0))
                    + DISCOUNT * F.col(f"{p}_kinds") * F.col(f"{p}_low")) / F.col(f"{p}_sum")
            return F.when(F.col(f"{p}_sum") > 0, seen).otherwise(F.col(f"{p}_low"))

        own = {p: p if order >= CLASS_ORDER else "every" for p in POPULATIONS}
        below = materialize(rows.select("gram", *[smoothed(own[p]).alias(f"{p}_p") for p in POPULATIONS]),
                            "toxicity-model")
    return below.select("gram", (F.log("toxic_p") - F.log("ordinary_p")).alias("ratio"))


def evidence(block_rows: DataFrame, counts: DataFrame, ratios: DataFrame) -> DataFrame:
    """``id, grams, evidence`` per document: n-grams and the sum of their log ratios."""
    ready = (counts.select("block", "gram").join(ratios, "gram").groupBy("block")
             .agg(F.collect_list(F.struct("gram", "ratio")).alias("model")))  # the n-grams of one block's words
    id_type = block_rows.schema["ids"].dataType.elementType
    schema = block_rows.select(F.lit(None).cast(id_type).alias("id"), F.lit(0).cast("long").alias("grams"),
                               F.lit(0.0).alias("evidence")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column(0).slice(i, 1).flatten()
                words, distinct, word, n = unpack(batch.column(1)[i].as_py())
                doc = np.repeat(np.arange(len(distinct)), distinct)
                total, weight = np.zeros(len(distinct)), np.zeros(len(distinct))
                if words:
                    model = batch.column(2).slice(i, 1).flatten()
                    known, ratio = (model.field(k).to_numpy() for k in (0, 1))
                    by = np.argsort(known)
                    gram, sizes = word_grams(words)
                    each = ratio[by][np.searchsorted(known[by], gram)]
                    per_word = np.add.reduceat(each, np.cumsum(sizes) - sizes)
                    total = np.bincount(doc, weights=n * per_word[word], minlength=len(distinct))
                    weight = np.bincount(doc, weights=n * sizes[word], minlength=len(distinct))
                yield pa.RecordBatch.from_arrays([ids, pa.array(weight.astype(np.int64)), pa.array(total)],
                                                 names=["id", "grams", "evidence"])

    return (block_rows.select("block", "ids", "bag").join(ready, "block", "left")
            .select("ids", "bag", "model").mapInArrow(run, schema))


def logistic(x: np.ndarray, y: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset of P(1 | x) by Newton steps with a slight pull to 0."""
    scale = max(float(np.abs(x).max(initial=0.0)), 1e-9)
    z = np.stack([x / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    pull = np.array([1e-4, 1e-4])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        g = z.T @ (p - y) + pull * w
        h = (z * (p * (1 - p))[:, None]).T @ z + np.diag(pull)
        step = np.linalg.solve(h, g)
        w -= step * min(1.0, 5.0 / max(np.abs(step).max(), 1e-12))
    return float(w[0] / scale), float(w[1])


def score_documents(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, id_col: str = "doc_id",
                    text_col: str = "text", label_id: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """One row per input row: ``id, held_out, grams, evidence, score``.

    ``evidence`` is the log-likelihood ratio, ``score`` the probability of label 1 for
    evidence / (grams + EXTRA).  Labels are read from rows that are not held out: folds 1 to
    3 of 5 are counted, fold 4 calibrates.  Several labels of one identifier are averaged,
    null labels and identifiers are left out.  Null and empty texts have no n-grams and
    evidence 0.  If fold 4 lacks one of the labels, the score is the share of label 1 in it (0 without
    any row).  Identifiers may be null or repeated; other columns are ignored; an empty
    table gives an empty result.
    """
    known = materialize(take(labels, id=label_id, label=label_col).where("id is not null and label is not null")
                        .where(~held_out(F.col("id"))).groupBy("id")
                        .agg((F.avg("label") >= 0.5).cast("int").alias("toxic")), "toxicity-labels")
    parts = blocks(docs, id_col, text_col)
    train = known.where(fold(F.col("id")) != 4)
    roles = (parts.select("block", F.posexplode("ids").alias("place", "id")).join(train, "id")
             .groupBy("block").agg(F.collect_list(F.struct("place", "toxic")).alias("roles")))  # at most BLOCK_DOCS
    labelled = parts.select("block", "bag").join(roles, "block", "left")
    counts = materialize(count_grams(labelled), "toxicity-grams")
    found = materialize(evidence(parts, counts, log_ratios(counts))
                        .withColumn("x", F.col("evidence") / (F.col("grams") + EXTRA)), "toxicity-evidence")
    judged = found.join(known.where(fold(F.col("id")) == 4), "id")
    order = F.xxhash64("id", "evidence", "grams")
    got = (judged.select("x", "toxic", order.alias("h")).orderBy("h", "x", "toxic").limit(sample_rows).collect())
    x, y = np.array([r["x"] for r in got], float), np.array([r["toxic"] for r in got], float)
    if len(y) and 0 < y.mean() < 1:
        slope, offset = logistic(x, y)
        score = F.lit(1.0) / (F.lit(1.0) + F.exp(-(F.lit(slope) * F.col("x") + F.lit(offset))))
    else:
        score = F.lit(float(y.mean()) if len(y) else 0.0)
    return found.select("id", held_out(F.col("id")).alias("held_out"), "grams", "evidence", score.alias("score"))
