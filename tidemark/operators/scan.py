"""Scans of a state machine over a key's rows, applied inside chunks and then over chunks.

The machine here is the one behind timers that re-arm (D16, D9b): *greedy windows*.  Rows are
points, resets or neither.  With no window open, a point opens one (it is its anchor) that
lasts ``duration``; points inside do nothing, a reset closes it, and the first point behind
its end opens the next.

A recursion over rows is avoided by summaries.  What a chunk does to the state it is entered
with, the end of the open window, is a function of that end alone: if the chunk has a reset,
the state behind it does not depend on what came before the reset; otherwise it depends on
which point is the first behind the end, and that must lie within ``duration`` of the chunk's
start.  A summary lists those points with the end that each leads to.  Summaries of
neighbouring chunks combine to a summary again (:func:`combine`), so a key that holds a third
of all rows is cut, its chunks are summarised in parallel, the few summaries are applied in
turn, and the chunks run in parallel with the state they are entered with.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefns import duration_us, epoch_us
from tidemark.operators.keys import join_keys
from tidemark.operators.sequence import DEFAULT_CHUNK, Chunks, plan_chunks
from tidemark.session import materialize, ship_package

CLOSED = -(1 << 62)


@dataclass
class Summary:
    """``reset``: the end left behind does not depend on the end entered with and is ``end``.
    ``points``: the first points a window may be opened at, with the end each leads to."""

    reset: bool
    end: int
    points: np.ndarray
    ends: np.ndarray

    def leave(self, end: int) -> int:
        """The end of the open window behind the chunk, entered with ``end``."""
        if self.reset:
            return self.end
        i = int(np.searchsorted(self.points, end, side="right"))
        return int(self.ends[i]) if i < len(self.points) else end


def combine(one: Summary, two: Summary) -> Summary:
    """The summary of two neighbouring chunks."""
    if two.reset:
        return Summary(True, two.end, one.points, one.ends)
    if one.reset:
        return Summary(True, two.leave(one.end), one.points, one.ends)
    points = np.concatenate([one.points, two.points])
    ends = np.concatenate([np.array([two.leave(int(e)) for e in one.ends], np.int64), two.ends])
    return Summary(False, CLOSED, points, ends)


def following(at: np.ndarray, point: np.ndarray, segment: np.ndarray, duration: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes of all points, and for each (by its number among the points) the number of the
    first point of its segment more than ``duration`` later, -1 without one."""
    where = np.flatnonzero(point)
    nxt = np.searchsorted(at[where], at[where] + duration, side="right")
    inside = nxt < len(where)
    inside[inside] = segment[where[nxt[inside]]] == segment[where[inside]]
    return where, np.where(inside, nxt, -1)


def summarise(at: np.ndarray, point: np.ndarray, reset: np.ndarray, duration: int) -> Summary:
    """Summary of a chunk's rows, ordered by time ``at``."""
    segment = np.cumsum(reset)
    where, nxt = following(at, point, segment, duration)
    last = at[where] + duration
    for i in range(len(where) - 1, -1, -1):  # from the back: where the chain from each point ends
        if nxt[i] >= 0:
            last[i] = last[nxt[i]]
    first = where[(segment[where] == 0)]
    # the entered end is at most the chunk's start plus the duration: no later point can be first, but one
    n = min(len(first), int(np.searchsorted(at[first], at[0] + duration, side="right")) + 1) if len(at) else 0
    if len(reset) and segment[-1]:
        tail = np.flatnonzero(segment[where] == segment[-1])
        return Summary(True, int(last[tail[0]]) if len(tail) else CLOSED, at[first][:n], last[:n])
    return Summary(False, CLOSED, at[first][:n], last[:n])


def mark_rows(at: np.ndarray, point: np.ndarray, reset: np.ndarray, fresh: np.ndarray, entered: np.ndarray,
              duration: int, end: int) -> tuple[np.ndarray, int]:
    """Which rows open a window, for the rows of many keys in turn, and the end left behind.

    ``fresh`` marks the first row of a key's chunk, entered with a window open until
    ``entered``; rows before the first such row go on with one open until ``end``.
    """
    # times made ascending over all keys, farther apart than a window between two keys
    key = np.cumsum(fresh)
    low, step = int(at.min()), int(at.max() - at.min()) + duration + 2
    t = at - low + key * step
    cut = reset | fresh
    segment = np.cumsum(cut)
    starts = np.flatnonzero(np.r_[True, cut[1:]])
    entry = np.where(reset[starts], CLOSED, np.where(fresh[starts], entered[starts], end))
    where, nxt = following(t, point, segment, duration)
    opens = np.searchsorted(t[where], np.clip(entry - low, -1, step - 2) + key[starts] * step, side="right")
    live = np.maximum(opens, np.searchsorted(where, starts))
    inside = live < len(where)
    inside[inside] = segment[where[live[inside]]] == segment[starts[inside]]
    live = live[inside]
    out = np.zeros(len(at), bool)
    while len(live):  # one step of every segment's chain at a time
        out[where[live]] = True
        live = nxt[live]
        live = live[live >= 0]
    last = starts[-1] + np.flatnonzero(out[starts[-1]:])
    return out, int(at[last[-1]]) + duration if len(last) else int(entry[-1])


def anchors(at: np.ndarray, point: np.ndarray, reset: np.ndarray, duration: int, end: int) -> np.ndarray:
    """:func:`mark_rows` for the rows of one chunk, entered with a window open until ``end``."""
    return mark_rows(at, point, reset, np.zeros(len(at), bool), np.zeros(len(at), np.int64), duration, end)[0]


def greedy_windows(df: DataFrame, keys: Sequence[str], order: Sequence[str], point: Column, reset: Column,
                   duration: str, name: str = "anchor", chunk: str | Chunks = DEFAULT_CHUNK) -> DataFrame:
    """``df`` plus a boolean: does the row open a window?  Times count in milliseconds, as
    timers do; a row that is both point and reset resets first.

    Rows are shuffled once, by (key, chunk); a task runs over its keys batch by batch.
    """
    ship_package(df.sparkSession)
    keys, order, ms = list(keys), list(order), duration_us(duration) // 1000
    chunks = plan_chunks(df, keys, order[0], chunk)
    d = chunks.add(df, keep_width=True).withColumns({"__at": F.floor(epoch_us(df, order[0]) / 1000).cast("long"),
                                    "__point": F.coalesce(point, F.lit(False)),
                                    "__reset": F.coalesce(reset, F.lit(False))})
    part = [*keys, "__chunk"]
    if chunks.split:
        d = materialize(d, "scan")
        tables = T.StructType([*d.select(*part).schema.fields, T.StructField("reset", T.BooleanType()),
                               T.StructField("end", T.LongType()),
                               T.StructField("points", T.ArrayType(T.LongType())),
                               T.StructField("ends", T.ArrayType(T.LongType()))])

        def describe(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order, kind="stable")
            s = summarise(*(pdf[c].to_numpy() for c in ("__at", "__point", "__reset")), ms)
            row = pdf[part].iloc[:1].reset_index(drop=True)
            return row.assign(reset=s.reset, end=s.end, points=[s.points.tolist()], ends=[s.ends.tolist()])

        def enter(pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values("__chunk", ignore_index=True)
            end, ends = CLOSED, []
            for r in pdf.itertuples(index=False):
                ends.append(end)
                end = Summary(r.reset, r.end, np.asarray(r.points, np.int64), np.asarray(r.ends, np.int64)).leave(end)
            return pdf[part].assign(__end=ends)

        small = d.where("__width is not null").select(*part, *[c for c in order if c not in part], "__at",
                                                      "__point", "__reset")
        summaries = small.groupBy(*part).applyInPandas(describe, tables)
        entered = T.StructType([*d.select(*part).schema.fields, T.StructField("__end", T.LongType())])
        # one row per chunk of a cut key
        ends = (summaries.groupBy(*keys) if keys else summaries.groupBy(F.lit(1))).applyInPandas(enter, entered)
        d = join_keys(d, ends, part, "left").withColumn("__end", F.coalesce("__end", F.lit(CLOSED)))
    else:
        d = d.withColumn("__end", F.lit(CLOSED))
    schema, columns = T.StructType([*df.schema.fields, T.StructField(name, T.BooleanType())]), list(df.columns)
    part = part if chunks.split else keys

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end, before = CLOSED, None
        for batch in batches:
            if not batch.num_rows:
                continue
            group = batch.select(part).to_pandas()
            fresh = np.zeros(len(group), bool)
            for c in part:
                v = group[c]
                fresh[1:] |= ((v != v.shift()) & ~(v.isna() & v.shift().isna())).to_numpy()[1:]
            first = [x.as_py() for x in (batch.column(c)[0] for c in part)]
            fresh[0] = before is None or first != before
            at, point, reset, entered = (batch.column(c).to_numpy(zero_copy_only=False)
                                         for c in ("__at", "__point", "__reset", "__end"))
            out, end = mark_rows(at, point.astype(bool), reset.astype(bool), fresh, entered, ms, end)
            before = [x.as_py() for x in (batch.column(c)[batch.num_rows - 1] for c in part)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(out)], names=[*columns, name])

    dealt = d.repartition(*part) if part else d.repartition(1)
    return dealt.sortWithinPartitions(*part, *order).mapInArrow(mark, schema)
