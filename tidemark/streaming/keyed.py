"""The base of the keyed processors: the rows of many keys as one ordered frame, one clock, one deadline.

Keys are spread over buckets by hash (``tidemark.streamBuckets``, 256; fixed for a query's life,
like its state partitions), and Spark's keyed state is that of a bucket.  A
:class:`KeyedSequence` turns a bucket's rows into calls of :meth:`KeyedSequence.advance_all`,
which gets a frame ordered by (key, time, tie-break columns), the keys' state as a frame and
the time up to which the keys are complete, and returns its output and the new state.  So a
micro-batch costs a few calls of the state store and whole-column work per bucket, and not a
round of calls per key.

``hold=True``: rows wait in list state until the watermark has passed them, so ``advance_all``
sees the same sequence however the input is cut into micro-batches and however far (up to the
watermark's delay) rows are out of order.  ``hold=False``: rows are handed over as they
arrive, ordered within their micro-batch; for processors that do not depend on the order.

``clock="processing"`` hands in the micro-batch's processing time instead: rows count as
happening when they arrive and deadlines are processing-time timers.  A processor does not
know which clock drives it, so a replay on the event clock checks what runs on the real one.
``clock="none"`` is for processors that hold nothing and set no deadline.

Times are microseconds since 1970 (column ``us``, ``NO_TIME`` without one); timers have
millisecond resolution.  Whole numbers travel as such: a null is ``NO_NUMBER`` until the output.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import (
    ExpiredTimerInfo,
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)


# Processors travel by value: Spark first loads one in a worker of the driver's, which sees
# neither files added to the session nor the folder that this package was imported from.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

NO_TIME = -(1 << 62)
NO_NUMBER = (1 << 63) - 1
#: Rows of one chunk of state.
CHUNK = 1 << 18


def from_micros(us) -> pd.Series:
    """Times of numbers, null where there is none.  Not by ``pd.to_datetime``: its cache of
    repeated values failed on large buckets with many nulls."""
    us = pd.Series(us, dtype="Int64")
    gone = (us.abs() >= -NO_TIME).fillna(True).to_numpy(bool)
    times = us.fillna(0).to_numpy("int64").astype("datetime64[us]")
    times[gone] = np.datetime64("NaT")
    return pd.Series(times, index=us.index)


def firsts(k: np.ndarray) -> np.ndarray:
    """Which rows are the first of their key, for keys in turn."""
    return np.r_[True, k[1:] != k[:-1]] if len(k) else np.zeros(0, bool)


def lasts(k: np.ndarray) -> np.ndarray:
    return np.r_[k[1:] != k[:-1], True] if len(k) else np.zeros(0, bool)


def before(values: np.ndarray, k: np.ndarray, entered: np.ndarray) -> np.ndarray:
    """The value of the key's row before; for its first row, that of ``entered`` (one per key)."""
    out = np.concatenate([values[:1], values[:-1]])
    first = firsts(k)
    out[first] = entered[k[first]]
    return out


def per_key(state: pd.DataFrame, column: str, n: int, default: float) -> np.ndarray:
    """One number per key from a state of one row per key."""
    out = np.full(n, default)
    out[state["k"].to_numpy()] = state[column].to_numpy()
    return out


def _pack(frame: pd.DataFrame) -> list[tuple[bytes]]:
    out = []
    for i in range(0, len(frame), CHUNK):
        batch = pa.RecordBatch.from_pandas(frame.iloc[i:i + CHUNK], preserve_index=False)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as w:
            w.write_batch(batch)
        out.append((sink.getvalue().to_pybytes(),))
    return out


def _unpack(chunks) -> pd.DataFrame | None:
    frames = [pa.ipc.open_stream(bytes(c)).read_pandas() for (c,) in chunks]
    return pd.concat(frames, ignore_index=True) if frames else None


class KeyedSequence(StatefulProcessor):
    """See the module.  ``fields`` are the columns ``advance_all`` needs (name: Spark type), numbers
    and strings; ``order`` names those that break ties of time."""

    #: Columns of the state (name: numpy type), besides the key's number ``k``.
    state: dict[str, str] = {}
    ttl: int | None = None
    #: Whether rows without a time come last instead of first.
    no_time_last = False

    def __init__(self, fields: dict[str, str], order: tuple[str, ...] = (), ts: str = "ts", hold: bool = True,
                 clock: str = "event"):
        if clock not in ("event", "processing", "none") or (hold and clock != "event"):
            raise ValueError("rows are held by the event clock only")
        self.fields, self.order, self.ts, self.hold, self.clock = dict(fields), list(order), ts, hold, clock

    # --- for processors -----------------------------------------------------

    def advance_all(self, rows: pd.DataFrame, state: pd.DataFrame, keys: pd.DataFrame, now: int
                    ) -> tuple[pd.DataFrame, pd.DataFrame]:
        """Output for the next rows (maybe none) and the state behind them.

        ``k`` is a key's number, its place in ``keys``; ``rows`` come by (k, us, order), the
        output has a column ``k`` instead of the keys.  All rows up to ``now`` have been
        seen with ``hold``; without it, ``now`` is the clock."""
        raise NotImplementedError

    def deadline(self, state: pd.DataFrame) -> int | None:
        """The next time in ``us`` at which a key of this (not empty) state is due without any row."""
        return None

    # --- for Spark ------------------------------------------------------------

    def bind(self, stream: DataFrame, keys: list[str], schema: T.StructType) -> None:
        """The keys' and the output's columns, known before the stream starts."""
        types = {f.name: f.dataType for f in stream.schema.fields}
        self.keys = list(keys)
        self.key_times = [isinstance(types[k], (T.TimestampType, T.TimestampNTZType)) for k in keys]
        self.key_columns = ["nulls__", *[f"key{i}__" for i in range(len(keys))]]
        self.columns = [f.name for f in schema.fields]
        self.numbers = [f.name for f in schema.fields if isinstance(f.dataType, T.LongType)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        if self.hold:
            self.buffer = handle.getListState("buffer", "chunk binary")
        self.stored = handle.getListState("state", "chunk binary", self.ttl)
        self.armed = handle.getValueState("armed", "ms long")

    def _now(self, timer_values: TimerValues) -> int:
        if self.clock == "none":
            return 0
        if self.clock == "processing":
            return timer_values.getCurrentProcessingTimeInMs() * 1000
        return timer_values.getCurrentWatermarkInMs() * 1000

    def _arm(self, us: int) -> None:
        """One timer per bucket: the earliest time that any of its keys waits for."""
        ms = max(0, -(-int(us) // 1000))
        old = self.armed.get()[0] if self.armed.exists() else None
        if old is None or ms < old:
            if old is not None:
                self.handle.deleteTimer(old)
            self.handle.registerTimer(ms)
            self.armed.update((ms,))

    def _ordered(self, rows: pd.DataFrame) -> pd.DataFrame:
        at = rows["us"].mask(rows["us"] == NO_TIME, NO_NUMBER) if self.no_time_last else rows["us"]
        by = [rows["k"], at, *[rows[c] for c in self.order]]
        by = [pd.factorize(c, sort=True, use_na_sentinel=False)[0] if c.dtype == object else c.to_numpy() for c in by]
        return rows.take(np.lexsort(by[::-1])).reset_index(drop=True)

    def _step(self, rows: pd.DataFrame | None, now: int, waiting: int | None) -> Iterator[pd.DataFrame]:
        state = _unpack(self.stored.get()) if self.stored.exists() else None
        parts = [f for f in (state, rows) if f is not None and len(f)]
        if parts:
            both = pd.concat([f[self.key_columns] for f in parts], ignore_index=True)
            number = both.groupby(self.key_columns, sort=False, dropna=False).ngroup().to_numpy()
            keys = both.drop_duplicates(ignore_index=True)
            cut = 0 if state is None else len(state)
            rows = self._ordered((rows if rows is not None else self._no_rows()).assign(k=number[cut:]))
            old = self._no_state() if state is None else state[list(self.state)].assign(k=number[:cut])
            out, new = self.advance_all(rows, old, keys, now)
            if len(new):
                names = pd.DataFrame({c: keys[c].to_numpy()[new["k"].to_numpy()] for c in self.key_columns})
                self.stored.put(_pack(pd.concat([names, new[list(self.state)].reset_index(drop=True)], axis=1)))
                due = self.deadline(new)
                waiting = min((t for t in (waiting, due) if t is not None), default=None)
            elif state is not None:
                self.stored.clear()
        if waiting is not None:  # at or after the time itself
            self._arm(max(waiting, now + 1))
        if parts and out is not None and len(out):
            yield self._named(out, keys)

    def _no_state(self) -> pd.DataFrame:
        return pd.DataFrame({"k": np.zeros(0, "int64"), **{c: np.zeros(0, t) for c, t in self.state.items()}})

    def _no_rows(self) -> pd.DataFrame:
        kinds = {"long": "int64", "bigint": "int64", "int": "int64", "double": "float64"}
        return pd.DataFrame({"us": np.zeros(0, "int64"),
                             **{c: np.zeros(0, kinds.get(t, object)) for c, t in self.fields.items()}})

    def _named(self, out: pd.DataFrame, keys: pd.DataFrame) -> pd.DataFrame:
        """The output with the keys' values, null numbers null again."""
        k, done = out["k"].to_numpy(), {}
        nulls = keys["nulls__"].to_numpy()[k]
        for c in self.columns:
            if c in self.keys:
                i = self.keys.index(c)
                values = pd.Series(keys[f"key{i}__"].to_numpy()[k])
                values = from_micros(values) if self.key_times[i] else values
                gone = (nulls >> i & 1).astype(bool) & (not self.key_times[i])
            else:
                values = out[c].reset_index(drop=True)
                number = c in self.numbers and values.dtype == "int64"
                gone = (values == NO_NUMBER).to_numpy() if number else np.zeros(len(values), bool)
            if gone.any():
                values = values.astype("Int64" if values.dtype == "int64" else object).mask(gone)
            done[c] = values
        return pd.DataFrame(done)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:
        frames = [f for f in rows if len(f)]
        if not frames:
            return
        now = self._now(timerValues)
        df = pd.concat([f[[*self.key_columns, "us", *self.fields]] for f in frames], ignore_index=True)
        if self.clock == "processing":
            df["us"] = now
        if self.hold:
            self.buffer.appendList(_pack(df))
            self._arm(int(df["us"].min()))
            return
        yield from self._step(df, now, None)

    def handleExpiredTimer(self, key, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo
                           ) -> Iterator[pd.DataFrame]:
        now = self._now(timerValues)
        self.armed.clear()
        ready, waiting = None, None
        if self.hold and self.buffer.exists():
            held = _unpack(self.buffer.get())
            due = held["us"] <= now
            if due.any():
                ready = held[due]
                if due.all():
                    self.buffer.clear()
                else:
                    self.buffer.put(_pack(held[~due]))
            if not due.all():
                waiting = int(held["us"][~due].min())
        yield from self._step(ready, now, waiting)

    def close(self) -> None:
        pass


def run_keyed(stream: DataFrame, keys: list[str], processor: KeyedSequence, schema: str | T.StructType,
              event_time_col: str = "") -> DataFrame:
    """``processor`` over the keys of a stream, rows appended as they come.  Null keys are a key.

    The mode of time follows from the processor: its clock, or none if it holds nothing
    (then it can set no deadline either)."""
    mode = {"event": "EventTime", "processing": "ProcessingTime", "none": "None"}[processor.clock]
    schema = T.DataType.fromDDL(schema) if isinstance(schema, str) else schema
    processor.bind(stream, keys, schema)
    types = {f.name: f.dataType for f in stream.schema.fields}

    def plain(c: str):
        if isinstance(types[c], (T.TimestampType, T.TimestampNTZType)):
            return F.coalesce(F.unix_micros(F.col(c).cast("timestamp")), F.lit(NO_TIME))
        if isinstance(types[c], T.IntegralType):
            return F.coalesce(F.col(c).cast("long"), F.lit(NO_NUMBER))
        return F.col(c)

    nulls = F.lit(0)
    for i, k in enumerate(keys):
        nulls = nulls.bitwiseOR(F.when(F.col(k).isNull(), F.lit(1 << i)).otherwise(F.lit(0)))
    buckets = int(stream.sparkSession.conf.get("tidemark.streamBuckets", "256"))
    rows = stream.select(
        F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("bucket__"), nulls.alias("nulls__"),
        *[plain(k).alias(f"key{i}__") for i, k in enumerate(keys)], plain(processor.ts).alias("us"),
        *[plain(c).alias(c) for c in processor.fields], F.col(processor.ts).alias("ts__"))
    return rows.groupBy("bucket__").transformWithStateInPandas(processor, schema, "Append", mode,
                                                               eventTimeColumnName=event_time_col)
