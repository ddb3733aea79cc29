"""Per-key ordered scans that do not put a whole key into one task.

The reference processes each key's events one at a time in keyed state
(previous reading, running min, login-fail buffer, ...).  The plain Spark
translation, a window function ``partitionBy(key).orderBy(ts)``, sends every
row of a key to a single task: if one user or sensor holds a third of all
rows, a third of the job runs on one core.

Every primitive here cuts the key's timeline into time chunks and runs the
window inside ``(key, chunk)`` partitions.  What crosses a chunk border (the
last row before the chunk, the total of all earlier chunks) is computed from a
small per-(key, chunk) summary table -- one row per chunk, so even the hottest
key has only ``time span / chunk width`` summary rows -- and joined back on
``(key, chunk)``.  The big side is shuffled once, on ``(key, chunk)``, and the
join reuses that partitioning (or AQE turns it into a broadcast after checking
the summary's real size).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timefns import duration_us, epoch_us
from tidemark.operators.keys import join_keys
from tidemark.session import materialize

# Chunking: by default ("auto") only hot keys are cut, each into chunks of
# about ``tidemark.chunkRows`` rows (see plan_chunks).  A fixed width ("1 hour")
# cuts every key; the session setting ``tidemark.chunk`` picks the default.
DEFAULT_CHUNK = "default"
FALLBACK_CHUNK = "auto"


def resolve_chunk(df: DataFrame, chunk):
    if chunk != DEFAULT_CHUNK:
        return chunk
    return _conf(df, "tidemark.chunk", FALLBACK_CHUNK)


_CHUNK = "__chunk"


def _as_list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _conf(df: DataFrame, key: str, default: str) -> str:
    try:
        return df.sparkSession.conf.get(key, default)
    except Exception:  # no session conf access (e.g. some remote clients)
        return default


@dataclass(frozen=True)
class Chunks:
    """How the keys of one input are cut along their order column.

    ``width``: every key, into chunks of that width.  ``hot``: a table of the keys that are
    cut, each with its own width.  Neither: no key is cut and no border exists.
    """

    keys: tuple[str, ...]
    order: str
    width: str | int | None = None
    hot: DataFrame | None = None

    @property
    def split(self) -> bool:
        return self.width is not None or self.hot is not None

    def add(self, df: DataFrame, least: int = 0, keep_width: bool = False) -> DataFrame:
        """``df`` with the chunk of each row, 0 for a key that is whole.

        ``least``: no chunk is narrower; ``keep_width`` leaves the width of the row's chunks
        (null for a whole key) in ``__width``."""
        if self.width is not None:
            number = isinstance(df.schema[self.order].dataType, T.NumericType)
            rows = self.width if isinstance(self.width, int) else 1 << 20
            d = df.withColumn("__width", F.lit(rows if number else duration_us(self.width)).cast("long"))
        elif self.hot is None:
            d = df.withColumn("__width", F.lit(None).cast("long"))
        elif self.keys:
            d = join_keys(df, self.hot, self.keys, "left")
        else:  # all rows are one key: one width
            d = df.withColumn("__width", F.lit(self.hot.first()["__width"]).cast("long"))
        d = d.withColumn("__width", F.greatest("__width", F.when(F.col("__width").isNotNull(), F.lit(least).cast("long"))))
        chunk = F.floor(_position(df, self.order) / F.col("__width"))
        d = d.withColumn(_CHUNK, F.coalesce(chunk, F.lit(0)).cast("long"))
        return d if keep_width else d.drop("__width")


def plan_chunks(df: DataFrame, keys: Sequence[str], ts: str, chunk: str | Chunks = DEFAULT_CHUNK) -> Chunks:
    """Decide how ``df`` is cut.

    A duration (or a row count for a numeric order column) cuts every key into chunks of
    that width.  ``"auto"`` (the default) cuts only hot keys: a first pass counts the rows of
    each key with partial aggregation; a key, null included, with more than
    ``tidemark.hotKeyRows`` rows (default 2,000,000) is cut into chunks of about
    ``tidemark.chunkRows`` rows (default 1,000,000; its span scaled by that fraction).
    ``"auto:limit:rows"`` names both.  Without a hot key, as measured, the scan is the plain
    window plan.  Without keys all rows are one key.  The table of hot keys has at most
    rows / limit entries and is joined, not broadcast by force.
    """
    if isinstance(chunk, Chunks):
        return chunk
    chunk = resolve_chunk(df, chunk)
    keys = tuple(_as_list(keys))
    if not str(chunk).startswith("auto"):
        return Chunks(keys, ts, width=chunk)
    limit, rows = int(_conf(df, "tidemark.hotKeyRows", "2000000")), int(_conf(df, "tidemark.chunkRows", "1000000"))
    if ":" in chunk:
        limit, rows = (int(x) for x in chunk.split(":")[1:])
    hot = (df.select(*keys, _position(df, ts).alias("__pos")).groupBy(*keys)
           .agg(F.count(F.lit(1)).alias("__n"), F.min("__pos").alias("__lo"), F.max("__pos").alias("__hi"))
           .where(F.col("__n") > limit)
           .select(*keys, F.greatest(F.lit(1), F.ceil((F.col("__hi") - F.col("__lo") + 1) * F.lit(rows)
                                                      / F.col("__n"))).cast("long").alias("__width")))
    if hot.isEmpty():
        return Chunks(keys, ts)
    return Chunks(keys, ts, hot=materialize(hot, "hot-keys"))


def _position(df: DataFrame, ts: str) -> Column:
    """Epoch microseconds of a time column, or the value of a numeric one."""
    if isinstance(df.schema[ts].dataType, T.NumericType):
        return F.col(ts).cast("long")
    return epoch_us(df, ts)


def _order_struct(order: Sequence[str]) -> Column:
    return F.struct(*[F.col(c) for c in order])


def neighbours(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str],
    cols: Sequence[str],
    prev: bool = True,
    nxt: bool = False,
    chunk: str = DEFAULT_CHUNK,
    prefix_prev: str = "prev_",
    prefix_next: str = "next_",
) -> DataFrame:
    """``lag``/``lead`` by one row per key, ordered by ``order`` (first = time).

    Adds ``prev_<c>`` / ``next_<c>`` for each of ``cols``; null at the ends of
    a key.  Equal to ``lag(c).over(partitionBy(keys).orderBy(order))``.
    """
    keys, order = _as_list(keys), list(order)
    chunks = plan_chunks(df, keys, order[0], chunk)
    part = keys + [_CHUNK] if chunks.split else keys
    w = Window.partitionBy(*part).orderBy(*order)
    payload, ordv = F.struct(*[F.col(c) for c in cols]), _order_struct(order)
    d, borders, across = chunks.add(df) if chunks.split else df, [], []
    wc = Window.partitionBy(*keys).orderBy(_CHUNK)
    found = {}
    for side, wanted, prefix, shift, border in (("prev", prev, prefix_prev, F.lag, F.max_by),
                                                ("next", nxt, prefix_next, F.lead, F.min_by)):
        if wanted:
            d = d.withColumn(f"__{side}", shift(payload).over(w))
            borders.append(border(payload, ordv).alias(f"__edge_{side}"))
            across.append(shift(f"__edge_{side}").over(wc).alias(f"__far_{side}"))
            found[prefix] = [f"__{side}"] + ([f"__far_{side}"] if chunks.split else [])
    if chunks.split:
        # one row per (key, chunk) with its last or first row, looked up by the chunk behind or before
        d = materialize(d, "neighbours")
        far = d.groupBy(*part).agg(*borders).select(*part, *across)
        d = join_keys(d, far, part, "left")
    out = d.withColumns({f"__found_{i}": F.coalesce(*names) for i, names in enumerate(found.values())})
    out = out.withColumns({prefix + c: F.col(f"__found_{i}")[c] for i, prefix in enumerate(found) for c in cols})
    return out.drop(*[c for c in out.columns if c.startswith(("__found_", "__far_"))], "__prev", "__next", _CHUNK)


# --- running (prefix) aggregates -----------------------------------------

_KINDS = ("sum", "count", "min", "max", "first", "last")


def running(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str],
    specs: dict[str, tuple[str, Column | str]],
    reverse: bool = False,
    include_current: bool = True,
    chunk: str = DEFAULT_CHUNK,
) -> DataFrame:
    """Running aggregates per key in ``order`` (or reverse order).

    ``specs`` maps an output name to ``(kind, expr)`` with kind one of
    sum, count, min, max, first (first non-null so far), last (last non-null
    so far).  ``include_current=False`` gives the strictly-before (or
    strictly-after when ``reverse``) scan.  ``min``/``max`` accept struct
    expressions, which gives ``min_by``/``max_by`` with a tie-break.
    """
    keys, order = _as_list(keys), list(order)
    chunks = plan_chunks(df, keys, order[0], chunk)
    d = chunks.add(df) if chunks.split else df
    part = keys + [_CHUNK] if chunks.split else keys
    ocols = [F.col(c).desc() if reverse else F.col(c).asc() for c in order]
    hi = 0 if include_current else -1
    w = Window.partitionBy(*part).orderBy(*ocols).rowsBetween(Window.unboundedPreceding, hi)
    ordv = _order_struct(order)

    within, totals, prefix = [], [], []
    for name, (kind, e) in specs.items():
        if kind not in _KINDS:
            raise ValueError(f"unknown running kind {kind}")
        e = F.col(e) if isinstance(e, str) else e
        d = d.withColumn(f"_rs_v_{name}", e)
        v = F.col(f"_rs_v_{name}")
        if kind == "sum":
            within.append(F.sum(v).over(w).alias(f"_rs_w_{name}"))
            totals.append(F.sum(v).alias(f"_rs_t_{name}"))
            prefix.append(("sum", name))
        elif kind == "count":
            within.append(F.count(v).over(w).alias(f"_rs_w_{name}"))
            totals.append(F.count(v).alias(f"_rs_t_{name}"))
            prefix.append(("sum", name))
        elif kind in ("min", "max"):
            fn = F.min if kind == "min" else F.max
            within.append(fn(v).over(w).alias(f"_rs_w_{name}"))
            totals.append(fn(v).alias(f"_rs_t_{name}"))
            prefix.append((kind, name))
        else:  # first / last non-null in scan order
            first_in_scan = (kind == "first") != reverse
            within.append(
                (F.first(v, ignorenulls=True) if kind == "first" else F.last(v, ignorenulls=True))
                .over(w).alias(f"_rs_w_{name}")
            )
            pick = F.min_by if first_in_scan else F.max_by
            totals.append(pick(v, F.when(v.isNotNull(), ordv)).alias(f"_rs_t_{name}"))
            prefix.append((kind, name))

    d = d.select("*", *within)
    if chunks.split:
        d = materialize(d, "running")
        summary = d.groupBy(*part).agg(*totals)
        wc = Window.partitionBy(*keys).orderBy(F.col(_CHUNK).desc() if reverse else F.col(_CHUNK).asc())
        wc = wc.rowsBetween(Window.unboundedPreceding, -1)
        over = {"sum": F.sum, "min": F.min, "max": F.max, "first": lambda c: F.first(c, ignorenulls=True),
                "last": lambda c: F.last(c, ignorenulls=True)}
        carried = [over[kind](F.col(f"_rs_t_{name}")).over(wc).alias(f"_rs_p_{name}") for kind, name in prefix]
        d = join_keys(d, summary.select(*part, *carried), part, "left")
    out = d
    for name, (kind, _) in specs.items():
        wv = F.col(f"_rs_w_{name}")
        pv = F.col(f"_rs_p_{name}") if chunks.split else F.lit(None)
        if kind in ("sum", "count"):
            res = F.coalesce(wv, F.lit(0)) + F.coalesce(pv, F.lit(0))
            if kind == "sum":
                res = F.when(wv.isNull() & pv.isNull(), F.lit(None)).otherwise(res)
        elif not chunks.split:
            res = wv
        elif kind == "min":
            res = F.least(wv, pv)
        elif kind == "max":
            res = F.greatest(wv, pv)
        elif kind == "first":
            res = F.coalesce(pv, wv)
        else:
            res = F.coalesce(wv, pv)
        out = out.withColumn(name, res)
    return out.drop(*[c for c in out.columns if c.startswith("_rs_") or c == _CHUNK])


def sequence_number(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str],
    name: str = "seq",
    chunk: str = DEFAULT_CHUNK,
) -> DataFrame:
    """1-based position of each row within its key (= row_number over key)."""
    return running(df, keys, order, {name: ("count", F.lit(1))}, chunk=chunk)


# --- bounded ROWS frames -------------------------------------------------


def rows_frame(
    df: DataFrame,
    keys: Sequence[str] | str,
    order: Sequence[str],
    value: str,
    preceding: int,
    aggs: Sequence[str] = ("count", "sum", "avg"),
    chunk: str = DEFAULT_CHUNK,
    prefix: str = "",
) -> DataFrame:
    """Aggregates over ``ROWS BETWEEN preceding PRECEDING AND CURRENT ROW``.

    Inside a chunk the frame is an ordinary window; the first ``preceding``
    rows of a chunk also need the last rows before it, taken from a per-chunk
    "tail" array (at most ``preceding`` values per chunk) carried forward
    over the chunk summary table.
    """
    keys, order, n = _as_list(keys), list(order), int(preceding)
    chunks = plan_chunks(df, keys, order[0], chunk)
    d = chunks.add(df) if chunks.split else df
    part = keys + [_CHUNK] if chunks.split else keys
    w = Window.partitionBy(*part).orderBy(*order)
    frame, v = w.rowsBetween(-n, 0), F.col(value)
    asked = set(aggs) | ({"sum", "count"} if "avg" in aggs else set()) | ({"count"} if "sum" in aggs else set())
    d = d.withColumns({f"__{a}_in": {"count": F.count, "sum": F.sum, "min": F.min, "max": F.max}[a](v).over(frame)
                       for a in sorted(asked - {"avg"})})
    got = {a: F.col(f"__{a}_in") for a in asked - {"avg"}}
    if chunks.split:
        # the rows before a chunk: its predecessor's last n values, and where that is shorter, those before it
        d = materialize(d.withColumn("__pos", F.row_number().over(w)), "rows-frame")
        earlier = Window.partitionBy(*keys).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
        sizes = d.groupBy(*part).agg(F.count(F.lit(1)).alias("__size")).withColumn(
            "__start", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
        # the last n rows of each chunk by their number in the key, fetched by the chunks that need them
        tails = (join_keys(d.select(*part, "__pos", v.alias("__v")), sizes, part)
                 .where(F.col("__pos") > F.col("__size") - n)
                 .select(*keys, (F.col("__start") + F.col("__pos")).alias("__num"), "__v"))
        wanted = sizes.where("__start > 0").select(*part, F.explode(F.sequence(
            F.greatest(F.lit(1), F.col("__start") - n + 1), F.col("__start"))).alias("__num"))
        halo = (join_keys(wanted, tails, [*keys, "__num"]).groupBy(*part)
                .agg(F.array_sort(F.collect_list(F.struct("__num", "__v"))).alias("__halo"))
                .select(*part, F.transform("__halo", lambda s: s["__v"]).alias("__halo")))
        d = join_keys(d, halo.select(*part, "__halo"), part, "left")
        need = F.greatest(F.lit(0), F.lit(n + 1) - F.col("__pos"))
        h = F.coalesce("__halo", F.array().cast("array<double>"))
        take = F.least(need, F.size(h))
        d = d.withColumn("__h", F.filter(F.when(take > 0, F.slice(h, F.size(h) - take + 1, take)).otherwise(
            F.array().cast("array<double>")), lambda x: x.isNotNull()))
        if "count" in got:
            got["count"] = got["count"] + F.size("__h")
        if "sum" in got:
            got["sum"] = F.coalesce(got["sum"], F.lit(0.0)) + F.aggregate("__h", F.lit(0.0), lambda a, x: a + x)
        if "min" in got:
            got["min"] = F.least(got["min"], F.array_min("__h"))
        if "max" in got:
            got["max"] = F.greatest(got["max"], F.array_max("__h"))
    res = {}
    for a in aggs:
        if a == "count":
            res[prefix + a] = got["count"].cast("long")
        elif a == "sum":
            res[prefix + a] = F.when(got["count"] > 0, got["sum"])
        elif a == "avg":
            res[prefix + a] = F.when(got["count"] > 0, got["sum"] / got["count"])
        else:
            res[prefix + a] = got[a]
    out = d.withColumns(res)
    return out.drop(*[c for c in out.columns if c.startswith("__")])
