"""Two-input operators: interval join, window join, co-group, connect/union, as-of.

The interval join is the workhorse (J4, D13, D14, D20).  Spark has no range
join; the plain plan ``key = key AND ts BETWEEN ...`` sort-merges on the key
alone, so a hot key becomes one task comparing all its rows pairwise.  Here
both sides also carry a time bucket: the right row lands in the one bucket
holding its time, the left row in the few buckets its interval touches.  The
equi-join on (key, bucket) splits every key along its timeline, and the
candidates tested per left row are about the true matches times
``1 + span / bucket``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timefns import duration_us, epoch_us
from tidemark.operators.keys import join_keys
from tidemark.operators.sequence import DEFAULT_CHUNK, running, sequence_number

_B = "__ijb"


def interval_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    lower: str | int,
    upper: str | int,
    how: str = "inner",
    left_id: str | None = None,
    right_id: str | None = None,
    bucket: str | int | None = None,
    lower_open: bool = False,
    upper_open: bool = False,
) -> DataFrame:
    """Rows with equal keys and ``right_ts`` in ``[left_ts + lower, left_ts + upper]``.

    Ends are closed unless ``lower_open``/``upper_open``.  Column names of the
    two sides must be distinct except for ``keys``.  ``how`` is inner, left,
    right or full.

    One side keeps each row in its own time bucket; the other side is copied
    to every bucket its interval touches, so each matching pair meets in
    exactly one bucket.  For an outer side that side is the one kept whole,
    which makes Spark's own outer join exact; a full join is the left join
    plus the right rows found by an anti join.  (``left_id``/``right_id`` are
    accepted for compatibility and not needed.)
    """
    del left_id, right_id
    keys = list(keys)
    lo, hi = duration_us(lower), duration_us(upper)
    if hi < lo:
        raise ValueError("upper bound below lower bound")
    if how not in ("inner", "left", "right", "full"):
        raise ValueError(f"unsupported interval join kind {how}")
    width = duration_us(bucket) if bucket else max(hi - lo, 1_000_000)
    W = F.lit(width)
    l_us = epoch_us(left, left_ts)
    r_us = epoch_us(right, right_ts)
    rk = {k: f"__rk_{k}" for k in keys}
    right_r = right.select(*[F.col(c).alias(rk.get(c, c)) for c in right.columns])

    def home(df, us, name):
        return df.withColumn(name, F.floor(us / W))

    def copies(df, us, a, b, name):          # buckets of [us + a, us + b]
        return df.withColumn(name, F.explode(F.sequence(F.floor((us + F.lit(a)) / W),
                                                        F.floor((us + F.lit(b)) / W))))

    lts, rts = F.col(left_ts), F.col(right_ts)
    lower_t = lts + F.make_dt_interval(secs=F.lit(lo / 1_000_000))
    upper_t = lts + F.make_dt_interval(secs=F.lit(hi / 1_000_000))
    cond = (rts > lower_t) if lower_open else (rts >= lower_t)
    cond = cond & ((rts < upper_t) if upper_open else (rts <= upper_t))
    cond = cond & (F.col(_B) == F.col("__rb"))
    for k in keys:
        cond = cond & (F.col(k) == F.col(rk[k]))

    out_cols = left.columns + [c for c in right.columns if c not in keys]

    def finish(j):
        sel = []
        for c in out_cols:
            if c in rk:
                sel.append(F.coalesce(F.col(c), F.col(rk[c])).alias(c))
            else:
                sel.append(F.col(c))
        return j.select(*sel)

    if how == "inner":
        j = copies(left, l_us, lo, hi, _B).join(home(right_r, r_us, "__rb"), cond, "inner")
        return finish(j)
    if how == "right":
        j = copies(left, l_us, lo, hi, _B).join(home(right_r, r_us, "__rb"), cond, "right")
        return finish(j)
    # left / full: left rows stay in their own bucket, right rows are copied
    j = home(left, l_us, _B).join(copies(right_r, r_us, -hi, -lo, "__rb"), cond, "left")
    res = finish(j)
    if how == "full":
        ronly = home(right_r, r_us, "__rb").join(copies(left, l_us, lo, hi, _B), cond, "left_anti")
        ronly = ronly.select(*[F.col(rk.get(c, c)).alias(c) for c in right.columns])
        res = res.unionByName(_pad(ronly, out_cols))
    return res


def _pad(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    have = set(df.columns)
    return df.select(*[F.col(c) if c in have else F.lit(None).alias(c) for c in cols])


def window_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    left_ts: str,
    right_ts: str,
    size: str,
    slide: str | None = None,
) -> DataFrame:
    """Pairs with equal keys inside the same window; never across an edge."""
    lw = F.window(left_ts, size, slide) if slide else F.window(left_ts, size)
    rw = F.window(right_ts, size, slide) if slide else F.window(right_ts, size)
    l2 = left.withColumn("__w", lw).withColumn("window_start", F.col("__w.start")).withColumn(
        "window_end", F.col("__w.end")).drop("__w")
    r2 = right.withColumn("__w", rw).withColumn("window_start", F.col("__w.start")).withColumn(
        "window_end", F.col("__w.end")).drop("__w")
    return l2.join(r2, on=list(keys) + ["window_start", "window_end"], how="inner")


def cogroup_rows(left: DataFrame, right: DataFrame, keys: Sequence[str], order: Sequence[str],
                 chunk: str = DEFAULT_CHUNK) -> DataFrame:
    """The rows of both sides of each group, side by side: row i of the left beside row i of the right.

    Each side is numbered within its group in the order ``order``, a total order that both have
    (by chunks where a group is hot), and the sides meet on (group, number): a group is
    never an array or a task.  Either side may be shorter or empty: its columns are null.  A
    null key is a key.  Columns: ``keys``, ``seq`` (from 1), the other columns as
    ``left_<name>`` and ``right_<name>``.
    """
    keys = list(keys)
    sides = []
    for df, name in ((left, "left"), (right, "right")):
        rest = [c for c in df.columns if c not in keys]
        numbered = sequence_number(df, keys, list(order), "__seq", chunk=chunk)
        sides.append(numbered.select(*keys, F.col("__seq").alias("seq"), *[F.col(c).alias(f"{name}_{c}") for c in rest]))
    return join_keys(*sides, [*keys, "seq"], "full")


def connect(*sides: tuple[DataFrame, str]) -> DataFrame:
    """Union of differently shaped inputs, tagged with their origin."""
    out = None
    for df, tag in sides:
        t = df.withColumn("source", F.lit(tag))
        out = t if out is None else out.unionByName(t, allowMissingColumns=True)
    return out


def asof_latest(
    facts: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    ts: str,
    order: Sequence[str],
    value_cols: Sequence[str],
    chunk: str = DEFAULT_CHUNK,
) -> DataFrame:
    """Attach to every fact the latest update at or before it, per key.

    Both sides go into one tagged union, ordered by ``order`` (ts first; on
    equal order the update wins, so the tie-break column must put updates
    first).  The carry-forward is the chunked running "last non-null", so a
    key with a third of all rows is still split over many tasks.
    """
    keys = list(keys)
    f = facts.withColumn("__is_fact", F.lit(True))
    u = updates.select(*keys, *order, *value_cols).withColumn("__is_fact", F.lit(False))
    union = f.unionByName(u, allowMissingColumns=True)
    specs = {
        f"__latest_{c}": ("last", F.when(~F.col("__is_fact"), F.struct(F.lit(1).alias("set"), F.col(c).alias("v"))))
        for c in value_cols
    }
    scanned = running(union, keys, order, specs, chunk=chunk)
    out = scanned.where("__is_fact")
    for c in value_cols:
        out = out.withColumn(c, F.col(f"__latest_{c}.v"))
    return out.drop("__is_fact", *[f"__latest_{c}" for c in value_cols])


def lateral_split(
    df: DataFrame, col: str, sep: str, outer: bool = False, word: str = "word", length: str = "length"
) -> DataFrame:
    """J8/U2 native form: one (word, length) row per piece; ``outer`` keeps empty inputs."""
    parts = F.split(F.col(col), sep)
    ex = F.explode_outer(parts) if outer else F.explode(parts)
    out = df.withColumn(word, ex)
    return out.withColumn(length, F.length(word))
