"""Keyed stateful processors for Structured Streaming.

All but one are :class:`tidemark.streaming.keyed.KeyedSequence`: their ``advance_all`` gets the
rows of many keys in event-time order and works on whole columns where the rule allows it.
"""

from __future__ import annotations

import sys
from collections import deque
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql.streaming.stateful_processor import (
    StatefulProcessor,
    StatefulProcessorHandle,
    TimerValues,
)

from tidemark.streaming.keyed import NO_TIME, KeyedSequence, before, firsts, from_micros, lasts, per_key

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # see keyed.py

DAY = 86_400_000_000


def _slices(rows: pd.DataFrame, columns: list[str]) -> Iterator[tuple]:
    """Per key its number and its rows' values of the columns, as lists."""
    k = rows["k"].to_numpy()
    starts = np.flatnonzero(firsts(k)).tolist()
    values = [rows[c].tolist() for c in columns]
    for a, b in zip(starts, [*starts[1:], len(k)]):
        yield int(k[a]), [v[a:b] for v in values]


def _filled(values: pd.Series, k: pd.Series, entered: np.ndarray) -> np.ndarray:
    """The key's last value up to each row that is there, else that of ``entered``."""
    out = values.groupby(k).ffill().to_numpy(copy=True)
    none = np.isnan(out)
    out[none] = entered[k.to_numpy()[none]]
    return out


# --- D15 / D22 / T11 / T14: temperature jump ------------------------------------


class TemperatureJump(KeyedSequence):
    """Alert when |temp - last temp| > threshold; first reading never alerts.

    With ``max_silence`` (us) a reading after a longer silence counts as the first one, and
    the state is dropped when the clock has passed that silence (D22, state clean-up).  With
    ``ttl_ms`` idle state expires by itself (T14; needs the processing clock).
    Output: sensor_id, ts, last_temp, temperature.
    """

    state = {"temp": "float64", "at": "int64", "seen": "int64"}

    def __init__(self, threshold: float, max_silence: int | None = None, order=("event_id",),
                 ttl_ms: int | None = None, **clock):
        super().__init__({"temperature": "double", **{c: "long" for c in order}, "at": "long"}, order, **clock)
        self.threshold, self.silence, self.ttl = threshold, max_silence, ttl_ms

    def advance_all(self, rows, state, keys, now):
        if self.ttl:  # the store forgets a bucket that is idle as a whole
            state = state[state["seen"] + self.ttl * 1000 > now]
        k, temp, at = (rows[c].to_numpy() for c in ("k", "temperature", "at"))
        prev = before(temp, k, per_key(state, "temp", len(keys), np.nan))
        with np.errstate(invalid="ignore"):
            hit = np.abs(temp - prev) > self.threshold  # false where there is none before
            if self.silence is not None:
                prev_at = before(at.astype("float64"), k, per_key(state, "at", len(keys), np.nan))
                hit &= at <= prev_at + self.silence
        out = pd.DataFrame({"k": k[hit], "ts": from_micros(at[hit]), "last_temp": prev[hit], "temperature": temp[hit]})
        last = lasts(k)
        state = pd.concat([state[~state["k"].isin(k[last])],
                           pd.DataFrame({"k": k[last], "temp": temp[last], "at": at[last], "seen": now})])
        return out, state if self.silence is None else state[state["at"] + self.silence >= now]

    def deadline(self, state):
        return None if self.silence is None else int(state["at"].min()) + self.silence + 1


# --- D8: click-fraud filter ---------------------------------------------------


class ClickFraudFilter(KeyedSequence):
    """Per (user, ad): pass the first ``max_clicks`` clicks of each UTC day, warn once, drop the
    rest.  Counts are kept per day, so without holding rows a late click still counts on its
    own day; a day is forgotten when the watermark has passed its end.
    Output: the columns ``cols`` (a time column among them is ``ts``) plus ``status``.
    """

    state = {"day": "int64", "n": "int64"}

    def __init__(self, max_clicks: int, cols: dict[str, str], keys: list[str], order=("event_id",), **clock):
        fields = {c: t for c, t in cols.items() if c != "ts" and c not in keys} | {c: "long" for c in order}
        super().__init__(fields, order, **clock)
        self.max, self.cols = max_clicks, [c for c in cols if c == "ts" or c in fields]

    def advance_all(self, rows, state, keys, now):
        new = pd.DataFrame({"k": rows["k"], "day": rows["us"] // DAY})
        seen = new.merge(state, "left", ["k", "day"])["n"].fillna(0).to_numpy("int64")
        n = seen + new.groupby(["k", "day"]).cumcount().to_numpy() + 1
        out = pd.DataFrame({"k": rows["k"], **{c: from_micros(rows["us"]) if c == "ts" else rows[c] for c in self.cols}})
        out["status"] = np.select([n <= self.max, n == self.max + 1], ["pass", "warn"], "drop")
        state = pd.concat([state, new.assign(n=1)]).groupby(["k", "day"], as_index=False)["n"].sum()
        return out, state[(state["day"] + 1) * DAY > now]

    def deadline(self, state):
        return (int(state["day"].min()) + 1) * DAY


# --- D9: login failures -------------------------------------------------------


class LoginFailState(KeyedSequence):
    """A fail less than ``gap`` (us) after the row before it warns if that was a fail too.
    Output: user_id, first_fail_time, last_fail_time."""

    state = {"us": "int64"}

    def __init__(self, gap: int, fail: str = "fail", order=("event_id",), **clock):
        super().__init__({"event_type": "string", **{c: "long" for c in order}}, order, **clock)
        self.gap, self.fail = gap, fail

    def advance_all(self, rows, state, keys, now):
        k = rows["k"].to_numpy()
        fails = rows["us"].where(rows["event_type"] == self.fail).to_numpy("float64")
        first = before(fails, k, per_key(state, "us", len(keys), np.nan))
        hit = fails < first + self.gap  # false where either is no fail
        last = lasts(k)
        state = pd.concat([state[~state["k"].isin(k[last])],
                           pd.DataFrame({"k": k[last], "us": rows["us"].to_numpy()[last]})[~np.isnan(fails[last])]])
        return pd.DataFrame({"k": k[hit], "first_fail_time": from_micros(first[hit].astype("int64")),
                             "last_fail_time": from_micros(rows["us"].to_numpy()[hit])}), state


# --- D21 / J7: thresholds from a rule stream -------------------------------------


class DynamicThreshold(KeyedSequence):
    """Readings and rule updates of one sensor in one tagged union (``kind`` = reading | rule).
    A rule sets the sensor's threshold (0.0 deletes it); a reading alerts when |temp - last
    temp| exceeds it.  The last temperature starts at 0.0.
    Output: sensor_id, event_id, temperature, threshold, temp_diff."""

    state = {"threshold": "float64", "last": "float64"}

    def __init__(self, order=("event_id",), **clock):
        super().__init__({"kind": "string", "value": "double", **{c: "long" for c in order}}, order, **clock)

    def advance_all(self, rows, state, keys, now):
        threshold, last = (per_key(state, c, len(keys), 0.0) for c in ("threshold", "last"))
        rule = (rows["kind"] == "rule").to_numpy()
        k = rows["k"].to_numpy()
        limit = _filled(rows["value"].where(rule), rows["k"], threshold)
        end = lasts(k)
        threshold[k[end]] = limit[end]
        reading, k, limit = rows[~rule], k[~rule], limit[~rule]
        temp = reading["value"].to_numpy()
        diff = np.abs(temp - before(temp, k, last))
        end = lasts(k)
        last[k[end]] = temp[end]
        hit = (limit != 0.0) & (diff > limit)
        return (pd.DataFrame({"k": k[hit], "event_id": reading["event_id"].to_numpy()[hit], "temperature": temp[hit],
                              "threshold": limit[hit], "temp_diff": pd.Series(diff[hit]).round(4)}),
                pd.DataFrame({"k": np.arange(len(keys)), "threshold": threshold, "last": last}))


# --- J3: switch gate (event or processing clock) ----------------------------------


class SwitchGate(KeyedSequence):
    """Forwards a key's facts while its latest switch row is less than ``duration`` (us) old.

    A deadline closes the gate: an event-time timer, or a processing-time timer when the
    processing clock drives it.  Output: the fact's id, key, time and the opening time."""

    state = {"us": "int64"}

    def __init__(self, duration: int, order=("event_id",), **clock):
        super().__init__({"kind": "string", **{c: "long" for c in order}}, order, **clock)
        self.duration = duration

    def advance_all(self, rows, state, keys, now):
        k, us = rows["k"].to_numpy(), rows["us"].to_numpy()
        switch = (rows["kind"] == "switch").to_numpy()
        opened = per_key(state, "us", len(keys), np.nan)
        since = _filled(rows["us"].astype("float64").where(switch), rows["k"], opened)
        hit = ~switch & (us < since + self.duration)
        end = lasts(k)
        opened[k[end]] = since[end]
        open_ = np.flatnonzero(now < opened + self.duration)
        return (pd.DataFrame({"k": k[hit], "event_id": rows["event_id"].to_numpy()[hit], "ts": from_micros(us[hit]),
                              "opened_at": from_micros(since[hit].astype("int64"))}),
                pd.DataFrame({"k": open_, "us": opened[open_].astype("int64")}))

    def deadline(self, state):
        return int(state["us"].min()) + self.duration


# --- W5: count windows ----------------------------------------------------------


class CountWindow(KeyedSequence):
    """``countWindow(size, slide)``: at every ``slide``-th row of a key, the last ``size`` rows.

    The state is the key's last ``size`` values with their numbers.  Output: the key,
    fire_at_row, count, sum, min, max."""

    state = {"seq": "int64", "value": "float64"}
    #: Values gathered at once.
    CELLS = 1 << 22

    def __init__(self, size: int, slide: int, key_name: str, order=("event_id",), **clock):
        super().__init__({"value": "double", **{c: "long" for c in order}}, order, **clock)
        self.size, self.slide, self.key_name = size, slide, key_name

    def advance_all(self, rows, state, keys, now):
        seen = np.zeros(len(keys), "int64")
        np.maximum.at(seen, state["k"].to_numpy(), state["seq"].to_numpy())
        fresh = pd.DataFrame({"k": rows["k"], "value": rows["value"],
                              "seq": seen[rows["k"].to_numpy()] + rows.groupby("k").cumcount() + 1})
        both = pd.concat([state.assign(new=False), fresh.assign(new=True)], ignore_index=True)
        both = both.take(np.lexsort([both["seq"].to_numpy(), both["k"].to_numpy()]))
        k, seq, values = (both[c].to_numpy() for c in ("k", "seq", "value"))
        fires = np.flatnonzero(both["new"].to_numpy() & (seq % self.slide == 0))
        length = np.minimum(seq[fires], self.size)
        done = {c: np.empty(len(fires)) for c in ("sum", "min", "max")}
        for n in np.unique(length):  # frames of equal length are the rows of a matrix
            of_n, step = np.flatnonzero(length == n), max(1, self.CELLS // int(n))
            for i in range(0, len(of_n), step):
                some = of_n[i:i + step]
                frames = values[fires[some][:, None] + np.arange(1 - n, 1)]
                done["sum"][some], done["min"][some], done["max"][some] = (
                    frames.sum(axis=1), frames.min(axis=1), frames.max(axis=1))
        end = np.bincount(k, minlength=len(keys)).cumsum()[k] if len(k) else k
        keep = end - np.arange(len(k)) <= self.size
        return (pd.DataFrame({"k": k[fires], "fire_at_row": seq[fires], "count": length, **done}),
                pd.DataFrame({"k": k[keep], "seq": seq[keep], "value": values[keep]}))


# --- W8: triggers -----------------------------------------------------------------


class CountTrigger:
    """Fires a window after every ``every`` rows, and its rest at its end.  ``purge``: what was
    fired is forgotten, so firings add up; otherwise each firing is the whole window so far."""

    def __init__(self, every: int, purge: bool):
        self.every, self.purge = every, purge


class TriggeredWindow(KeyedSequence):
    """Tumbling windows of ``size`` (us) with a trigger per element, keyed by (key, window start).

    Rows come in event-time order, so the firings do not depend on the micro-batches.
    Output: the key, window_start, firing (1, 2, ...), count, sum."""

    state = {"end": "int64", "n": "int64", "pending": "int64", "sum": "float64", "fired": "int64"}

    def __init__(self, size: int, trigger: CountTrigger, order=("event_id",), **clock):
        super().__init__({"value": "double", **{c: "long" for c in order}}, order, **clock)
        self.size, self.trigger = size, trigger

    def advance_all(self, rows, state, keys, now):
        ends = (keys["key1__"] + self.size).tolist()
        windows = {r[0]: list(r[1:]) for r in state[["k", "n", "pending", "sum", "fired"]].itertuples(index=False)}
        out = []

        def fire(k: int, w: list) -> None:
            w[3] += 1
            out.append((k, w[3], w[0], w[2]))
            w[1] = 0
            if self.trigger.purge:
                w[0], w[2] = 0, 0.0

        for k, (values,) in _slices(rows, ["value"]):
            w = windows.setdefault(k, [0, 0, 0.0, 0])
            for v in values:
                w[0], w[1], w[2] = w[0] + 1, w[1] + 1, w[2] + v
                if w[1] == self.trigger.every:
                    fire(k, w)
        for k, w in windows.items():
            if now >= ends[k] and w[1]:
                fire(k, w)
        left = [(k, ends[k], *w) for k, w in windows.items() if now < ends[k]]
        return (pd.DataFrame(out, columns=["k", "firing", "count", "sum"]),
                pd.DataFrame(left, columns=["k", *self.state]))

    def deadline(self, state):
        return int(state["end"].min())


# --- T9: reducing and aggregating state ---------------------------------------


class RunningStatistics(KeyedSequence):
    """Per sensor the minimum so far (reducing state) and the mean so far (aggregating state:
    count and sum).  A batch is folded with cumulative operations, not row by row.
    Output: event_id, sensor_id, min_temp, n, total, avg_temp."""

    state = {"least": "float64", "n": "int64", "sum": "float64"}
    no_time_last = True

    def __init__(self, order=("event_id",)):
        super().__init__({"temperature": "double", **{c: "long" for c in order}}, order, hold=False, clock="none")

    def advance_all(self, rows, state, keys, now):
        k, groups = rows["k"].to_numpy(), rows.groupby("k")
        least = np.fmin(groups["temperature"].cummin(), per_key(state, "least", len(keys), np.nan)[k])
        least = least.where(rows["temperature"].notna())
        n = groups.cumcount() + 1 + per_key(state, "n", len(keys), 0)[k]
        sums = groups["temperature"].cumsum() + per_key(state, "sum", len(keys), 0.0)[k]
        end = lasts(k)
        new = pd.DataFrame({"k": k, "least": least, "n": n, "sum": sums})[end]
        return (pd.DataFrame({"k": k, "event_id": rows["event_id"], "min_temp": least, "n": n, "total": sums,
                              "avg_temp": sums / n}),
                pd.concat([state[~state["k"].isin(new["k"])], new]))


# --- T13: a running count as a retract stream -------------------------------------


class RunningCount(StatefulProcessor):
    """Per micro-batch and key: the old count taken back, the new one added.
    Output: flag, the keys, the count."""

    def __init__(self, keys: list[str], name: str):
        self.keys, self.name = keys, name

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key, rows, timerValues: TimerValues):
        old = self.count.get()[0] if self.count.exists() else 0
        new = old + sum(len(r) for r in rows)
        self.count.update((new,))
        out = [(True, *key, new)] + ([(False, *key, old)] if old else [])
        yield pd.DataFrame(out, columns=["flag", *self.keys, self.name])

    def close(self) -> None:
        pass


# --- D12: order pay check with timers ----------------------------------------


class PaymentCheck(KeyedSequence):
    """One order's creation and payment, judged by their own times like the
    batch twin, in whichever order they arrive.

    A lone creation is kept for ``timeout_ms`` plus ``grace_ms`` (so a payment
    that is too late is still recognised), a lone payment for ``grace_ms``;
    then it is reported as missing its partner.  Times are milliseconds.
    Output: order_id, result_msg."""

    state = {"create": "float64", "pay": "float64"}
    no_time_last = True

    def __init__(self, timeout_ms: int, grace_ms: int, order=("seq",)):
        super().__init__({"event_type": "string", **{c: "long" for c in order}}, order, hold=False)
        self.timeout, self.grace = timeout_ms, grace_ms

    def advance_all(self, rows, state, keys, now):
        ms = {c: per_key(state, c, len(keys), np.nan) for c in self.state}
        for c in self.state:
            own = rows[rows["event_type"] == c]
            first = own[firsts(own["k"].to_numpy())]
            k, us = first["k"].to_numpy(), first["us"].to_numpy()
            ms[c][k] = np.where(np.isnan(ms[c][k]), us // 1000, ms[c][k])
        created, paid = ms["create"], ms["pay"]
        both = ~np.isnan(created) & ~np.isnan(paid)
        verdict = np.select([paid < created, paid < created + self.timeout], ["payed", "payed successfully"],
                            "payed but already timeout")
        due = ~both & (self._due(created, paid) <= now // 1000)
        alone = np.where(np.isnan(created), "already payed but not found create log", "order timeout")
        done = np.flatnonzero(both | due)
        left = np.flatnonzero(~both & ~due & ~(np.isnan(created) & np.isnan(paid)))
        return (pd.DataFrame({"k": done, "result_msg": np.where(both, verdict, alone)[done]}),
                pd.DataFrame({"k": left, "create": created[left], "pay": paid[left]}))

    def _due(self, created: np.ndarray, paid: np.ndarray) -> np.ndarray:
        return np.where(np.isnan(created), paid + self.grace, created + self.timeout + self.grace)

    def deadline(self, state):
        return int(self._due(state["create"].to_numpy(), state["pay"].to_numpy()).min()) * 1000


# --- D13 / J2: two-input reconciliation ---------------------------------------


def _count_below(k: np.ndarray, us: np.ndarray, at_k: np.ndarray, at: np.ndarray, equal: bool) -> np.ndarray:
    """How many of the pairs (k, us) lie before each (at_k, at), or also ``equal`` to it."""
    n = len(k)
    asked = np.r_[np.zeros(n, bool), np.ones(len(at), bool)]
    order = np.lexsort([asked if equal else ~asked, np.r_[us, at], np.r_[k, at_k]])
    below = np.empty(len(asked), "int64")
    below[order] = np.cumsum(~asked[order])
    return below[n:]


class TxMatch(KeyedSequence):
    """Payments and receipts of one transaction (tagged union, ``side`` in {pay, receipt}).

    Every payment and receipt at most ``bound`` (us) apart match, whichever comes first and
    however often an id repeats: the interval join's result.  Each row is kept until the
    watermark has passed its own time plus ``bound``; if nothing matched it by then, it is
    reported unmatched.  Output: tx_id, pay_time, receipt_time, tag.
    """

    SIDES = ("pay", "receipt")
    state = {"receipt": "bool", "us": "int64", "matched": "bool"}

    def __init__(self, bound: int, order=("seq",)):
        super().__init__({"side": "string", **{c: "long" for c in order}}, order, hold=False)
        self.bound = bound

    def _pairs(self, one: pd.DataFrame, two: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        """Indexes of all pairs of a key at most ``bound`` apart; ``two`` comes by (k, us)."""
        k, us = one["k"].to_numpy(), one["us"].to_numpy()
        at_k, at = two["k"].to_numpy(), two["us"].to_numpy()
        lo = _count_below(at_k, at, k, us - self.bound, False)
        n = np.where(us == NO_TIME, 0, _count_below(at_k, at, k, us + self.bound, True) - lo)
        i = np.repeat(np.arange(len(one)), n)
        return i, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)

    def advance_all(self, rows, state, keys, now):
        fresh = pd.DataFrame({"k": rows["k"], "receipt": rows["side"] == "receipt", "us": rows["us"], "matched": False})
        both = pd.concat([state.assign(new=False), fresh.assign(new=True)], ignore_index=True)
        both = both.take(np.lexsort([both["us"].to_numpy(), both["k"].to_numpy()])).reset_index(drop=True)
        pays, receipts = both[~both["receipt"]], both[both["receipt"]]
        new = both["new"].to_numpy()
        i, j = self._pairs(pays, receipts)
        i, j = pays.index.to_numpy()[i], receipts.index.to_numpy()[j]
        fresh_pair = new[i] | new[j]  # the others were given out before
        i, j = i[fresh_pair], j[fresh_pair]
        k, us, matched = (both[c].to_numpy(copy=True) for c in ("k", "us", "matched"))
        matched[i] = matched[j] = True
        done = us + self.bound <= now
        parts = [(k[i], us[i], us[j], "matched")]
        for tag, side in (("unmatched_pay", ~both["receipt"].to_numpy()), ("unmatched_receipt", both["receipt"].to_numpy())):
            lost = done & ~matched & side
            none = np.full(lost.sum(), NO_TIME)
            times = (us[lost], none) if tag == "unmatched_pay" else (none, us[lost])
            parts.append((k[lost], *times, tag))
        out = pd.DataFrame({"k": np.concatenate([p[0] for p in parts]),
                            "pay_time": from_micros(np.concatenate([p[1] for p in parts])),
                            "receipt_time": from_micros(np.concatenate([p[2] for p in parts])),
                            "tag": np.repeat([p[3] for p in parts], [len(p[0]) for p in parts])})
        return out, both.assign(matched=matched)[~done]

    def deadline(self, state):
        return int(state["us"].min()) + self.bound


# --- D16: continuous rise with timers ----------------------------------------


class ContinuousRise(KeyedSequence):
    """Warn when the temperature keeps rising (equal keeps going) for ``duration_ms``; a fall
    cancels the timer, a fired timer re-arms on the next rise.  A timer that is due fires
    before the next row of the key.  Times are milliseconds, as timers are.
    Output: sensor_id, alert_time."""

    state = {"last": "float64", "timer": "int64"}

    def __init__(self, duration_ms: int, order=("event_id",), **clock):
        super().__init__({"temperature": "double", **{c: "long" for c in order}}, order, **clock)
        self.duration = duration_ms

    def advance_all(self, rows, state, keys, now):
        last = dict(zip(state["k"].tolist(), state["last"].tolist()))
        timers = per_key(state, "timer", len(keys), 0).astype("int64")
        alerts = []
        for k, (times, temps) in _slices(rows, ["us", "temperature"]):
            prev, timer = last.get(k), int(timers[k])
            for us, t in zip(times, temps):
                ms = us // 1000
                if timer and timer < ms:
                    alerts.append((k, timer))
                    timer = 0
                if prev is not None and t > prev and not timer:
                    timer = ms + self.duration
                elif prev is not None and t < prev:
                    timer = 0
                prev = t
            last[k], timers[k] = prev, timer
        due = np.flatnonzero((timers != 0) & ((timers + 1) * 1000 <= now))
        alerts += zip(due.tolist(), timers[due].tolist())
        timers[due] = 0
        out = pd.DataFrame(alerts, columns=["k", "ms"], dtype="int64")
        k = np.fromiter(last.keys(), "int64", len(last))
        return (pd.DataFrame({"k": out["k"], "alert_time": from_micros(out["ms"] * 1000)}),
                pd.DataFrame({"k": k, "last": np.fromiter(last.values(), "float64", len(last)), "timer": timers[k]}))

    def deadline(self, state):
        armed = state["timer"][state["timer"] != 0]
        return (int(armed.min()) + 1) * 1000 if len(armed) else None


# --- C8: event-time patterns of any number of stages -------------------------------


class _Part:
    """An event that plays one stage; ``then`` is the event that took the next stage."""

    __slots__ = ("stage", "us", "ident", "then", "earlier", "live")

    def __init__(self, stage: int, us: int, ident):
        self.stage, self.us, self.ident = stage, us, ident
        self.then: _Part | None = None
        self.earlier: list[_Part] = []
        self.live = True

    def top(self) -> "_Part":
        p = self
        while p.then is not None:
            p = p.then
        return p


class PatternMatcher(KeyedSequence):
    """``begin(s0).{next|followedBy}(s1)...[.within(d)]`` over rows in event-time order.

    One automaton per key.  Per stage it keeps the partial matches that wait for it; the
    first row that meets a ``followedBy`` stage takes it for all of them, a ``next`` stage
    must be met by the very next row or its partial matches are gone.  Partial matches that
    share an event share it as one node, with the matches that led to it below it, so state
    grows with the events and not with the combinations.  A match must end less than
    ``within`` (us) after its start; a partial match still waiting then is reported once
    (``emit_timeouts``) with what it has.

    ``meets`` holds one bit per stage, computed by Spark before the rows are grouped.
    Output: key, (<stage>_id, <stage>_ts) per stage, matched.
    """

    def __init__(self, names: list[str], contiguity: list[str], within: int | None, key_name: str,
                 id_type: str = "long", emit_timeouts: bool = False, **clock):
        super().__init__({"meets": "long", "ident": id_type}, ("ident",), **clock)
        if any(c not in ("next", "followedBy") for c in contiguity[1:]):
            raise ValueError(f"unknown contiguity in {contiguity}")
        self.names, self.contiguity, self.within = names, contiguity, within
        self.key_name, self.emit_timeouts = key_name, emit_timeouts
        ident = "int64" if id_type in ("long", "bigint", "int") else "object"
        self.state = {"node": "int64", "then": "int64", "stage": "int64", "us": "int64", "ident": ident}

    def open(self, handle):
        """The parts of one key alone, for :meth:`advance`."""
        self.parts = handle.getListState("parts", "node long, then long, stage int, us long, ident long")

    def _load(self, rows: list[tuple]) -> tuple[deque, list[dict[int, _Part]]]:
        """Starts by time, and per stage the events whose partial matches wait for it."""
        nodes = {n: _Part(stage, us, ident) for n, _, stage, us, ident in rows}
        waiting: list[dict[int, _Part]] = [{} for _ in range(len(self.names) + 1)]
        for n, then, stage, _, _ in rows:
            if then >= 0:
                nodes[n].then = nodes[then]
                nodes[then].earlier.append(nodes[n])
            else:
                waiting[stage + 1][id(nodes[n])] = nodes[n]
        starts = sorted((p for p in nodes.values() if p.stage == 0), key=lambda p: p.us)
        return deque(starts), waiting

    def _save(self, waiting: list[dict[int, _Part]]) -> list[tuple]:
        rows = []

        def walk(p: _Part, then: int) -> None:
            n = len(rows)
            rows.append((n, then, p.stage, p.us, p.ident))
            for e in p.earlier:
                if e.live:
                    walk(e, n)

        for group in waiting:
            for p in group.values():
                walk(p, -1)
        return rows

    def _chains(self, p: _Part) -> Iterator[list[_Part]]:
        if p.stage == 0:
            if p.live:
                yield [p]
        else:
            for e in p.earlier:
                for chain in self._chains(e):
                    yield [*chain, p]

    def _follow(self, parts: list[tuple], times: list, bits: list, idents: list, now: int
                ) -> tuple[list[tuple[list[_Part], bool]], list[tuple]]:
        """One key's automaton over its next rows: (chain, matched) found, and the parts left."""
        starts, waiting = self._load(parts)
        found: list[tuple[list[_Part], bool]] = []
        last = len(self.names) - 1

        def waits(p: _Part) -> bool:
            top = p.top()
            return id(top) in waiting[top.stage + 1]

        def expire(time: int) -> None:
            while self.within is not None and starts and starts[0].us + self.within <= time:
                p = starts.popleft()
                if not waits(p):
                    continue
                chain = [p]
                while chain[-1].then is not None:
                    chain.append(chain[-1].then)
                if self.emit_timeouts:
                    found.append((chain, False))
                p.live = False
                for later in chain[1:]:
                    later.live = any(e.live for e in later.earlier)
                if not chain[-1].live:
                    del waiting[chain[-1].stage + 1][id(chain[-1])]

        for us, meets, ident in zip(times, bits, idents):
            expire(us)
            for stage in range(last, 0, -1):
                group = waiting[stage]
                if not group:
                    continue
                if meets >> stage & 1:
                    node = _Part(stage, us, ident)
                    node.earlier = list(group.values())
                    for p in node.earlier:
                        p.then = node
                    waiting[stage] = {}
                    if stage == last:
                        found += [(chain, True) for chain in self._chains(node)]
                    else:
                        waiting[stage + 1][id(node)] = node
                elif self.contiguity[stage] == "next":
                    waiting[stage] = {}
            if meets & 1:
                start = _Part(0, us, ident)
                starts.append(start)
                if last:
                    waiting[1][id(start)] = start
                else:
                    found.append(([start], True))
        expire(now)
        return found, self._save(waiting)

    def _matches(self, found: list[tuple[list[_Part], bool]]) -> pd.DataFrame:
        out: dict[str, list] = {}
        for i, name in enumerate(self.names):
            ids = [c[i].ident if i < len(c) else None for c, _ in found]
            out[f"{name}_id"] = pd.Series(ids, dtype="Int64" if self.state["ident"] == "int64" else object)
            out[f"{name}_ts"] = from_micros([c[i].us if i < len(c) else None for c, _ in found])
        out["matched"] = [m for _, m in found]
        return pd.DataFrame(out)

    def advance(self, key, rows: pd.DataFrame, now: int) -> tuple[pd.DataFrame, int | None]:
        """One key alone, its parts in the state of :meth:`open`; the output and the next deadline."""
        parts = list(self.parts.get()) if self.parts.exists() else []
        found, parts = self._follow(parts, *(rows[c].tolist() for c in ("us", "meets", "ident")), now)
        self.parts.clear()
        if parts:
            self.parts.put(parts)
        first = min((us for _, _, stage, us, _ in parts if stage == 0), default=None)
        due = None if self.within is None or first is None else first + self.within
        return self._matches(found).assign(**{self.key_name: key}), due

    def advance_all(self, rows, state, keys, now):
        touched = np.zeros(len(keys), bool)
        touched[rows["k"].to_numpy()] = True
        if self.within is not None:
            start = state[state["stage"] == 0]
            touched[start["k"].to_numpy()[start["us"].to_numpy() + self.within <= now]] = True
        idle = state[~touched[state["k"].to_numpy()]]
        state = state[touched[state["k"].to_numpy()]].sort_values("k", kind="stable")
        parts = {k: list(zip(*values)) for k, values in _slices(state, list(self.state))}
        found, of, left = [], [], []
        fresh = dict(_slices(rows, ["us", "meets", "ident"]))
        for k in np.flatnonzero(touched).tolist():
            some, kept = self._follow(parts.get(k, []), *fresh.get(k, ([], [], [])), now)
            found += some
            of += [k] * len(some)
            left += [(k, *p) for p in kept]
        state = pd.DataFrame(left, columns=["k", *self.state])
        return self._matches(found).assign(k=of), pd.concat([f for f in (idle, state) if len(f)]) if len(idle) or left else idle

    def deadline(self, state):
        return None if self.within is None else int(state["us"][state["stage"] == 0].min()) + self.within


# --- D9b: login failures, timer form -------------------------------------------


class LoginFailTimer(KeyedSequence):
    """Fails are collected; the first one arms a timer ``window_ms`` later; a success clears
    both.  When the timer fires with at least ``min_fails`` collected, one warning.  A timer
    that is due fires before the next row of the key.
    Output: user_id, first_fail_time, last_fail_time, fails.
    """

    state = {"first": "int64", "last": "int64", "n": "int64", "timer": "int64"}

    def __init__(self, window_ms: int, min_fails: int = 2, fail: str = "fail", order=("seq",), **clock):
        super().__init__({"event_type": "string", **{c: "long" for c in order}}, order, **clock)
        self.window, self.min_fails, self.fail = window_ms, min_fails, fail

    def advance_all(self, rows, state, keys, now):
        open_ = {r[0]: r[1:] for r in state[["k", *self.state]].itertuples(index=False, name=None)}
        out = []
        for k, (times, kinds) in _slices(rows, ["us", "event_type"]):
            first, last, n, timer = open_.pop(k, (0, 0, 0, 0))
            for us, kind in zip(times, kinds):
                if n and timer < us // 1000:
                    if n >= self.min_fails:
                        out.append((k, first, last, n))
                    n = 0
                if kind != self.fail:
                    n = 0
                elif n:
                    last, n = us, n + 1
                else:
                    first, last, n, timer = us, us, 1, us // 1000 + self.window
            if n:
                open_[k] = (first, last, n, timer)
        left = []
        for k, (first, last, n, timer) in open_.items():
            if (timer + 1) * 1000 > now:
                left.append((k, first, last, n, timer))
            elif n >= self.min_fails:
                out.append((k, first, last, n))
        df = pd.DataFrame(out, columns=["k", "first_fail_time", "last_fail_time", "fails"], dtype="int64")
        for c in ("first_fail_time", "last_fail_time"):
            df[c] = from_micros(df[c])
        return df, pd.DataFrame(left, columns=["k", *self.state], dtype="int64")

    def deadline(self, state):
        return (int(state["timer"].min()) + 1) * 1000
