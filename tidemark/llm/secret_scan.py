"""Secret scans: rules, and a character convolutional network over every candidate.

1. One Arrow pass finds the rule spans (assignments, access keys, hex strings) and the
   candidates: runs of at least ``CANDIDATE`` key characters outside them with a digit or
   both cases of letters; what a rule span leaves of a run counts as a run.  Each finding keeps a window of fixed size: 16 characters before it, 40 of its own
   (the first and last 20 of a longer one) and 8 after it.  The scan only hands a text to
   Python if it holds a digit, a run of both cases, a key word, an access key prefix or a long
   hex run; other texts cannot have a finding.
2. The network is trained in numpy on labelled findings: rule findings against other
   candidates, all distinct windows of both.  Few windows (``sample`` per label) are fitted at
   once.  More of them stay in a table: a fit of ``sample`` per label only gives the weights to
   start from, then Spark tasks go on from them over the windows they read, each window once,
   the rarer label's again, and the weights of the tasks are averaged, in ``ROUNDS`` rounds.
   The context of half of the windows is blanked, so a key word alone does not decide, and
   half are cut to a random length, so the length does not either.
3. Scores are calibrated (Platt scaling) on a part that the network did not see, in the form
   that is scored later: whole windows, those of rule findings in the context of another
   candidate, since a candidate has no key word beside it.  The threshold is the largest one that keeps the recall there at ``recall`` or more.
   Of more windows a quarter is kept for that, all scored by tasks and counted per label and
   thousandth of a logit; scaling and threshold are found on these counts.
4. Every candidate of every row is scored with the same network, in the row.

Rows stay where they are: there is no shuffle but that of the distinct windows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import materialize, shuffle_partitions, take, text_of
from tidemark.session import ship_package

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
#: The length from which the assignment rule takes a value.
CANDIDATE = 8
KEY = "A-Za-z0-9+/_.=-"
RUN = re.compile(rf"[{KEY}]{{{CANDIDATE},}}")
DIGIT = re.compile("[0-9]")
LEFT, BODY, RIGHT = 16, 40, 8
WIDTH = LEFT + BODY + RIGHT
CONTEXT = np.r_[0:LEFT, LEFT + BODY:WIDTH]
#: Windows of a label that are fitted at once.
SAMPLE = 3_000
#: Rounds of training by tasks over the other windows.
ROUNDS = 2
BATCH = 128
#: Steps of a logit that held windows are counted by, up to ``FAR`` logits from 0.
STEPS, FAR = 1000, 30
#: Candidates that one task scores.
TASK_CANDIDATES = 20_000
SEED = 11

SPANS = "array<struct<kind:int,start:int,end:int,window:string>>"


def rule_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the rule findings, by start, then kind."""
    out = [(0, m.start(), m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    out += [(1, m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    out += [(2, m.start(), m.end()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], s[0]))


def window(text: str, start: int, end: int) -> str:
    body = text[start:end]
    if len(body) > BODY:
        body = body[:BODY // 2] + body[-BODY // 2:]
    return (text[max(0, start - LEFT):start].rjust(LEFT, "\0") + body.ljust(BODY, "\0")
            + text[end:end + RIGHT].ljust(RIGHT, "\0"))


def findings(text: str) -> list[tuple[int, int, int, str]]:
    """Rule spans and candidates (kind 3) with their windows; candidates touch no rule span.

    The window of an assignment is that of its value.
    """
    rules = rule_spans(text)
    out = []
    for kind, s, e in rules:
        m = ASSIGN.match(text, s, e) if kind == 0 else None
        out.append((kind, s, e, window(text, *(m.span(2) if m else (s, e)))))
    covered = [(s, e) for _, s, e in rules]
    at, reach = 0, 0
    for m in RUN.finditer(text):
        s, e = m.span()
        while at < len(covered) and covered[at][0] < e:
            first, last = covered[at]
            if first > max(s, reach):
                out += candidate(text, max(s, reach), first)
            reach = max(reach, last)
            at += 1
        if reach < e:
            out += candidate(text, max(s, reach), e)
    return out


def candidate(text: str, start: int, end: int) -> list[tuple[int, int, int, str]]:
    """The run of key characters as a finding, if it is long enough and may be a key."""
    run = text[start:end]
    if len(run) >= CANDIDATE and (DIGIT.search(run) or run.lower() != run != run.upper()):
        return [(3, start, end, window(text, start, end))]
    return []


def may_hold(text: Column) -> Column:
    """Whether the text can have a finding at all."""
    low = F.lower(text)
    out = text.rlike("[0-9]") | F.contains(text, F.lit("AKIA")) | text.rlike("[0-9a-f]{32}")
    out = out | text.rlike(rf"(?<![{KEY}])(?=[{KEY}]{{{CANDIDATE}}})(?=[{KEY}]*[a-z])[{KEY}]*[A-Z]")
    for word in ("password", "passwd", "secret", "token", "apikey", "api_key"):
        out = out | F.contains(low, F.lit(word))
    return out


def extract(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, found`` (findings with windows) per row, written to the shared folder."""
    ship_package(docs.sparkSession)
    rows = take(docs, id=id_col, text=text_col).select("id", text_of("text").alias("text"))
    rows = rows.select("id", F.when(may_hold(F.col("text")), F.col("text")).alias("text"))
    schema = rows.select("id", F.lit(None).cast(SPANS).alias("found")).schema
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                               ("window", pa.string())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [[dict(zip(("kind", "start", "end", "window"), f)) for f in findings(t.as_py() or "")]
                     for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["id", "found"])

    return materialize(rows.mapInArrow(run, schema), "secret-findings")


def encode(windows: list[str], blank: np.ndarray | None = None) -> np.ndarray:
    """Character numbers (n x WIDTH): 0 none, 1-96 in the finding, 97-192 in its context."""
    raw = np.frombuffer("".join(windows).encode("utf-32-le"), "<u4").astype(np.int64).reshape(-1, WIDTH)
    codes = np.where(raw == 0, 0, np.where((raw < 32) | (raw > 126), 96, raw - 31))
    part = codes[:, CONTEXT]
    codes[:, CONTEXT] = np.where(part > 0, part + 96, 0)
    if blank is not None:
        codes[np.ix_(np.flatnonzero(blank), CONTEXT)] = 0
    return codes


def without_context(codes: np.ndarray) -> np.ndarray:
    out = codes.copy()
    out[:, CONTEXT] = 0
    return out


@dataclass
class Network:
    """Embedding, one convolution of width 5, largest and mean activation, one output."""

    embed: np.ndarray
    conv: np.ndarray
    conv_bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray
    scale: float = 1.0
    shift: float = 0.0
    threshold: float = 0.5

    TAPS = 5

    @classmethod
    def new(cls, channels: int = 8, filters: int = 24) -> "Network":
        rng = np.random.default_rng(SEED)
        return cls(rng.normal(0, 0.5, (193, channels)), rng.normal(0, 0.2, (cls.TAPS * channels, filters)),
                   np.zeros(filters), rng.normal(0, 0.2, 2 * filters), np.zeros(1))

    def weights(self) -> list[np.ndarray]:
        return [self.embed, self.conv, self.conv_bias, self.out, self.out_bias]

    def flat(self) -> np.ndarray:
        return np.concatenate([w.ravel() for w in self.weights()]).astype("float64")

    def like(self, flat: np.ndarray, kind: str = "float64") -> "Network":
        """A network of this one's shape with other weights."""
        ends = np.cumsum([w.size for w in self.weights()])
        parts = np.split(np.asarray(flat).astype(kind), ends[:-1])
        return Network(*[p.reshape(w.shape) for p, w in zip(parts, self.weights())])

    def forward(self, codes: np.ndarray) -> tuple:
        e = self.embed[codes]
        n, width, channels = e.shape
        cols = sliding_window_view(e, self.TAPS, axis=1).transpose(0, 1, 3, 2).reshape(n, width - self.TAPS + 1, -1)
        act = np.maximum(cols @ self.conv + self.conv_bias, 0)
        top = act.argmax(axis=1)
        pooled = np.concatenate((act.max(axis=1), act.mean(axis=1)), axis=1)
        return pooled @ self.out + self.out_bias[0], pooled, act, top, cols

    def logits(self, codes: np.ndarray, block: int = 512) -> np.ndarray:
        if not len(codes):
            return np.empty(0)
        return np.concatenate([self.forward(codes[i:i + block])[0] for i in range(0, len(codes), block)])

    def gradients(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
        s, pooled, act, top, cols = self.forward(codes)
        n, steps, filters = act.shape
        ds = weight * (1 / (1 + np.exp(-s)) - y) / n
        d_pooled = ds[:, None] * self.out
        d_act = np.repeat(d_pooled[:, None, filters:] / steps, steps, axis=1)
        rows, cell = np.arange(n)[:, None], np.arange(filters)[None, :]
        d_act[rows, top, cell] += d_pooled[:, :filters]
        d_act *= act > 0
        d_cols = (d_act @ self.conv.T).reshape(n, steps, self.TAPS, -1)
        d_embed = np.zeros_like(self.embed)
        for k in range(self.TAPS):
            np.add.at(d_embed, codes[:, k:k + steps], d_cols[:, :, k])
        return [d_embed, np.tensordot(cols, d_act, ([0, 1], [0, 1])), d_act.sum((0, 1)), ds @ pooled,
                np.array([ds.sum()])]

    def score(self, windows: list[str]) -> np.ndarray:
        """Calibrated probabilities."""
        return 1 / (1 + np.exp(-(self.scale * self.logits(encode(windows)) + self.shift)))


class Adam:
    """Adam's steps on a network's own weights."""

    def __init__(self, net: Network, rate: float = 0.01):
        self.net, self.rate, self.step = net, rate, 0
        self.m, self.v = ([np.zeros_like(p) for p in net.weights()] for _ in range(2))

    def update(self, codes: np.ndarray, y: np.ndarray, weight: np.ndarray) -> None:
        self.step += 1
        m, v, params = self.m, self.v, self.net.weights()
        for k, g in enumerate(self.net.gradients(codes, y, weight)):
            m[k] = 0.9 * m[k] + 0.1 * g
            v[k] = 0.999 * v[k] + 0.001 * g * g
            params[k] -= self.rate * (m[k] / (1 - 0.9 ** self.step)) / (np.sqrt(v[k] / (1 - 0.999 ** self.step)) + 1e-8)


def varied(plain: np.ndarray, blank: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Half of the windows without context, half cut to a random length."""
    n = len(plain)
    codes = np.where(rng.random(n)[:, None] < 0.5, blank, plain)
    cut = np.where(rng.random(n) < 0.5, rng.integers(CANDIDATE, BODY, n), BODY)
    codes[:, LEFT:LEFT + BODY][np.arange(BODY) >= cut[:, None]] = 0
    return codes


def balanced(y: np.ndarray) -> np.ndarray:
    """Weights that give each label half of the loss."""
    share = min(max(float(y.mean()), 1e-3), 1 - 1e-3)
    return np.where(y > 0, 0.5 / share, 0.5 / (1 - share))


def fit(plain: np.ndarray, blank: np.ndarray, y: np.ndarray, steps: int, batch: int) -> Network:
    """A new network, trained on batches drawn from windows held in memory."""
    rng = np.random.default_rng(SEED)
    weight = balanced(y)
    adam = Adam(Network.new())
    for _ in range(steps):
        rows = rng.integers(0, len(y), batch)
        adam.update(varied(plain[rows], blank[rows], rng), y[rows], weight[rows])
    return adam.net


def fit_halves(plain: np.ndarray, blank: np.ndarray, y: np.ndarray, half: np.ndarray, steps: int, batch: int
               ) -> list[Network]:
    """Two networks, the first trained on the windows of ``half``, the second on the others."""
    return [fit(plain[part], blank[part], y[part], steps // 2, batch) for part in (half, ~half)]


def doubtful(pair: list[Network], blank: np.ndarray, y: np.ndarray, half: np.ndarray) -> np.ndarray:
    """Candidates that look like rule findings to the network of ``pair`` that has not seen them."""
    out = np.zeros(len(y), bool)
    for net, unseen in zip(pair, (~half, half)):
        some = np.flatnonzero(unseen & (y == 0))
        out[some] = net.logits(blank[some]) >= 0
    return out


def train_network(positive: list[str], negative: list[str], recall: float = 0.98, steps: int = 250,
                  batch: int = BATCH) -> Network | None:
    """The calibrated network of windows held in memory, or None unless there are 20 of each label.

    Other candidates can hold secrets that no rule finds.  Two networks, each trained on one
    half, score the other half; candidates that look like rule findings to a network that
    has not seen them are left out of the final training.
    """
    if min(len(positive), len(negative)) < 20:
        return None
    rng = np.random.default_rng(SEED)
    windows = [*positive, *negative]
    y = np.r_[np.ones(len(positive)), np.zeros(len(negative))]
    plain, blank = encode(windows), encode(windows, np.ones(len(windows), bool))
    half = rng.permutation(len(y)) % 2 == 0
    doubt = doubtful(fit_halves(plain, blank, y, half, steps, batch), blank, y, half)
    order = rng.permutation(np.flatnonzero(~doubt))
    cut = max(10, len(order) // 4)
    held, used = order[:cut], order[cut:]
    net = fit(plain[used], blank[used], y[used], steps, batch)
    logits, target = net.logits(in_neutral_context(plain[held], y[held], plain[y == 0])), y[held]
    net.scale, net.shift = calibrate(logits, target)
    p = 1 / (1 + np.exp(-(net.scale * logits + net.shift)))
    net.threshold = recall_threshold(p, target, recall)
    return net


def in_neutral_context(codes: np.ndarray, y: np.ndarray, negative: np.ndarray) -> np.ndarray:
    """The encoded windows, those of rule findings with the context of random ``negative`` ones."""
    donors = negative[np.random.default_rng(SEED).integers(0, len(negative), len(codes))]
    out = codes.copy()
    out[:, CONTEXT] = np.where((y > 0)[:, None], donors[:, CONTEXT], codes[:, CONTEXT])
    return out


def calibrate(logits: np.ndarray, y: np.ndarray, steps: int = 50, n: np.ndarray | None = None) -> tuple[float, float]:
    """Platt scaling by Newton steps; targets are drawn in by one pseudo finding of each label.
    ``n`` is how often each logit occurs (once)."""
    n = np.ones(len(y)) if n is None else n
    ones = (n * y).sum()
    target = np.where(y > 0, (ones + 1) / (ones + 2), 1 / (n.sum() - ones + 2))
    a, b = 1.0, 0.0
    x = np.stack((logits, np.ones_like(logits)), axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ (a, b), -30, 30)))
        h = (x * (n * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(h, x.T @ (n * (p - target)))
        step /= max(1.0, float(np.abs(step).max()))
        a, b = a - float(step[0]), b - float(step[1])
    return a, b


def recall_threshold(p: np.ndarray, y: np.ndarray, recall: float, n: np.ndarray | None = None) -> float:
    """Of the thresholds with at least this recall, the lowest of those with the best precision.
    ``n`` is how often each score occurs (once)."""
    n = np.ones(len(y)) if n is None else n
    score, at = np.unique(np.r_[0.0, p], return_inverse=True)
    found, right = (np.bincount(at[1:], c, len(score))[::-1].cumsum()[::-1] for c in (n, n * y))
    enough = np.flatnonzero(right[1:] >= recall * right[0])  # between a score and the next one
    if not len(enough):
        return 0.5
    precision = right[1:][enough] / found[1:][enough]
    i = enough[np.argmax(precision >= precision.max() - 1e-12)]
    return float((score[i] + score[i + 1]) / 2)


def labelled_windows(found: DataFrame) -> DataFrame:
    """All distinct windows (``w``, hash ``h``) of rule findings (``label``) and of other
    candidates, in the order of their hashes, written to the shared folder."""
    rows = found.select(F.explode("found").alias("f")).select(
        (F.col("f.kind") < 3).alias("label"), F.col("f.window").alias("w"), F.xxhash64("f.window").alias("h"))
    return materialize(rows.distinct().sortWithinPartitions("h", "w"), "secret-windows")


def first_windows(windows: DataFrame, counts: dict[bool, int], n: int) -> list[list[tuple[int, str]]]:
    """Per label (rule findings first) the ``n`` windows with the smallest hashes, or all."""
    out = []
    for label in (True, False):
        bound = int(min(1.0, 1.5 * n / max(counts[label], 1)) * (1 << 30))
        kept = (windows.where((F.col("label") == label) & (F.pmod("h", F.lit(1 << 30)) < bound))
                .select("h", "w").orderBy("h", "w").limit(n).collect())
        out.append([(r["h"], r["w"]) for r in kept])
    return out


# How windows are parted by their hash: halves, a quarter held for calibration, rounds.

def first_half(h: np.ndarray) -> np.ndarray:
    return h & 1 == 0


def held(h: Column | np.ndarray) -> Column | np.ndarray:
    return F.shiftright(h, 1).bitwiseAND(3) == 0 if isinstance(h, Column) else h >> 1 & 3 == 0


def in_round(h: Column, i: int) -> Column:
    return F.pmod(F.shiftright(h, 3), F.lit(ROUNDS)) == i


def _decoded(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    plain = encode(batch.column("w").to_pylist())
    return (plain, without_context(plain), batch.column("label").to_numpy(zero_copy_only=False).astype("float64"),
            batch.column("h").to_numpy())


class Learner:
    """A network trained on windows as they come, in single precision."""

    def __init__(self, net: Network, rate: float = 0.002):
        self.adam, self.rng, self.n = Adam(net.like(net.flat(), "float32"), rate), np.random.default_rng(SEED), 0
        self.last: dict[bool, np.ndarray] = {}

    def learn(self, plain: np.ndarray, blank: np.ndarray, y: np.ndarray) -> None:
        """Each window once; the rarer label's are drawn again, up to a quarter of a batch."""
        parts = {label: np.flatnonzero((y > 0) == label) for label in (True, False)}
        for label, rows in parts.items():
            if len(rows):
                self.last[label] = plain[rows]
        steps = -(-max(len(r) for r in parts.values()) // (BATCH * 3 // 4))
        for i in range(steps):
            codes, target = [], []
            for label, rows in parts.items():
                some = plain[rows[i::steps]]
                more = BATCH // 4 - len(some)
                if more > 0 and label in self.last:
                    again = self.last[label]
                    some = np.concatenate((some, again[self.rng.integers(0, len(again), more)]))
                codes.append(some)
                target.append(np.full(len(some), float(label)))
            codes, target = np.concatenate(codes), np.concatenate(target)
            self.adam.update(varied(codes, without_context(codes), self.rng), target.astype("float32"),
                             balanced(target).astype("float32"))
        self.n += len(y)


def train_by_tasks(windows: DataFrame, nets: list[Network], pair: list[Network] | None = None
                   ) -> tuple[list[Network], list[int]]:
    """The networks after one more pass of tasks over the windows, averaged by the windows that
    each task gave to them, and how many these were.

    Without ``pair`` the two networks are those of the halves.  With it there is one, which
    gets the windows that are neither held nor doubtful to the pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        learners = [Learner(net) for net in nets]
        for batch in batches:
            if not batch.num_rows:
                continue
            plain, blank, y, h = _decoded(batch)
            half = first_half(h)
            if pair is None:
                uses = [half, ~half]
            else:
                rows = np.flatnonzero(~held(h))
                uses = [np.zeros(len(y), bool)]
                uses[0][rows] = ~doubtful(pair, blank[rows], y[rows], half[rows])
            for learner, use in zip(learners, uses):
                if use.any():
                    learner.learn(plain[use], blank[use], y[use])
        done = [(i, x.n, x.adam.net.flat().tolist()) for i, x in enumerate(learners) if x.n]
        yield pa.RecordBatch.from_arrays(
            [pa.array([d[0] for d in done], pa.int32()), pa.array([d[1] for d in done], pa.int64()),
             pa.array([d[2] for d in done], pa.list_(pa.float64()))], names=["net", "n", "weights"])

    ship_package(windows.sparkSession)
    parts = windows.mapInArrow(run, "net int, n long, weights array<double>")
    # rounded, so the mean does not depend on the order of the tasks
    means = parts.select("net", "n", F.posexplode("weights").alias("i", "v")).groupBy("net", "i").agg(
        F.round(F.sum(F.col("v") * F.col("n")) / F.sum("n"), 9).alias("v"), F.sum("n").alias("n")).collect()
    out, used = [], []
    for k, net in enumerate(nets):
        mine = sorted((r["i"], r["v"], r["n"]) for r in means if r["net"] == k)
        out.append(net.like(np.array([v for _, v, _ in mine])) if mine else net)
        used.append(mine[0][2] if mine else 0)
    return out, used


def held_logits(windows: DataFrame, net: Network, pair: list[Network]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(logit, label, number) of all held windows that are not doubtful, counted by steps of a
    logit; rule findings in the context of another candidate of their batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        others = np.zeros((1, WIDTH), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            plain, blank, y, h = _decoded(batch)
            if (y == 0).any():
                others = plain[y == 0]
            kept = ~doubtful(pair, blank, y, first_half(h))
            logits = net.logits(in_neutral_context(plain[kept], y[kept], others))
            steps = np.round(np.clip(logits, -FAR, FAR) * STEPS).astype("int64")
            (step, label), n = np.unique(np.stack((steps, y[kept].astype("int64"))), axis=1, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(label), pa.array(n.astype("int64"))],
                                             names=["step", "label", "n"])

    ship_package(windows.sparkSession)
    counts = windows.where(held(F.col("h"))).mapInArrow(run, "step long, label long, n long")
    rows = counts.groupBy("step", "label").agg(F.sum("n").alias("n")).orderBy("step", "label").collect()
    return (np.array([r["step"] / STEPS for r in rows]), np.array([float(r["label"]) for r in rows]),
            np.array([float(r["n"]) for r in rows]))


def learn(found: DataFrame, recall: float = 0.98, sample: int = SAMPLE, steps: int = 250) -> Network | None:
    """The calibrated network of all distinct windows, or None unless there are 20 of each label."""
    windows = labelled_windows(found)
    counts = {label: 0 for label in (True, False)} | {
        r["label"]: r["count"] for r in windows.groupBy("label").count().collect()}
    if min(counts.values()) < 20:
        return None
    first = first_windows(windows, counts, sample)
    if max(counts.values()) <= sample:
        return train_network(*[[w for _, w in part] for part in first], recall, steps)
    h = np.array([x for part in first for x, _ in part])
    plain = encode([w for part in first for _, w in part])
    blank = without_context(plain)
    y = np.r_[np.ones(len(first[0])), np.zeros(len(first[1]))]
    half = first_half(h)
    pair = fit_halves(plain, blank, y, half, steps, BATCH)
    used = ~held(h) & ~doubtful(pair, blank, y, half)
    net = fit(plain[used], blank[used], y[used], steps, BATCH)
    rounds = [windows.where(in_round(F.col("h"), i)) for i in range(ROUNDS)]
    for some in rounds:
        pair, _ = train_by_tasks(some, pair)
    pair = [p.like(p.flat(), "float32") for p in pair]
    for some in rounds:
        (net,), _ = train_by_tasks(some, [net], pair)
    logits, y, n = held_logits(windows, net, pair)
    if (n * y).sum() and (n * (1 - y)).sum():
        net.scale, net.shift = calibrate(logits, y, n=n)
        net.threshold = recall_threshold(1 / (1 + np.exp(-(net.scale * logits + net.shift))), y, recall, n)
    return net


def scan(docs: DataFrame, recall: float = 0.98, sample: int = SAMPLE, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, spans`` with (kind, start, end, score), by start, then kind, and ``model``.

    Kinds 0 to 2 are rule findings (score 1), kind 3 those of the network.  Offsets are code
    points, ends exclusive.  Null texts count as empty.  Without enough labelled findings
    there is no network, only rule findings are returned and ``model`` is false.  Repeated rows are scanned each
    for itself; an empty table gives an empty result; other columns are ignored.
    """
    found = extract(docs, id_col, text_col)
    net = learn(found, recall, sample)
    if net is not None:  # tasks of about as many candidates each, however few files hold them
        n = found.select(F.sum(F.size(F.filter("found", lambda f: f["kind"] == 3)))).first()[0] or 0
        found = found.repartition(max(shuffle_partitions(found), -(-int(n) // TASK_CANDIDATES)))
    kind = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int32()), ("end", pa.int32()),
                               ("score", pa.float64())]))
    schema = found.select("id", F.lit(None).cast(
        "array<struct<kind:int,start:int,end:int,score:double>>").alias("spans")).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [v.as_py() or [] for v in batch.column(1)]
            windows = [f["window"] for r in rows for f in r if f["kind"] == 3]
            scores = iter(net.score(windows) if net and windows else [0.0] * len(windows))
            least = net.threshold if net else 1.0
            out = []
            for r in rows:
                scored = [(f, 1.0 if f["kind"] < 3 else float(next(scores))) for f in r]
                spans = [{"kind": f["kind"], "start": f["start"], "end": f["end"], "score": s}
                         for f, s in scored if s >= least]
                out.append(sorted(spans, key=lambda s: (s["start"], s["kind"])))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, kind)], names=["id", "spans"])

    return found.mapInArrow(run, schema).withColumn("model", F.lit(net is not None))
