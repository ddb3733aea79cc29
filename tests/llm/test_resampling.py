import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import queries as Q
from tidemark.llm import resampling as R

from .conftest import PROSE

SF = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def buckets(text):
    w = words(text)
    return [zlib.crc32(f.encode()) % 10000 for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))]]


def brute(rows, target, share=25):
    """(id, n_features, weight, score, rank) of every row, in the input's order."""
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(buckets(text))
    for text in target:
        t.update(buckets(text))
    ns, nt = sum(s.values()), sum(t.values())

    def gain(b):
        return math.floor(1000 * math.log((t[b] + 1.0) * (ns + 10000.0) / ((s[b] + 1.0) * (nt + 10000.0))))

    out = []
    for i, text in rows:
        f = buckets(text)
        weight = sum(map(gain, f)) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    able = [r for r, (_, text) in zip(out, rows) if len(words(text)) >= 20]
    able.sort(key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for k, r in enumerate(able[:share * len(able) // 100]):
        r[4] = k + 1
    return out


def key(r):
    return tuple(-1 if v is None else v for v in r)


def same(got, rows, target, share=25):
    got = [(r["id"], r["n_features"], r["weight"], r["score"], r["rank"]) for r in got]
    assert sorted(map(key, got)) == sorted(map(key, brute(rows, target, share)))


def test_query_equals_brute_force(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    items = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = [tuple(r) for r in Q.op11_resampling(spark, SF).collect()]
    assert sorted(map(key, got)) == sorted(map(key, brute(docs, items)))
    assert max(r[4] or 0 for r in got) > 10


def test_hashes_of_odd_texts(monkeypatch):
    rng = random.Random(3)
    texts = ["", "   ", "a", "été ÀB 日本 x" * 40, "y" * 300 + " z " + "q" * 49 + " " + "r" * 48, "\ud800 lone", "-" * 200,
             " ".join("".join(rng.choice("abcXYZ09é-") for _ in range(rng.randint(1, 90))) for _ in range(400))]
    for size in (1 << 20, 64, 7):
        monkeypatch.setattr(R, "PIECE", size)
        got = [Counter() for _ in texts]
        for word, one, pair, two in R.features(iter(texts)):
            for at, h in ((word, one), (pair, two)):
                for i, x in zip(at.tolist(), h.tolist()):
                    got[i][x] += 1
        for text, g in zip(texts, got):
            w = words(text)
            want = Counter(zlib.crc32(f.encode("utf-8", "surrogatepass"))
                           for f in [*w, *(f"{a} {b}" for a, b in zip(w, w[1:]))])
            assert g == want


@pytest.mark.parametrize("share", [0, 25, 60, 100])
def test_ties_nulls_and_repeats(spark, odd_docs, odd_rows, share):
    target = spark.createDataFrame([(PROSE,), (None,), ("",)], "text string")
    same(R.resample(odd_docs, target, share).collect(), [(r[0], r[1]) for r in odd_rows], [PROSE], share)


def test_cut_between_equal_rows(make_docs, spark):
    """A third of all rows shares one identifier and text; the cutoff falls between them."""
    rng = random.Random(5)
    rows = [(7, PROSE)] * 40 + [(i, " ".join(rng.choice(PROSE.split()) for _ in range(30))) for i in range(50, 130)]
    target = spark.createDataFrame([(PROSE,)], "text string")
    for share in (10, 40):
        got = R.resample(make_docs(rows), target, share).collect()
        same(got, rows, [PROSE], share)
        assert sorted(r["rank"] for r in got if r["rank"]) == list(range(1, share * 120 // 100 + 1))


def test_bisect(spark):
    rng = np.random.default_rng(1)
    values = sorted(int(v) for v in rng.integers(-50, 50, 300))
    df = spark.createDataFrame([(v,) for v in values], "v long")
    for k in (1, 2, 150, 299, 300):
        assert R.bisect(df, df["v"], k) == (values[k - 1], values.index(values[k - 1]))


def test_empty(spark, empty_docs, make_docs):
    none = spark.createDataFrame([], "text string")
    assert R.resample(empty_docs, none).count() == 0
    same(R.resample(make_docs([(1, PROSE), (2, PROSE + " x")]), none, 50).collect(), [(1, PROSE), (2, PROSE + " x")], [], 50)
    with pytest.raises(ValueError):
        R.resample(spark.createDataFrame([("a", "b")], "doc_id string, text string"), none)
