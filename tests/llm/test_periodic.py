import hashlib
import random
import re
import zlib

import pytest

from tidemark.llm import periodic as P
from tidemark.llm import queries as Q

SF = "/root/testdata/sf0.001"


def smallest_period(w):
    fail = [0] * len(w)
    for i in range(1, len(w)):
        k = fail[i - 1]
        while k and w[i] != w[k]:
            k = fail[k - 1]
        fail[i] = k + (w[i] == w[k])
    return len(w) - fail[-1] if w else 0


def brute(w, powers=4, least=6):
    """Every period's maximal stretches; a stretch counts for its smallest period only."""
    out = []
    for p in range(1, len(w) // powers + 1):
        i = 0
        while i + p < len(w):
            j = i
            while j + p < len(w) and w[j] == w[j + p]:
                j += 1
            if j > i and j - i + p >= max(least, powers * p) and smallest_period(w[i:j + p]) == p:
                out.append((i, j - i + p, p))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def kept(w, runs):
    gone = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.mark.parametrize("powers,least", [(4, 6), (2, 1), (3, 10)])
def test_batches_equal_brute_force(powers, least):
    rng = random.Random(powers)
    docs = []
    for _ in range(300):
        doc = []
        while len(doc) < rng.choice((0, 1, 7, 60, 150)):
            unit = [rng.choice("abcd") for _ in range(rng.randint(1, 9))]
            doc += (unit * rng.randint(1, 9))[:rng.randint(1, 60)]
        docs.append(doc)
    docs += [["a"] * 500, list("ab") * 200 + ["a"], []]
    got = P.batch_runs([[w.encode() for w in d] for d in docs], powers, least)
    assert got == [brute(d, powers, least) for d in docs]


def test_many_lefts_around_one_phrase():
    doc = " ".join(f"w{i} go go go go go go stop" for i in range(800)).split()
    assert P.batch_runs([[w.encode() for w in doc]], 4, 6)[0] == [(8 * i + 1, 6, 1) for i in range(800)]


def test_rows(odd_docs, odd_rows, empty_docs):
    got = P.periodic_runs(odd_docs).collect()
    key = repr
    want = []
    for r in odd_rows:
        w = words(r[1])
        runs = brute(w) if len(w) < 5000 else []
        want.append((r[0], len(w), runs, kept(w, runs)))
    assert sorted(((r["id"], r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in got),
                  key=key) == sorted(want, key=key)
    assert P.periodic_runs(empty_docs).count() == 0


def test_long_text(make_docs):
    unit = [f"w{i}" for i in range(5000)]
    text = " ".join(["x"] + unit * 60 + ["y"] * 100_000)
    row = P.periodic_runs(make_docs([(1, text)])).first()
    assert [tuple(r) for r in row["runs"]] == [(1, 300_000, 5000), (300_001, 100_000, 1)]
    assert row["collapsed"] == " ".join(["x", *unit, "y"])


def contract(doc_id, text):
    w = words(text)
    n, h = len(w), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = w[:a] + [w[a + (i - a) % p] for i in range(a, n)]
    runs = brute(w)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    return (doc_id, len(runs), *top, 1000 * top[1] // top[2] if runs else None,
            hashlib.sha256("".join("%d,%d,%d\n" % r for r in runs).encode()).hexdigest(),
            hashlib.sha256(kept(w, runs).encode()).hexdigest())


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    want = sorted(contract(r["doc_id"], r["text"]) for r in docs)
    got = sorted(tuple(r) for r in Q.op12_periodic_runs(spark, SF).collect())
    assert got == want
    assert sum(r[1] > 0 for r in got) > 5


def test_marked_rows(spark):
    ids = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0][:6]
    rows = [(ids[0], None), (ids[1], ""), (ids[2], " \t "), (ids[3], "one"), (ids[4], "a b\nc  d e f g h i j k"),
            (ids[5], " ".join(f"v{i}" for i in range(97))), (None, "no id  here"), (1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: words(r["text"]) for r in Q.with_repeats(docs).collect()}
    for i, t in rows[:6]:
        w, g = words(t), zlib.crc32(str(i).encode()) // 10
        a = g % len(w) if w else 0
        p = 1 + (len(w) - a) // (3 + g % 8)
        assert got[i] == w[:a] + [w[a + (j - a) % p] for j in range(a, len(w))]
    assert got[None] == ["no", "id", "here"] and got[1] == []
