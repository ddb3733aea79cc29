import random
import re
from collections import Counter

from tidemark.llm import decontaminate as D


def words(t):
    return re.findall(r"[^\W_]+", (t or "").lower())


def brute(docs, items, n=5, threshold=0.8):
    out = []
    for i, d in docs:
        w = words(d)
        for k, t in items:
            q = words(t)
            if not q:
                continue
            m = min(n, len(q))
            s = {tuple(q[a:a + m]) for a in range(len(q) - m + 1)}
            hit = len(s & {tuple(w[a:a + m]) for a in range(len(w) - m + 1)})
            if hit >= threshold * len(s) - 1e-9:
                out.append((i, k, hit))
    return Counter(out)


def fixture(seed=4):
    rng = random.Random(seed)
    vocabulary = [f"v{i}" for i in range(300)]

    def text(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    items = [(k, text(rng.choice([1, 2, 3, 6, 12, 30, 60, 100]))) for k in range(60)]
    items += [(None, text(20)), (70, None), (71, "!!"), (72, items[5][1])]
    docs = []
    for i in range(80):
        parts = [text(rng.randint(0, 400))]
        for _ in range(rng.randint(0, 2)):
            q = words(rng.choice(items)[1])
            for _ in range(rng.randint(0, max(1, len(q) // 12))):  # light damage
                if q:
                    q[rng.randrange(len(q))] = "changed"
            parts += [" ".join(q).upper() + ",", text(rng.randint(0, 300))]
        docs.append((i, "\n".join(parts)))
    docs += [(None, items[20][1]), (3, items[20][1]), (3, items[20][1]), (90, None), (91, ""),
             (92, text(30000) + " " + items[25][1] + " " + text(30000))]
    return docs, items


def test_matches_brute_force(spark, make_docs):
    docs, items = fixture()
    found = D.contained_items(make_docs(docs), spark.createDataFrame(items, "item_id long, text string"), block_items=25)
    got = Counter((r["id"], r["item_id"], r["shared"]) for r in found.collect())
    want = brute(docs, items)
    assert sum(want.values()) > 60
    assert got == want


def test_blocks_are_bounded_by_bytes_and_written(spark, make_docs, monkeypatch):
    docs, items = fixture(6)
    keyed = spark.createDataFrame(items, "item_id long, text string")
    sizes = [[len(t or "") for _, t in b] for b in D.blocks(D.take(keyed, id="item_id", text="text").select(
        "id", D.text_of("text").alias("text")), 1000, 1500)]
    assert sum(map(len, sizes)) == len(items) and all(sum(b) <= 1500 or len(b) == 1 for b in sizes)
    settled, settle = [], D.settle
    monkeypatch.setattr(D, "settle", lambda *a: settled.append(1) or settle(*a))
    found = D.contained_items(make_docs(docs), keyed, block_bytes=1500)
    assert Counter((r["id"], r["item_id"], r["shared"]) for r in found.collect()) == brute(docs, items)
    assert len(settled) == len(sizes) > 3


def test_no_short_item_is_missed():
    filler = " ".join(f"f{i}" for i in range(40))
    texts = [" ".join(f"t{k}w{i}" for i in range(1 + k % 8)) for k in range(12_000)]
    index, hasher = D.ItemIndex(list(enumerate(texts)), 5, 0.8, 128), D.Hasher()
    missed = [k for k, t in enumerate(texts) if not any(i == k for i, _, _ in index.matches(f"{t} {filler}", hasher))]
    assert missed == []


def test_contaminated_rows_go(spark, make_docs):
    docs, items = fixture(5)
    keyed = spark.createDataFrame(items, "item_id long, text string")
    df = make_docs(docs)
    out = D.drop_contaminated(df, keyed)
    assert out.columns == df.columns
    bad = {i for (i, _, _) in brute([(n, t) for n, (_, t) in enumerate(docs)], items)}
    key = lambda x: (x[0] is None, x[0] or 0, x[1] or "")
    want = sorted((d for n, d in enumerate(docs) if n not in bad), key=key)
    assert sorted(((r[0], r[1]) for r in out.collect()), key=key) == want


def test_empty(spark, empty_docs, odd_docs):
    none = spark.createDataFrame([], "item_id long, text string")
    one = spark.createDataFrame([(1, "some words of a test item")], "item_id long, text string")
    assert D.contained_items(odd_docs, none).count() == 0
    assert D.contained_items(empty_docs, one).count() == 0
    assert D.drop_contaminated(odd_docs, none).count() == odd_docs.count()
