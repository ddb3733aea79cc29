import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash

from tidemark.llm import simhash as S


def brute_fingerprint(text, n=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    if not words:
        return 0
    runs = [" ".join(words[i:i + n]) for i in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, distance):
    fps = sorted(fps)
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= distance:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def clustered(seed, clusters=25):
    rng = np.random.default_rng(seed)
    out = set()
    for base in rng.integers(0, 1 << 63, clusters, dtype=np.uint64):
        x = int(base)
        for _ in range(int(rng.integers(1, 40))):
            out.add(x)
            y = x
            for _ in range(int(rng.integers(1, 4))):
                y ^= 1 << int(rng.integers(0, 64))
            out.add(y)
            x = y if rng.random() < 0.4 else x
    return out


@pytest.mark.parametrize("distance", [0, 1, 2])
@pytest.mark.parametrize("parts", [2, 3])
def test_links_lose_nothing(spark, distance, parts):
    fps = clustered(distance)
    df = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long")
    got = defaultdict(set)
    for r in S.components(S.links(df, distance, parts)).collect():
        got[r["label"]].add(r["node"] & (1 << 64) - 1)
    want = defaultdict(set)
    for f, root in components(fps, distance).items():
        want[root].add(f)
    assert {frozenset(v) for v in got.values()} == {frozenset(v) for v in want.values() if len(v) > 1}


def test_masks_cover_every_pair_of_flips(spark):
    df = spark.createDataFrame([(S.signed(f),) for f in clustered(9)], "fp long")
    masks = S.plan_masks(df, 2, 3)
    for i in range(64):
        for j in range(64):
            flip = (1 << i) | (1 << j)
            assert any(not flip & m for m in masks)


def correlated(n, seed=0):
    """Bits that follow a chain: each equals the one before in nine of ten fingerprints."""
    rng = np.random.default_rng(seed)
    bits = [rng.random(n) < 0.4]
    for _ in range(63):
        bits.append(np.where(rng.random(n) < 0.9, bits[-1], rng.random(n) < 0.5))
    return np.array(bits).T.astype(np.int64)


def pairs_within(bits, group, most):
    x = bits[:, group].astype(np.float32)
    apart = np.rint(len(group) - x @ x.T - (1 - x) @ (1 - x).T)[np.triu_indices(len(bits), 1)]
    return [int((apart <= t).sum()) for t in range(most + 1)]


def test_estimates_follow_the_correlation_of_bits():
    bits = correlated(3000)
    both = bits.T @ bits
    model = S.BitModel(len(bits), both)
    p = bits.mean(axis=0)
    for group in (list(range(21)), list(range(0, 64, 3)), [1, 2, 3, 40, 41, 63]):
        want = pairs_within(bits, group, 2)
        assert np.allclose(model.pairs(0, group, 2), want, rtol=0.25)
        single = np.prod([p[b] ** 2 + (1 - p[b]) ** 2 for b in group]) * 3000 * 2999 / 2
        assert single < want[0] / 3  # what single-bit rates would say
    # of the pairs that agree on some bits: within 1 bit on others
    held, group = list(range(8)), list(range(8, 16))
    same = sum(pairs_within(bits[m], group, 1)[1] for m in
               [np.all(bits[:, held] == v, axis=1) for v in np.unique(bits[:, held], axis=0)])
    assert np.isclose(model.pairs(S.bits_mask(held), group, 1)[1], same, rtol=0.25)


@pytest.mark.parametrize("n", [0, 1, 2])
def test_estimates_of_constant_bits(n):
    both = np.full((64, 64), n, np.int64)
    got = S.BitModel(n, both).pairs(0, [0, 1, 2], 2)
    assert np.all(np.isfinite(got)) and got == sorted(got)


def test_patterns_are_counted_over_all_fingerprints(spark):
    fps = sorted(clustered(4))
    df = spark.createDataFrame([(S.signed(f),) for f in fps], "fp long").repartition(5)
    groups = [list(range(20)), list(range(20, 63)), [63], [5, 63]]
    want = []
    for g in groups:
        seen = [f & S.bits_mask(g) for f in fps]
        want.append(sum(seen.count(v) > 1 for v in seen))
    assert S.crowded_patterns(df, groups) == want
    assert S.crowded_patterns(df.where("false"), groups) == [0] * 4


def test_levels_follow_the_count():
    bits = correlated(2000, 1)
    share, most = (bits.T @ bits) / 2000, []
    for n in (10, 10 ** 5, 10 ** 8, 10 ** 11, 10 ** 14):
        for seen in ([n, 0, n // 2], [0, n, 0], [n] * 3):  # the masks cover all flips, whatever was measured
            masks = S.masks_of(n, (share * n).astype(np.int64), 2, 3, lambda groups: seen)
            for i in range(64):
                for j in range(64):
                    flip = (1 << i) | (1 << j)
                    assert any(not flip & m for m in masks)
        most.append(min(m.bit_count() for m in masks))
    assert most == sorted(most) and most[0] < 40 < most[-1]


def test_unequal_thresholds_from_unequal_counts():
    """Of two groups the one on which most fingerprints agree gets the smaller threshold."""
    rng = np.random.default_rng(3)
    bits = (rng.random((4000, 64)) < 0.5).astype(np.int64)
    bits[:, :32] = bits[:, :1]
    weak = S.bits_mask(range(32))
    masks = S.masks_of(1000, bits.T @ bits // 4, 2, 2, lambda groups: [1000 if 0 in g else 0 for g in groups])
    strong = [m for m in masks if not m & weak]
    assert sorted(m.bit_count() for m in strong) == [31] * 32  # threshold 1: each of its bits left out once
    assert all(m & weak == weak for m in masks if m not in strong)


def test_thresholds_by_dynamic_program():
    assert S.allocate_thresholds([[1, 5, 9], [100, 200, 300], [1, 2, 9]], [[0] * 3] * 3, 0) == [0, -1, 1]
    assert sum(S.allocate_thresholds([[1, 1, 1]] * 3, [[0] * 3] * 3, 0)) == 0


def test_groups_match_brute_force(odd_docs, odd_rows):
    got = S.near_groups(odd_docs).collect()
    fps = [brute_fingerprint(r[1]) for r in odd_rows]
    root = components(set(fps), 2)
    least = defaultdict(list)
    for r, f in zip(odd_rows, fps):
        least[root[f]] += [r[0]] if r[0] is not None else []

    def name(f):
        return min(least[root[f]]) if least[root[f]] else None

    key = lambda x: tuple(-1 if v is None else v for v in x)
    want = sorted(((r[0], f, name(f)) for r, f in zip(odd_rows, fps)), key=key)
    assert sorted(((r["id"], r["fp"] & (1 << 64) - 1, r["component_id"]) for r in got), key=key) == want


def test_one_of_each_group_stays(make_docs):
    words = [f"w{i}" for i in range(400)]
    near = [(i, " ".join(words[:i] + ["changed"] + words[i + 1:])) for i in range(1, 4)]
    docs = make_docs([*near, (10, " ".join(reversed(words))), (11, " ".join(words)), (11, " ".join(words)),
                      (None, "no name"), (None, "no name")])
    groups = {r["id"]: r["component_id"] for r in S.near_groups(docs).collect()}
    out = S.drop_near_copies(docs)
    assert out.columns == docs.columns
    ids = [r["doc_id"] for r in out.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for i, c in groups.items() if i is not None})
    assert ids.count(None) == 2


def test_rows_with_one_id_are_decided_each_for_itself(make_docs):
    words = [f"w{i}" for i in range(400)]
    base, other = " ".join(words), " ".join(reversed(words))
    near = " ".join(["changed"] + words[1:])
    assert (brute_fingerprint(base) ^ brute_fingerprint(near)).bit_count() <= 2
    lone = "a clean text of its own under a repeated name"
    docs = make_docs([(15, base), (15, lone), (16, near), (17, other), (15, other), (20, base), (None, near)])
    got = sorted((r["doc_id"], r["text"]) for r in S.drop_near_copies(docs).collect())
    assert got == sorted([(15, base), (15, lone), (15, other)])


def test_copies_without_an_identifier(make_docs):
    words = [f"w{i}" for i in range(400)]
    base, near, other = " ".join(words), " ".join(["changed"] + words[1:]), " ".join(reversed(words))
    docs = make_docs([(None, base), (None, base), (None, near), (None, other), (5, other), (None, "alone")])
    got = sorted((r["doc_id"] or -1, r["text"]) for r in S.drop_near_copies(docs, unnamed="drop").collect())
    assert len(got) == 3 and (5, other) in got and (-1, "alone") in got
    assert S.drop_near_copies(docs).count() == 5
    with pytest.raises(ValueError):
        S.drop_near_copies(docs, unnamed="?")


def test_empty(empty_docs):
    assert S.near_groups(empty_docs).count() == 0
    assert S.drop_near_copies(empty_docs).count() == 0
