"""Near-dedup against brute force, and the odd cases."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from talewright.llm import minhash
from talewright.llm.minhash import near_duplicates, superminhash


def shingles(text, k):
    w = (text or "").encode().lower().split()
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(len(w) - k + 1)) if len(w) >= k else frozenset([tuple(w)])


def brute(pairs, k, percent):
    """{id: (component, sizes)} by comparing all texts that share a shingle."""
    sets = [(i, shingles(t, k)) for i, t in pairs if i is not None]
    parent = {i: i for i, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    held = defaultdict(list)
    for at, (_, s) in enumerate(sets):
        for g in s:
            held[g].append(at)
    for at, (i, s) in enumerate(sets):
        for other, c in Counter(o for g in s for o in held[g] if o < at).items():
            j, t = sets[other]
            if 100 * c >= percent * (len(s) + len(t) - c):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in parent}


def corpus(seed, groups):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    out = []
    for copies, length, change in groups:
        base = [rnd.choice(words) for _ in range(length)]
        for _ in range(copies):
            out.append(" ".join(rnd.choice(words) if rnd.random() < change else w for w in base))
    rnd.shuffle(out)
    return list(enumerate(out))


GROUPS = [(1, 120, 0)] * 40 + [(30, 150, 0.02), (60, 200, 0.03), (25, 120, 0.05), (12, 90, 0), (8, 30, 0.02), (5, 2, 0)]


@pytest.mark.parametrize("k,percent", [(3, 85), (5, 80)])
def test_components_equal_brute_force(spark, make_docs, k, percent):
    pairs = corpus(k, GROUPS)
    got = {r.doc_id: r for r in near_duplicates(make_docs(pairs), words=k, percent=percent).collect()}
    expected = brute(pairs, k, percent)
    assert {i: r.component_id for i, r in got.items()} == expected
    assert all(r.kept == (i == expected[i]) for i, r in got.items())
    assert all(r.n_shingles == len(shingles(dict(pairs)[i], k)) for i, r in got.items())


def test_blocks_of_a_bucket_lose_no_link(spark, make_docs, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_MEMBERS", 7)
    pairs = corpus(9, [(80, 150, 0.035), (40, 100, 0.03)])
    got = {r.doc_id: r.component_id for r in near_duplicates(make_docs(pairs), words=3, percent=85).collect()}
    assert got == brute(pairs, 3, 85)


def test_odd_rows(spark, make_docs):
    long = " ".join(f"t{i % 7919}" for i in range(60_000))
    pairs = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one  TWO"), (6, "one two three"), (None, "one two"),
             (7, long), (8, long + " end"), (9, "a b c d"), (9, "a b c d"), (10, "A B C D"), (11, "x y z"), (11, "one two three")]
    rows = near_duplicates(make_docs(pairs), words=3, percent=85).collect()
    assert len(rows) == len(pairs)
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [(by[i][0].n_shingles, by[i][0].component_id, by[i][0].kept) for i in (1, 2, 3)] == [(0, i, True) for i in (1, 2, 3)]
    assert by[4][0].component_id == by[5][0].component_id == 4
    assert by[7][0].component_id == by[8][0].component_id == 7
    assert {r.component_id for i in (9, 10) for r in by[i]} == {9}
    assert by[11][0].component_id == by[6][0].component_id == 6       # one id, two texts
    assert by[None][0].component_id is None and by[None][0].kept is False


def test_empty_table(spark, make_docs):
    assert near_duplicates(make_docs([(1, "a")]).limit(0)).collect() == []


def test_signature_estimates_similarity():
    rng = np.random.default_rng(5)
    shared, rest = rng.integers(0, 2**63, 400, dtype=np.uint64), rng.integers(0, 2**63, 200, dtype=np.uint64)
    a, b = np.sort(np.r_[shared, rest[:100]]), np.sort(np.r_[shared, rest[100:]])
    sig = superminhash(np.r_[a, b], np.array([0, len(a), len(a) + len(b)]))
    assert abs((sig[0] == sig[1]).mean() - 400 / 600) < 0.13
    assert (sig < np.iinfo(np.int64).max).all()
    # every slot of a one-element set is filled, by a permutation of the steps
    one = superminhash(rest[:1], np.array([0, 1]))
    assert sorted((one[0] >> 32).tolist()) == list(range(minhash.SLOTS))
