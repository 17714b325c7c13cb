"""The n-gram Jaccard join against brute force, and the odd cases."""

from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from test_minhash import GROUPS, brute, corpus, shingles

from talewright.llm import ngram_join as nj
from talewright.llm.ngram_join import jaccard_components


@pytest.mark.parametrize("k,percent", [(4, 85), (2, 50)])
def test_components_equal_brute_force(spark, make_docs, k, percent):
    pairs = corpus(k, GROUPS)
    got = {r.doc_id: r for r in jaccard_components(make_docs(pairs), words=k, percent=percent).collect()}
    assert {i: r.component_id for i, r in got.items()} == brute(pairs, k, percent)
    assert all(r.n_shingles == len(shingles(dict(pairs)[i], k)) for i, r in got.items())


@pytest.mark.parametrize("orders,band", [(1, 4), (3, 4), (3, 1.1)])
def test_torn_buckets_lose_no_link(spark, make_docs, monkeypatch, orders, band):
    monkeypatch.setattr(nj, "BLOCK_MEMBERS", 5)
    monkeypatch.setattr(nj, "SIZE_BAND", band)
    pairs = corpus(11, [(60, 120, 0.04), (40, 90, 0.04), (30, 60, 0.03)])
    pairs += [(2000 + i, " ".join(f"q{j}" for j in range(60 + i))) for i in range(40)]     # linked to those of about the same length
    shared = " ".join(f"p{i}" for i in range(40))      # a passage that unlike documents share
    pairs += [(1000 + i, f"{shared} " + " ".join(f"u{i}-{j}" for j in range(15 + i % 7))) for i in range(40)]
    got = {r.doc_id: r.component_id for r in jaccard_components(make_docs(pairs), words=4, percent=85, orders=orders,
                                                               cells=16).collect()}    # next to nothing known about rarity
    assert got == brute(pairs, 4, 85)


def test_linked_pairs_meet_under_every_order():
    rng = np.random.default_rng(2)
    classes = rng.integers(0, 9, nj.CELLS).astype(np.uint8)
    for _ in range(300):
        both = rng.integers(1, 60)
        rest = rng.integers(0, max(1, both * 15 // 85) + 1)
        cut = rng.integers(0, rest + 1)
        t = rng.integers(0, 2**63, both + rest, dtype=np.uint64) * np.uint64(2)
        x, y = np.sort(t[:both + cut]), np.sort(np.r_[t[:both], t[both + cut:]])
        if 100 * both < 85 * (both + rest):
            continue
        first = np.array([0, len(x), len(x) + len(y)])
        for place in nj.prefixes(np.r_[x, y], first, classes, 85, range(nj.ORDERS)):
            a = nj.prefix_size(np.array([len(x)]), 85)[0]
            least = nj.common_prefix_tokens(np.array([len(x)]), np.array([len(y)]), 85)[0]
            assert np.intersect1d(place[:a], place[a:]).size >= least >= 1


def test_a_pair_is_compared_in_one_bucket_alone():
    rng = np.random.default_rng(5)
    classes = rng.integers(0, 3, nj.CELLS).astype(np.uint8)
    base = rng.integers(0, 2**63, 80, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(np.r_[rng.permutation(base)[:rng.integers(60, 80)], rng.integers(0, 2**63, 6, dtype=np.uint64)]) for _ in range(25)]
    first = np.r_[0, np.cumsum([len(s) for s in sets])]
    place, = nj.prefixes(np.concatenate(sets), first, classes, 60, range(1))
    ends = np.r_[0, np.cumsum(nj.prefix_size(np.diff(first), 60))]
    lists = [tuple(place[a:b].astype(np.int64).tolist()) for a, b in zip(ends[:-1], ends[1:], strict=True)]
    seen = Counter()
    for key in {k for one in lists for k in one}:
        rep = [i for i, one in enumerate(lists) if key in one]
        run = pa.table({"key": [key] * len(rep), **{c: [0] * len(rep) for c in ("band", "i", "j", "blk", "home")}, "rep": rep,
                        "pos": [lists[i].index(key) for i in rep], "component": rep, "n": [len(sets[i]) for i in rep], "p0": pa.array([list(lists[i]) for i in rep], pa.list_(pa.int64()))})
        pairs = {(rep[u], rep[v]) for u, partners in nj._candidates(run, 60, ["p0"]) for v in partners.tolist()}
        bits, = nj._bit_maps([pa.RecordBatch.from_arrays([run["rep"].combine_chunks(), run["p0"].combine_chunks()], ["id", "prefix"])])
        run = run.append_column("bits", bits["bits"])
        assert pairs <= {(rep[u], rep[v]) for u, partners in nj._candidates(run, 60, ["bits"]) for v in partners.tolist()}
        seen.update(pairs)
    linked = {(i, j) for i in range(25) for j in range(i + 1, 25) if nj._linked(sets[i], sets[j], 60)}
    assert len(linked) > 50 and linked <= seen.keys() and set(seen.values()) == {1}


def test_parity_maps_keep_links_and_drop_unlike_pairs():
    rng = np.random.default_rng(7)
    draw = lambda n: rng.integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2)
    sets, bases = [], 0
    for size in (3, 40, 500, 520, 2000):     # 500 and 520 have maps of different widths
        base = draw(size)
        sets += [np.unique(np.r_[base[:size - cut], draw(more)]) for cut, more in ((0, 0), (0, size // 8), (size // 20, size // 20), (size // 2, size // 2))]
        bases += 1
    first = np.r_[0, np.cumsum([len(s) for s in sets])]
    flat, ends = nj.parity_maps(np.concatenate(sets), first)
    maps = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)]
    widths = {len(m) * 8 for m in maps}
    assert min(widths) == 64 and all(2 * len(s) <= len(m) * 8 or len(m) == 8 for s, m in zip(sets, maps, strict=True))
    rep = list(range(len(sets)))
    run = pa.table({**{c: [0] * len(rep) for c in ("key", "band", "i", "j", "blk", "home", "pos")}, "rep": rep, "component": rep,
                    "n": [len(s) for s in sets], "map": maps})
    got = {(u, v) for u, partners in nj._candidates(run, 85, ["map"]) for v in partners.tolist()}
    linked = {(i, j) for i in rep for j in rep[i + 1:] if nj._linked(sets[i], sets[j], 85)}
    assert len(linked) >= bases and linked <= got
    assert all(i // 4 == j // 4 and (i % 4 < 3 and j % 4 < 3 or i < 4) for i, j in got)
    pairs = [(i, j) for i in rep for j in rep[i + 1:]]
    near, = nj._near(85)([pa.RecordBatch.from_pydict({
        "a": [i for i, _ in pairs], "b": [j for _, j in pairs], "a_n": [len(sets[i]) for i, _ in pairs], "b_n": [len(sets[j]) for _, j in pairs],
        "a_map": [maps[i] for i, _ in pairs], "b_map": [maps[j] for _, j in pairs]})])
    near = set(zip(near["a"].to_pylist(), near["b"].to_pylist(), strict=True))
    assert linked <= near and {p for p in near if 100 * len(sets[p[0]]) >= 85 * len(sets[p[1]])} - got == set()


def test_unlike_texts_of_a_bucket_are_not_read_again(spark, make_docs, monkeypatch):
    shared = " ".join(f"p{i}" for i in range(40))
    pairs = [(i, f"{shared} " + " ".join(f"u{i}-{j}" for j in range(40))) for i in range(60)]
    pairs += [(100, pairs[0][1] + " end")]
    read = []

    def sets_of(ids, *rest, real=nj._sets_of):
        read.append({r.id for r in ids.distinct().collect()})
        return real(ids, *rest)

    monkeypatch.setattr(nj, "_sets_of", sets_of)
    got = {r.doc_id: r.component_id for r in jaccard_components(make_docs(pairs), words=4, percent=85, cells=16).collect()}
    assert got == brute(pairs, 4, 85) and got[100] == 0
    assert set().union(*read) == {0, 100}


def test_orders_put_frequent_tokens_last(spark, make_docs):
    docs = make_docs([(i, f"alpha beta gamma delta only{i} a{i} b{i} c{i}") for i in range(50)]).select("text")
    classes = nj.count_classes(docs, 4, nj.tb.NOT_SPACE)
    text = b"alpha beta gamma delta only1 a1 b1 c1"
    sets, first = nj.shingle_sets(np.frombuffer(text, np.uint8), np.array([0, len(text)]), 4, nj.tb.NOT_SPACE)
    for place in nj.prefixes(sets, first, classes, 50, range(nj.ORDERS)):
        assert (place >> np.uint64(56)).max() <= 2 * np.log2(50) and len(place) == nj.prefix_size(np.array([5]), 50)[0]
        assert (place >> np.uint64(56)).tolist() == sorted((place >> np.uint64(56)).tolist())
    assert sorted(set(classes.tolist()))[-1] == int(2 * np.log2(51))


def test_odd_rows(spark, make_docs):
    long = " ".join(f"t{i % 7919}" for i in range(60_000))
    pairs = [(1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "one  TWO"), (6, "one two three four"), (None, "one two"),
             (7, long), (8, long + " end"), (9, "a b c d"), (9, "a b c d"), (10, "A B C D"), (11, "x y z"), (11, "one two three four")]
    rows = jaccard_components(make_docs(pairs), words=4, percent=85).collect()
    assert len(rows) == len(pairs) and rows[0].asDict().keys() == {"doc_id", "n_shingles", "component_id"}
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
    assert [(by[i][0].n_shingles, by[i][0].component_id) for i in (1, 2, 3)] == [(0, i) for i in (1, 2, 3)]
    assert by[4][0].component_id == by[5][0].component_id == 4
    assert by[7][0].component_id == by[8][0].component_id == 7
    assert {r.component_id for i in (9, 10) for r in by[i]} == {9}
    assert by[11][0].component_id == by[6][0].component_id == 6       # one id, two texts
    assert by[None][0].component_id is None and by[None][0].n_shingles == 1
    assert jaccard_components(make_docs([(1, "a")]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        jaccard_components(make_docs([(1, "a")]), percent=0)
