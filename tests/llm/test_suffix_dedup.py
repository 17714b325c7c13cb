"""Repeated passages against brute force, and the odd cases."""

import random
from collections import defaultdict

import pytest

from talewright.llm.suffix_dedup import cut_repeats, repeated_passages


def brute(pairs, n):
    """{(id, start, end, kept)} from all windows of n words; one text per id."""
    held = defaultdict(list)
    for i, t in sorted((p for p in pairs if p[0] is not None), key=lambda p: p[0]):
        w = (t or "").encode().lower().split()
        for s in range(len(w) - n + 1):
            held[tuple(w[s:s + n])].append((i, s))
    starts = defaultdict(set)
    for places in held.values():
        if len({i for i, _ in places}) > 1:
            for rank, (i, s) in enumerate(places):
                starts[i, rank == 0].add(s)
    out = set()
    for (i, kept), found in starts.items():
        found = sorted(found)
        lo = last = found[0]
        for s in [*found[1:], 10**9]:
            if s > last + n:
                out.add((i, lo, last + n, kept))
                lo = s
            last = s
    return out


def corpus(seed):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passages = [[rnd.choice(words) for _ in range(rnd.randint(18, 60))] for _ in range(12)]
    out = []
    for i in range(80):
        text = [rnd.choice(words) for _ in range(rnd.randint(0, 80))]
        for _ in range(rnd.randint(0, 3)):
            p = rnd.choice(passages)
            a = rnd.randint(0, 4)
            at = rnd.randint(0, len(text))
            text[at:at] = p[a:len(p) - rnd.randint(0, 4)]
        out.append((i, " ".join(text).upper() if i % 7 == 0 else "\n".join(text)))
    return out + [(100, out[3][1]), (101, out[3][1]), (102, "w1 " * 200)]


@pytest.mark.parametrize("n,gram", [(20, 6), (20, 20), (15, 1)])
def test_spans_equal_brute_force(spark, make_docs, n, gram):
    pairs = corpus(n + gram)
    rows = repeated_passages(make_docs(pairs), min_words=n, gram=gram).collect()
    assert {(r.doc_id, r.start_word, r.end_word, r.kept) for r in rows} == brute(pairs, n)
    assert len(rows) == len({tuple(r) for r in rows})


def test_runs_over_many_batches(spark, make_docs):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        pairs = corpus(77)
        rows = repeated_passages(make_docs(pairs), min_words=20, gram=6).collect()
        assert {(r.doc_id, r.start_word, r.end_word, r.kept) for r in rows} == brute(pairs, 20)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_cut_keeps_the_first_occurrence(spark, make_docs):
    p = " ".join(f"p{i}" for i in range(25))
    pairs = [(1, f"start {p}  tail"), (2, f"other {p}\nrest of it"), (3, p.upper()), (4, "nothing here"), (5, None), (None, p), (6, ""), (7, p)]
    docs = make_docs(pairs)
    cut = cut_repeats(docs, min_words=20, gram=5)
    assert cut.columns == docs.columns
    got = {r.doc_id: r.text for r in cut.collect()}
    assert got == {1: f"start {p}  tail", 2: "other rest of it", 4: "nothing here", 5: None, None: p, 6: ""}


def test_odd_rows(spark, make_docs):
    long = " ".join(f"t{i}" for i in range(30_000))
    pairs = [(1, None), (2, ""), (3, "short text"), (4, long), (5, "x " + long), (4, long), (None, long), (6, "y"), (6, "y")]
    rows = repeated_passages(make_docs(pairs)).collect()
    assert {(r.doc_id, r.start_word, r.end_word, r.kept) for r in rows} == {(4, 0, 30_000, True), (5, 1, 30_001, False)}
    assert repeated_passages(make_docs([(1, "a")]).limit(0)).collect() == []
    # repeats within one document alone, or in two rows of one id, do not count
    assert repeated_passages(make_docs([(1, long), (1, long)])).collect() == []
