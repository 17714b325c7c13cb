"""Periodic runs against a plain search, and the odd cases."""

import hashlib
import random
import zlib

import pytest

from talewright.llm import periodic_runs as pr
from talewright.llm.queries import op11_periodic_runs, table
from talewright.llm.periodic_runs import periodic_runs


def plain_runs(words, min_length=6, exponent=4):
    """All stretches of equal words at every distance, smallest period first."""
    n, found, known = len(words), [], set()
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - s >= max(min_length, exponent * q) and (s, i + q) not in known:
                known.add((s, i + q))
                found.append((s, i + q - s, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def random_texts(seed, count):
    rnd = random.Random(seed)
    out = []
    for _ in range(count):
        kind = rnd.randrange(5)
        if kind == 0:
            out.append("  ".join(rnd.choice("ab") for _ in range(rnd.randint(0, 150))))
        elif kind == 1:
            base = [rnd.choice(["a", "b", "c", "é", "d"]) for _ in range(rnd.randint(1, 9))]
            words = (base * 40)[:rnd.randint(1, 160)]
            for _ in range(rnd.randint(0, 3)):
                words[rnd.randrange(len(words))] = "z"
            out.append(" ".join(words) + rnd.choice(["", " ", "\n"]))
        elif kind == 2:        # periods inside periods
            part = [rnd.choice("ab") for _ in range(rnd.randint(1, 4))] * rnd.randint(4, 7) + [rnd.choice("ab")]
            out.append("\t".join((part * 8)[:rnd.randint(1, 220)]))
        elif kind == 3:
            out.append("x " * rnd.randint(0, 1500))
        else:
            out.append(rnd.choice([None, "", " \n\v", "one"]))
    return out


@pytest.mark.parametrize("min_length,exponent", [(6, 4), (4, 2), (9, 3)])
def test_runs_equal_plain_search(spark, make_docs, min_length, exponent):
    texts = random_texts(min_length, 150)
    rows = periodic_runs(make_docs(list(enumerate(texts))), min_length=min_length, exponent=exponent).collect()
    assert len(rows) == len(texts)
    for r in rows:
        words = (texts[r.doc_id] or "").split()
        expected = plain_runs(words, min_length, exponent)
        assert [tuple(x) for x in r.runs] == expected
        assert r.n_words == len(words) and r.collapsed == collapsed(words, expected)


def test_small_chunks_keep_the_order(monkeypatch):
    monkeypatch.setattr(pr, "RUN_CHUNK", 8)
    rnd = random.Random(3)
    values = rnd.sample(range(10_000), 2000)
    p, known = pr.Positions(values[0]), [values[0]]
    for x in values[1:]:
        lower, upper = [k for k in known if k < x], [k for k in known if k > x]
        assert p.add(x) == (max(lower, default=-1), min(upper, default=-1))
        known.append(x)
    assert list(p) == sorted(known) and p.size == len(known) and len(p.chunks) > 1


def test_odd_rows(spark, make_docs):
    long = "la " * 200_000 + " ".join(f"t{i}" for i in range(5000))
    pairs = [(1, None), (2, ""), (3, " \t "), (None, "a a a a a a"), (4, "a a a a a"), (5, "A a A a A a A a"), (5, "A a A a A a A a"), (6, long)]
    rows = periodic_runs(make_docs(pairs)).collect()
    by = {}
    for r in rows:
        by.setdefault(r.doc_id, []).append(([tuple(x) for x in r.runs], r.collapsed))
    assert by[1] == by[2] == by[3] == [([], "")]
    assert by[None] == [([(0, 6, 1)], "a")]
    assert by[4] == [([], "a a a a a")]                       # five words are too short
    assert by[5] == [([(0, 8, 2)], "A a")] * 2                # letters keep their case
    assert by[6][0][0] == [(0, 200_000, 1)] and by[6][0][1].startswith("la t0 t1 ")
    assert periodic_runs(make_docs([(1, "a")]).limit(0)).collect() == []
    with pytest.raises(ValueError):
        periodic_runs(make_docs([(1, "a")]), exponent=1)


def test_query_equals_brute_force(spark, sf001):
    got = {r.doc_id: r for r in op11_periodic_runs(spark, sf001).collect()}
    for doc_id, text in table(spark, sf001, "documents").select("doc_id", "text").collect():
        words = (text or "").split()
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = max(runs, key=lambda r: (r[1] / r[2], -r[0], -r[2]), default=(None,) * 3)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        r = got[doc_id]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert r.runs_sha256 == sha("".join(f"{s},{length},{q}\n" for s, length, q in runs))
        assert r.collapsed_sha256 == sha(collapsed(words, runs))
    assert sum(r.n_runs for r in got.values()) > 5
