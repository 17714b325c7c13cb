"""The look-ahead of BPE training, checked in pure Python against one merge at
a time on many random corpora (no Spark: the rule itself)."""

import random

from talewright.operators.bpe import merge_chains, merge_passes


def pair_table(state):
    counts = {}
    for syms, f in state.items():
        for a, b in zip(syms, syms[1:]):
            counts[(a, b)] = counts.get((a, b), 0) + f
    return counts


def merged(syms, a, b, new):
    out, i = [], 0
    while i < len(syms):
        if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
            out.append(new)
            i += 2
        else:
            out.append(syms[i])
            i += 1
    return out


def one_by_one(words, n, min_freq):
    state = dict(words)
    out = []
    while len(out) < n:
        ranked = sorted(((-c, a, b) for (a, b), c in pair_table(state).items() if c >= min_freq))
        if not ranked:
            break
        c, a, b = ranked[0]
        out.append((a, b, -c))
        new = {}
        for syms, f in state.items():
            key = tuple(merged(list(syms), a, b, a + b))
            new[key] = new.get(key, 0) + f
        state = new
    return out


def in_rounds(words, n, min_freq, size):
    """Rounds over the ``size`` most frequent pairs, as the Spark job runs them."""
    tokens = sorted({s for syms in words for s in syms})
    known = {t: i for i, t in enumerate(tokens)}
    state = {tuple(known[s] for s in syms): f for syms, f in words.items()}
    out, rounds = [], 0
    while len(out) < n:
        top = sorted(pair_table(state).items(), key=lambda x: -x[1])
        if not top or top[0][1] < min_freq:
            break
        bar = max(top[size][1] if len(top) > size else 0, min_freq - 1)
        pairs = {p for p, c in top if c > bar}
        alone = not pairs
        if alone:
            pairs = {min((p for p, c in top if c == top[0][1]), key=lambda p: (tokens[p[0]], tokens[p[1]]))}
        pieces = []
        for syms, f in state.items():
            start = 0
            for i in range(1, len(syms) + 1):
                if i == len(syms) or (syms[i - 1], syms[i]) not in pairs:
                    if i - start > 1:
                        pieces.append((list(syms[start:i]), f))
                    start = i
        batch, repeats = merge_chains(pieces, tokens, known, bar, 1 << 30, n - len(out), force=alone)
        assert batch and (repeats or len({c for *_, c in batch}) == len(batch))
        for a, b, c, new in batch:
            out.append((tokens[a], tokens[b], c))
            fresh = {}
            for syms, f in state.items():
                key = tuple(merged(list(syms), a, b, new))
                fresh[key] = fresh.get(key, 0) + f
            state = fresh
        rounds += 1
    return out, rounds


def test_rule_random_corpora():
    rng = random.Random(7)
    merges = rounds = 0
    for trial in range(1500):
        alpha = "abcde"[: rng.randint(2, 5)]
        words = {}
        for _ in range(rng.randint(1, 12)):
            w = tuple(rng.choice(alpha) for _ in range(rng.randint(1, 9)))
            words[w] = words.get(w, 0) + rng.randint(1, 6)
        n, min_freq, size = rng.randint(1, 25), rng.choice([1, 2, 3]), rng.choice([1, 2, 3, 5, 50])
        got, k = in_rounds(words, n, min_freq, size)
        assert got == one_by_one(words, n, min_freq), (trial, words, n, min_freq, size)
        merges, rounds = merges + len(got), rounds + k
    assert merges > 1.5 * rounds


def test_passes_equal_lowest_rank_first():
    """Merges as passes over a text, also if several make one token."""
    rnd = random.Random(3)
    repeated = 0
    for _ in range(3000):
        known, merges, pairs = {"a": 0, "b": 1}, [], set()
        for _ in range(rnd.randint(1, 12)):
            x, y = rnd.choice(list(known)), rnd.choice(list(known))
            if len(x + y) > 7 or (x, y) in pairs:
                continue
            pairs.add((x, y))
            repeated += x + y in known
            known.setdefault(x + y, len(known))
            merges.append((known[x], known[y], known[x + y]))
        rank = {(a, b): (r, c) for r, (a, b, c) in enumerate(merges)}
        want = got = [rnd.randrange(2) for _ in range(rnd.randint(0, 20))]
        while found := [(rank[p], p) for p in zip(want, want[1:]) if p in rank]:
            (_, c), p = min(found)
            want = merged(want, *p, c)
        for a, b, c in merge_passes(merges):
            got = merged(got, a, b, c)
        assert got == want
    assert repeated > 100
    assert merge_passes([(0, 1, 2), (2, 0, 3)], most=1) is None
