"""Periodic runs of words by descending-LCP Kruskal.

A run is a stretch of words with smallest period q (words q apart are equal)
that no neighbouring word extends. The suffixes of a text are sorted, and the
neighbours in that order are the edges of a graph, weighted by the length of
their longest common prefix (LCP). Kruskal's algorithm takes the edges by
decreasing weight: at weight L the classes are the positions that share their
first L words. A class is an ordered set of positions; of two classes the
smaller is put into the larger, and every pair of positions i < j that becomes
neighbouring there at distance d = j - i <= L seeds a run: the words i ..
j + L - 1 have period d. L is exactly the common prefix of i and j then, so
the stretch cannot grow to the right, and it starts a run if the words before
i and j differ.

Nothing is missed or found twice, and d is the smallest period: a smaller
period p of such a stretch would divide d (it is at least 2 d long), and i + p
would have been in the class of i at the larger weight L + d - p, between i
and j. For the same reason the start s of a run of period q and s + q are
neighbours as soon as they share a class. As only stretches of some least
length count, the edges below that weight are left out.

Each text is looked at whole, inside one task; texts are taken together in
blocks of bounded size, so that sorting is one numpy call for many of them.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

RUN_CHUNK = 512        # positions of a class that one insertion may move

RUNS = "array<struct<start: bigint, length: bigint, period: bigint>>"
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def least_lcp(min_length: int, exponent: int) -> int:
    """Smallest common prefix of s and s + q over all runs that count."""
    return min(max(min_length - q, (exponent - 1) * q) for q in range(1, min_length + 1))


def suffix_levels(code: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """(suffix order, ranks by the first 1, 2, 4 .. words) by prefix doubling.
    ``code``: rank of the word at each position, unlike over texts; ``stop``:
    the end of the position's text. Only positions that still share a rank are
    sorted again. Equal ranks mean that so many words are equal."""
    n = len(code)
    _, inverse, counts = np.unique(code, return_inverse=True, return_counts=True)
    rank = (np.cumsum(counts) - counts)[inverse].astype(np.int64)
    levels = [rank.astype(np.int32)]
    active = np.flatnonzero(counts[inverse] > 1)
    step = 1
    while len(active):
        ahead = active + step
        tail = np.where(ahead < stop[active], rank[np.minimum(ahead, n - 1)] + 1, 0)
        order = np.lexsort((tail, rank[active]))
        active = active[order]
        rs, ts = rank[active], tail[order]
        new_rank = np.r_[True, rs[1:] != rs[:-1]]
        new_pair = new_rank | np.r_[True, ts[1:] != ts[:-1]]
        at = np.arange(len(active))
        moved = np.maximum.accumulate(np.where(new_pair, at, 0)) - np.maximum.accumulate(np.where(new_rank, at, 0))
        rank = rank.copy()
        rank[active] = rs + moved
        levels.append(rank.astype(np.int32))
        alone = new_pair & np.r_[new_pair[1:], True]
        active = np.sort(active[~alone])
        step *= 2
    order = np.empty(n, np.int64)
    order[rank] = np.arange(n)
    return order, levels


def neighbour_lcp(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """Common prefix of every two neighbours of the suffix order."""
    n = len(order)
    x, y = order[:-1].copy(), order[1:].copy()
    lcp = np.zeros(n - 1, np.int64)
    for t in range(len(levels) - 1, -1, -1):
        rank = levels[t]
        same = (x < n) & (y < n) & (rank[np.minimum(x, n - 1)] == rank[np.minimum(y, n - 1)])
        grow = same.astype(np.int64) << t
        lcp += grow
        x += grow
        y += grow
    return lcp


class Positions:
    """An ordered set of positions, kept in short sorted chunks."""

    __slots__ = ("chunks", "heads", "size")

    def __init__(self, first: int) -> None:
        self.chunks, self.heads, self.size = [[first]], [first], 1

    def __iter__(self) -> Iterator[int]:
        for chunk in self.chunks:
            yield from chunk

    def add(self, x: int) -> tuple[int, int]:
        """Put ``x`` in; (the position before, the position after), -1 if none."""
        c = max(bisect_right(self.heads, x) - 1, 0)
        chunk = self.chunks[c]
        k = bisect_left(chunk, x)
        before = chunk[k - 1] if k else -1
        after = chunk[k] if k < len(chunk) else self.heads[c + 1] if c + 1 < len(self.heads) else -1
        chunk.insert(k, x)
        self.size += 1
        if not k:
            self.heads[c] = x
        if len(chunk) > RUN_CHUNK:
            half = len(chunk) // 2
            self.chunks.insert(c + 1, chunk[half:])
            self.heads.insert(c + 1, chunk[half])
            del chunk[half:]
        return before, after


def kruskal_runs(left: np.ndarray, right: np.ndarray, lcp: np.ndarray, code: np.ndarray,
                 begin: np.ndarray, min_length: int, exponent: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of the runs, from the edges (left, right, lcp).
    ``begin``: first position of each position's text."""
    by = np.argsort(-lcp, kind="stable")
    word, origin = code.tolist(), begin.tolist()
    parent = list(range(len(word)))
    members: dict[int, Positions] = {}
    found: list[tuple[int, int, int]] = []
    more = exponent - 1

    def seed(i: int, j: int, common: int) -> None:
        d = j - i
        if common >= more * d and common + d >= min_length and (i == origin[i] or word[i - 1] != word[j - 1]):
            found.append((i, common + d, d))

    for a, b, common in zip(left[by].tolist(), right[by].tolist(), lcp[by].tolist(), strict=True):
        while parent[a] != a:
            parent[a] = a = parent[parent[a]]
        while parent[b] != b:
            parent[b] = b = parent[parent[b]]
        large, small = members.get(a), members.get(b)
        if large is None or (small is not None and large.size < small.size):
            a, b, large, small = b, a, small, large
        parent[b] = a
        if large is None:
            large = members[a] = Positions(a)
        if small is not None:
            del members[b]
        last, open_pair = -1, None
        for x in (b,) if small is None else small:
            if open_pair is not None and x > open_pair[1]:
                seed(*open_pair, common)
            before, after = large.add(x)
            # neighbours of one class were neighbours before
            if before != -1 and before != last:
                seed(before, x, common)
            open_pair = (x, after) if after != -1 else None
            last = x
        if open_pair is not None:
            seed(*open_pair, common)
    return found


def block_runs(h: np.ndarray, first: np.ndarray, min_length: int, exponent: int
               ) -> list[tuple[int, int, int]]:
    """Runs of all texts of a block, by position in the block. ``h``: word
    hashes, ``first``: first word of every text and the total."""
    floor = least_lcp(min_length, exponent)
    rows = np.repeat(np.arange(len(first) - 1), np.diff(first))
    grams = tb.kgram_hashes(h, floor)
    if not len(grams):
        return []
    at = np.flatnonzero(tb.in_row(first, len(h), floor))
    key = tb.mix(grams[at] + rows[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    if not same.any():
        return []
    # only texts in which so many words come again can hold a run
    some = np.unique(rows[at[order[1:][same]]])
    inside = np.zeros(len(first) - 1, bool)
    inside[some] = True
    pos = np.flatnonzero(inside[rows])
    row = rows[pos]
    code = np.unique(tb.mix(h[pos] + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_inverse=True)[1]
    ends = np.searchsorted(row, some, side="right")
    starts = np.r_[0, ends[:-1]]
    sizes = ends - starts
    suffixes, levels = suffix_levels(code, np.repeat(ends, sizes))
    lcp = neighbour_lcp(suffixes, levels)
    keep = np.flatnonzero(lcp >= floor)
    runs = kruskal_runs(suffixes[keep], suffixes[keep + 1], lcp[keep], code, np.repeat(starts, sizes), min_length, exponent)
    return [(int(pos[i]), length, period) for i, length, period in runs]


def _run_rows(min_length: int, exponent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, buf, offs in tb.blocks(batches):
            s, e, first = tb.word_spans(buf, offs, tb.NOT_SPACE)
            runs = sorted(block_runs(tb.span_hashes(buf, s, e, lower=False), first, min_length, exponent),
                          key=lambda r: (r[0], r[2]))
            start, length, period = (np.array([r[c] for r in runs], np.int64) for c in range(3))
            row = np.searchsorted(first, start, side="right") - 1
            # words of a run after its first period
            edge = np.zeros(len(s) + 1, np.int64)
            np.add.at(edge, start + period, 1)
            np.add.at(edge, start + length, -1)
            kept = np.cumsum(edge[:-1]) == 0
            # kept words and one byte after each but the last of its text
            after = np.zeros(len(kept), bool)
            before = np.r_[0, np.cumsum(kept)]
            after[kept] = True
            word_row = np.repeat(np.arange(len(first) - 1), np.diff(first))
            after[kept] = before[1:][kept] < before[first[1:]][word_row[kept]]
            mark = np.zeros(len(buf) + 2, np.int8)
            mark[s[kept]] += 1
            mark[e[kept] + after[kept]] -= 1
            take = np.cumsum(mark[:len(buf)], dtype=np.int8) > 0
            text = buf.copy()
            text[e[after]] = 0x20
            size = np.r_[0, np.cumsum(take)][offs]
            runs_at = np.searchsorted(row, np.arange(len(first)))
            structs = pa.StructArray.from_arrays(
                [pa.array(start - first[row]), pa.array(length), pa.array(period)], fields=list(_RUN))
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array(np.diff(first), pa.int64()),
                pa.ListArray.from_arrays(pa.array(runs_at, pa.int32()), structs),
                pa.Array.from_buffers(pa.large_utf8(), len(offs) - 1, [
                    None, pa.py_buffer(size.astype(np.int64).tobytes()), pa.py_buffer(text[take].tobytes())]).cast(pa.utf8()),
            ], ["id", "n_words", "runs", "collapsed"])
    return run


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_length: int = 6,
                  exponent: int = 4) -> DataFrame:
    """One row per input row: (id, n_words, runs, collapsed).

    ``runs`` are the runs of words (``[^\\x20\\x09-\\x0D]+``, numbered from 0) of
    at least ``min_length`` words and ``exponent`` (>= 2) periods, by start, then
    period. ``collapsed`` is the text without the words that stand in a run after
    its first period, one space between words.

    Null, empty and wordless texts have no runs and an empty ``collapsed``;
    repeated rows and null ids are rows like any other; an empty table gives an
    empty result; other columns are not read. Texts of any length are taken
    whole: a text of n words needs about 4 log2(n) + 500 bytes a word in its task.
    """
    if exponent < 2:
        raise ValueError("a run has two periods at least")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    found = docs.mapInArrow(_run_rows(min_length, exponent), f"id long, n_words long, runs {RUNS}, collapsed string")
    return found.withColumnRenamed("id", id_col)


def strongest(runs) -> F.Column:
    """The run of the greatest length / period (compared exactly); of equal ones
    the first; null if there is none."""
    more = lambda best, r: F.when(r["length"] * best["period"] > best["length"] * r["period"], r).otherwise(best)
    return F.aggregate(runs, F.try_element_at(runs, F.lit(1)), more)
