"""Benchmark decontamination by q-gram lemma filtering.

Texts and benchmark items are reduced to lower-case words joined by one space.
Segments of an item are its 13-word passages from every word on (a shorter item
is one segment) and, for passages with more edits in one place, pieces of 120
bytes every 30 bytes. A text region that matches a segment
of n characters with at most k edits shares at least n + 1 - q (k + 1) of its
q-grams, and these lie on diagonals (text position minus item position) that
differ by at most k. So the q-grams of a text that any item holds are looked up,
sorted by item position in diagonal bands that overlap by half, and a segment is
a candidate of a band only if enough of the band's hits lie in it; the candidate
region is verified by a banded alignment. The filter loses no match of a segment,
so every verbatim passage of 13 words is found wherever it begins; with edits, a
passage is found if one segment in it has at most ``EDIT_RATE`` of them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

Q = 10                     # bytes of a q-gram
PASSAGE = 13               # words of the shortest part of an item that is looked for
SEGMENT = 120              # bytes of a segment at most; a shorter item is one segment as well
STRIDE = 30                # between the long segments
LONG_WORD, PIECE = 30, 6   # a longer run of letters (scripts without spaces) counts as words of PIECE bytes
EDIT_RATE = 0.06           # edits allowed per byte of a segment
CHUNK_BYTES = 4 << 20      # item bytes matched in one pass over the texts
_BITS = 22
_WIDE = 1 << 33            # more than the bytes of a chunk


def normal(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lower-case words, one space after each: (bytes, row offsets, the place
    of every byte in ``buf``)."""
    m = np.zeros(len(buf) + 1, bool)
    m[:-1] = tb.ALNUM[buf]
    keep = m[:-1].copy()
    if len(buf):
        edge = np.zeros(len(buf) + 1, bool)
        edge[offs] = True
        keep[1:] |= m[:-2] & ~edge[1:-1]      # the first byte after a word becomes its space
    at = np.flatnonzero(keep)
    out = np.where(m[at], tb.LOWER[buf[at]], np.uint8(32)) if len(at) else np.zeros(0, np.uint8)
    return out, np.searchsorted(at, offs), at


def lowered(text: str | None) -> bytes:
    return (text or "").lower().encode()


def qgrams(buf: np.ndarray) -> np.ndarray:
    n = len(buf) - Q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p, inv = tb._powers(len(buf) + 1)
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(tb._BYTE_CODE[buf] * p[:-1], out=c[1:])
    return (c[Q:] - c[:-Q]) * inv[:n] * np.uint64(0x9E3779B97F4A7C15)


def edit_distance(pattern: bytes, text: bytes, most: int, shift: int) -> tuple[int, int]:
    """(edits, end) of the cheapest alignment of the whole pattern with a part
    of ``text``, over the diagonals -shift .. shift + slack; edits is most + 1
    if none costs at most ``most``. Row by row; a row's moves along the text are
    one running minimum."""
    n, width = len(pattern), len(text)
    p, t = np.frombuffer(pattern, np.uint8), np.frombuffer(text, np.uint8)
    big = most + 1
    row = np.zeros(width + 1, np.int64)                    # the part may begin anywhere
    j = np.arange(width + 1)
    for i in range(1, n + 1):
        lo, hi = max(0, i - shift), min(width, i + width - n + shift)   # band
        new = np.full(width + 1, big, np.int64)
        a, b = max(lo, 1), hi + 1
        new[a:b] = np.minimum(row[a - 1:b - 1] + (t[a - 1:b - 1] != p[i - 1]), row[a:b] + 1)
        if lo == 0:
            new[0] = i
        new[lo:b] = np.minimum.accumulate(new[lo:b] - j[lo:b]) + j[lo:b]
        row = np.minimum(new, big)
        if row[lo:b].min() >= big:
            return big, 0
    end = int(row.argmin())
    return int(row[end]), end


def passages(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, length) of ``PASSAGE`` words, or their first ``SEGMENT`` bytes,
    from every word of every row on."""
    s, e, _ = tb.word_spans(buf, offs, tb.ALNUM)
    n = np.where(e - s > LONG_WORD, -(-(e - s) // PIECE), 1)
    piece = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    end = np.repeat(e, n)
    start = np.repeat(s, n) + piece * PIECE
    end = np.where(np.repeat(n, n) > 1, np.minimum(start + PIECE, end), end)
    row = np.searchsorted(offs, start, side="right") - 1
    first = np.arange(max(len(start) - PASSAGE + 1, 0))
    first = first[row[first] == row[first + PASSAGE - 1]]
    return start[first], np.minimum(end[first + PASSAGE - 1] - start[first], SEGMENT)


class ItemIndex:
    """Segments of the items of one chunk, and the q-grams of the items.
    Positions are those in all items of the chunk, one after the other."""

    def __init__(self, items: list[tuple[int, str]], edit_rate: float):
        self.items: list[int] = []
        self.short: dict[int, list[tuple[int, int, bytes]]] = {}  # words: (hash, item, body) of the items under 2 q bytes
        bodies: list[bytes] = []
        for item, text in items:
            raw = np.frombuffer(lowered(text), np.uint8)
            body = normal(raw, np.array([0, len(raw)]))[0].tobytes().rstrip(b" ")
            if len(body) >= 2 * Q:
                self.items.append(item)
                bodies.append(body)
            elif body:
                words = tb.word_hash_of(body.decode())
                self.short.setdefault(len(words), []).append((int(tb.kgram_hashes(words, len(words))[0]), item, body))
        self.offs = np.r_[0, np.cumsum([len(b) for b in bodies])].astype(np.int64)
        self.buf = np.frombuffer(b"".join(bodies), np.uint8)
        start, length = passages(self.buf, self.offs)
        some = [(start, length)]
        for a, n in zip(self.offs[:-1].tolist(), np.diff(self.offs).tolist(), strict=True):
            last = max(n - SEGMENT, 0)
            at = np.array(sorted({*range(0, last, STRIDE), last}))
            some.append((a + at, np.full(len(at), min(n, SEGMENT))))
        both = np.unique(np.concatenate([a * (SEGMENT + 1) + n for a, n in some]))
        self.start, self.length = both // (SEGMENT + 1), both % (SEGMENT + 1)
        self.item = np.searchsorted(self.offs, self.start, side="right") - 1
        self.edits = np.minimum((edit_rate * self.length).astype(np.int64), (self.length - Q) // Q)
        self.bound = self.length + 1 - Q * (self.edits + 1)
        h = qgrams(self.buf)
        at = np.arange(len(h))
        at = at[at + Q <= self.offs[np.searchsorted(self.offs, at, side="right")]]   # within one item
        order = np.argsort(h[at], kind="stable")
        self.at = at[order]
        self.h = h[self.at]
        self.map = np.zeros(1 << _BITS, bool)
        self.map[(self.h >> np.uint64(64 - _BITS)).astype(np.int64)] = True
        self.least = int(self.bound.min()) if len(both) else 0
        self.reach = int(self.length.max()) if len(both) else 0
        self.span = int((self.length + self.edits).max()) if len(both) else 0
        self.half = int(self.edits.max()) + 1 if len(both) else 1
        self._seen: dict[tuple[int, bytes], tuple[int, int]] = {}

    def segment(self, s: int) -> tuple[int, bytes, int, int]:
        """(item, bytes, start in the item, edits)."""
        a, i = int(self.start[s]), int(self.item[s])
        return self.items[i], self.buf[a:a + int(self.length[s])].tobytes(), a - int(self.offs[i]), int(self.edits[s])

    @property
    def segments(self) -> list[tuple[int, bytes, int, int]]:
        return [self.segment(s) for s in range(len(self.start))]

    def find_short(self, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(row, item, start, end) of the short items that stand in the normal
        text as whole words."""
        out = []
        if not self.short:
            return out
        s, e, first = tb.word_spans(buf, offs, tb.ALNUM)
        words = tb.span_hashes(buf, s, e)
        for n, items in self.short.items():
            h = tb.kgram_hashes(words, n)
            at = np.flatnonzero(tb.in_row(first, len(words), n) & np.isin(h, np.array([x for x, _, _ in items], np.uint64))) if len(h) else []
            for i in at:
                a, b = int(s[i]), int(e[i + n - 1])
                row, part = int(np.searchsorted(offs, a, side="right")) - 1, buf[a:b].tobytes()
                out += [(row, item, a, b) for x, item, body in items if x == int(h[i]) and body == part]
        return out

    def verify(self, segment: int, region: bytes) -> tuple[int, int]:
        """(edits, end in the region) of the segment in the region."""
        _, part, _, most = self.segment(segment)
        at = region.find(part)
        if at >= 0:
            return 0, at + len(part)
        if len(region) < len(part) - most:                 # cut off by the end of the text
            return most + 1, 0
        known = self._seen.get((segment, region))
        if known is None:
            known = edit_distance(part, region, most, 4 * most + 2)
            if len(self._seen) > 20_000:
                self._seen.clear()
            self._seen[segment, region] = known
        return known

    def find(self, buf: np.ndarray, offs: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(row, segment, edits, start, end in the normal text) of every match."""
        h = qgrams(buf)
        if not len(h) or not len(self.h):
            return []
        hit = self.map[(h >> np.uint64(64 - _BITS)).astype(np.int64)]
        # the lemma without diagonals first: enough hits within a region's reach
        total = np.r_[0, np.cumsum(hit)]
        reach = self.span
        pos = np.flatnonzero(hit)
        if not len(pos):
            return []
        ahead = total[np.minimum(pos + reach, len(h))] - total[pos]
        behind = total[pos + 1] - total[np.maximum(pos + 1 - reach, 0)]
        # a hit of a matching region is within reach of enough others on its two sides together
        pos = pos[ahead + behind - 1 >= self.least]
        lo = np.searchsorted(self.h, h[pos])
        n = np.searchsorted(self.h, h[pos], side="right") - lo
        pos, lo, n = pos[n > 0], lo[n > 0], n[n > 0]
        if not len(pos):
            return []
        e = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
        text_at = np.repeat(pos, n)
        row = np.searchsorted(offs, text_at, side="right") - 1
        inside = text_at + Q <= offs[row + 1]
        e, text_at, row = e[inside], text_at[inside], row[inside]
        at = self.at[e]
        diagonal = text_at - at + len(self.buf)
        out = []
        for side in (0, 1):                                  # bands of 2 (k + 1) diagonals, the second set half a band on
            band = (diagonal + side * self.half) // (2 * self.half)
            order = np.lexsort((at, band, row))
            r, d, x = row[order], band[order], at[order]
            group = np.cumsum(np.r_[False, (r[1:] != r[:-1]) | (d[1:] != d[:-1])])
            place, one = np.unique(group * _WIDE + x, return_index=True)   # distinct q-gram places of a row's band
            r, d = r[one], d[one]
            if len(place) < self.least:
                continue
            # hits of a segment are neighbours: `least` of them within its reach
            near = np.flatnonzero(place[self.least - 1:] - place[:len(place) - self.least + 1] <= self.reach - Q)
            mark = np.zeros(len(place) + 1, np.int64)
            np.add.at(mark, near, 1)
            np.add.at(mark, near + self.least, -1)
            live = np.cumsum(mark[:-1]) > 0
            place, r, d = place[live], r[live], d[live]
            if not len(place):
                continue
            cut = np.r_[0, np.flatnonzero(place[1:] - place[:-1] > self.reach) + 1, len(place)]
            base, x = place // _WIDE * _WIDE, place % _WIDE
            lo = np.searchsorted(self.start, x[cut[:-1]] - self.reach)
            n = np.searchsorted(self.start, x[cut[1:] - 1], side="right") - lo
            seg = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(lo, n)
            head = np.repeat(cut[:-1], n)
            begin = base[head] + self.start[seg]
            held = np.searchsorted(place, begin + self.length[seg] - Q, side="right") - np.searchsorted(place, begin)
            for g in np.flatnonzero(held >= self.bound[seg]).tolist():
                s, i = int(seg[g]), int(head[g])
                one, most, size = int(r[i]), int(self.edits[s]), int(self.length[s])
                low = int(d[i]) * 2 * self.half - side * self.half - len(self.buf) + int(self.start[s])
                a = max(low - most, int(offs[one]))
                b = min(low + 2 * self.half - 1 + size + most, int(offs[one + 1]))
                edits, end = self.verify(s, buf[a:b].tobytes())
                if edits <= most:
                    out.append((one, s, edits, max(a + end - size, a), a + end))
        return out


@lru_cache(maxsize=2)
def _index(items: tuple[tuple[int, str], ...], edit_rate: float) -> ItemIndex:
    return ItemIndex(list(items), edit_rate)


def _match_rows(items: tuple[tuple[int, str], ...], edit_rate: float) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(items, edit_rate)
        for batch, raw, offs in tb.blocks(batches):
            texts = batch.column(batch.schema.get_field_index("text"))
            low = [lowered(t) for t in texts.to_pylist()] if (raw >= 0x80).any() else None
            if low is not None:                             # letters beyond ASCII have a case as well
                offs = np.r_[0, np.cumsum([len(t) for t in low])]
                raw = np.frombuffer(b"".join(low), np.uint8)
            buf, rows, place = normal(raw, offs)
            best: dict[tuple[int, int], list] = {}
            for row, s, edits, a, b in index.find(buf, rows):
                item, part, at, _ = index.segment(s)
                got = best.setdefault((row, item), [edits, a, b, set()])
                got[0], got[1], got[2] = min(got[0], edits), min(got[1], a), max(got[2], b)
                got[3].update(range(at, at + len(part)))
            for row, item, a, b in index.find_short(buf, rows):
                got = best.setdefault((row, item), [0, a, b, set()])
                got[0], got[1], got[2] = 0, min(got[1], a), max(got[2], b)
                got[3].update(range(b - a))
            if not best:
                continue
            keys = sorted(best)
            start, end = [], []
            for k in keys:
                row, (_, a, b, _) = k[0], best[k]
                chars = lambda i, row=row: int(((raw[offs[row]:i] & 0xC0) != 0x80).sum())
                start.append(chars(place[a]))
                end.append(chars(place[b - 1] + 1))
            yield pa.RecordBatch.from_arrays([
                batch.column(0).take(pa.array([k[0] for k in keys])),
                batch.column(1).take(pa.array([k[0] for k in keys])),
                pa.array([k[1] for k in keys], pa.int64()),
                pa.array([best[k][0] for k in keys], pa.int64()),
                pa.array([len(best[k][3]) for k in keys], pa.int64()),
                pa.array(start, pa.int64()), pa.array(end, pa.int64()),
            ], ["row", "id", "item_id", "edits", "matched", "start", "end"])
    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
          item_col: str = "item_id", item_text: str = "text", edit_rate: float = EDIT_RATE,
          row_id=None) -> DataFrame:
    """One row per (input row, item found in it): (id, item_id, edits, matched,
    start, end); rows without a leak give none.

    ``edits`` is the least over the item's segments, ``matched`` the bytes of
    the normal item that found segments cover, ``start``/``end`` enclose all
    its found segments, in characters of the lower-cased text. Null and empty texts and items match nothing; items of
    fewer than 2 q bytes match verbatim and as whole words. Rows of one id are searched row for
    row, null ids stay; rows of one item id are segments of one item. An empty
    benchmark gives an empty result.

    The items are read in chunks of at most ``CHUNK_BYTES`` bytes (a longer
    item is its own chunk); each chunk is one pass over the texts."""
    spark = docs.sparkSession
    items = benchmark.select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("body"))
    items = items.where("item is not null and length(body) > 0")
    total = items.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    chunks = max(1, -(-2 * total // CHUNK_BYTES))
    d = docs.select((F.monotonically_increasing_id() if row_id is None else row_id).alias("row"),
                    F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    schema = f"row long, id {kind}, item_id long, edits long, matched long, start long, end long"
    out = spark.createDataFrame([], schema)
    for c in range(chunks if total else 0):
        part = items.where(F.pmod(F.xxhash64("item", "body"), F.lit(chunks)) == c).orderBy("item", "body").collect()
        chunk = tuple((r["item"], r["body"]) for r in part)
        out = out.union(d.mapInArrow(_match_rows(chunk, edit_rate), schema))
    if chunks > 1:                                          # rows of one item id may be in several chunks
        out = out.groupBy("row", "id", "item_id").agg(
            F.min("edits").alias("edits"), F.sum("matched").alias("matched"), F.min("start").alias("start"), F.max("end").alias("end"))
    return out.select("row", F.col("id").alias(id_col), "item_id", "edits", "matched", "start", "end")
