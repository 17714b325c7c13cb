"""Token-id output with Re-Pair grammar compression.

Documents are written in ascending id order as shards of bounded size. In a
shard frequent pairs of ids are replaced by nonterminals again and again: a
round counts all neighbouring pairs, gives each of the most frequent ones a
nonterminal and replaces its places left to right. No nonterminal crosses a
document's end. A shard stores its rules, the length every rule expands to and
where each document's symbols begin, so one document is decoded alone.

Layout of a shard, little-endian: the magic ``TWRP0001``; five u64 (documents,
rules, first nonterminal, symbols, ids); then the arrays: rules (2 x u32 each),
expansion lengths (u32), document ids (i64), first symbol of each document plus
the end (u32), ids of each document (u32), symbols (u32).
"""

from __future__ import annotations

import gc
import os
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import land

SHARD_IDS = 1 << 20        # ids of a shard (a longer document is its own shard)
ROUNDS = 10
PAIRS_PER_ROUND = 2048
LEAST_USES = 8             # a rule that is used less often costs more than it saves
MAGIC = b"TWRP0001"
_BITS = 18


class Grammar:
    """Rules over ids below ``base``; nonterminal ``base + i`` is rule i."""

    def __init__(self, base: int, left: np.ndarray, right: np.ndarray, size: np.ndarray):
        self.base, self.left, self.right, self.size = base, left, right, size

    @staticmethod
    def build(ids: np.ndarray, ends: np.ndarray, base: int) -> tuple[Grammar, np.ndarray, np.ndarray]:
        """(grammar, symbols, end of each document in the symbols)."""
        seq = ids.astype(np.uint32)
        last = np.zeros(len(seq), bool)
        last[ends[ends > 0] - 1] = True
        left, right, size = [], [], np.zeros(0, np.int64)
        made = 0
        for _ in range(ROUNDS):
            if len(seq) < 2 * LEAST_USES:
                break
            a, b = seq[:-1], seq[1:]
            h = ((a * np.uint32(0x9E3779B1) + b * np.uint32(0x85EBCA77)) >> np.uint32(32 - _BITS)).astype(np.int64)
            h[last[:-1]] = 1 << _BITS                       # no pair begins at a document's end
            count = np.bincount(h, minlength=(1 << _BITS) + 1)[:-1]
            top = np.argpartition(-count, PAIRS_PER_ROUND)[:PAIRS_PER_ROUND]
            top = top[count[top] >= LEAST_USES]
            if not len(top):
                break
            place = np.zeros((1 << _BITS) + 1, np.int64)    # one place of the pairs of each slot
            place[h] = np.arange(len(h))
            pa_, pb = a[place[top]], b[place[top]]
            rule = np.full((1 << _BITS) + 1, -1, np.int32)
            rule[top] = np.arange(len(top))
            at = np.flatnonzero(rule[h] >= 0)
            r = rule[h[at]]
            fits = (a[at] == pa_[r]) & (b[at] == pb[r])
            at, r = at[fits], r[fits]
            at, r = _apart(at, r)
            uses = np.bincount(r, minlength=len(top))
            keep = uses >= LEAST_USES
            if not keep.any():
                break
            number = np.cumsum(keep) - 1
            at, r = at[keep[r]], r[keep[r]]
            x, y = pa_[keep], pb[keep]
            length = lambda s, size=size: np.where(s < base, 1, size[np.maximum(s.astype(np.int64) - base, 0)] if len(size) else 1)
            size = np.r_[size, length(x) + length(y)]
            left.append(x)
            right.append(y)
            before = len(seq)
            seq = seq.copy()
            seq[at] = (base + made + number[r]).astype(np.uint32)
            last[at] = last[at + 1]
            stay = np.ones(len(seq), bool)
            stay[at + 1] = False
            seq, last = seq[stay], last[stay]
            made += int(keep.sum())
            if len(at) < 0.005 * before:
                break
        none = np.zeros(0, np.uint32)
        g = Grammar(base, np.concatenate(left) if left else none, np.concatenate(right) if right else none, size)
        return g, seq, np.flatnonzero(last) + 1

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """(flat expansions of all rules, offsets), built rule by rule length."""
        offset = np.r_[0, np.cumsum(self.size)]
        flat = np.zeros(int(offset[-1]), np.uint32)
        for i, (x, y) in enumerate(zip(self.left.tolist(), self.right.tolist(), strict=True)):
            o = offset[i]
            for s in (x, y):
                if s < self.base:
                    flat[o] = s
                    o += 1
                else:
                    k = s - self.base
                    n = self.size[k]
                    flat[o:o + n] = flat[offset[k]:offset[k] + n]
                    o += n
        return flat, offset

    def expand(self, symbols: np.ndarray, table: tuple[np.ndarray, np.ndarray] | None = None) -> np.ndarray:
        flat, offset = table or self.table()
        s = symbols.astype(np.int64)
        rule = s >= self.base
        k = np.where(rule, s - self.base, 0)
        size = np.where(rule, self.size[k] if len(self.size) else 1, 1)
        end = np.cumsum(size)
        if not len(end):
            return np.zeros(0, np.uint32)
        out = np.repeat(symbols, size)
        wide = np.repeat(rule, size)
        within = np.arange(end[-1]) - np.repeat(end - size, size)
        src = np.repeat(offset[k], size) + within
        out[wide] = flat[src[wide]]
        return out


def _apart(at: np.ndarray, r: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of places that overlap (neighbours) every second one, from the left."""
    if len(at) < 2:
        return at, r
    joined = np.r_[False, at[1:] == at[:-1] + 1]
    start = np.maximum.accumulate(np.where(joined, 0, np.arange(len(at))))
    keep = (np.arange(len(at)) - start) % 2 == 0
    return at[keep], r[keep]


def pack(doc_ids: list[int | None], counts: np.ndarray, ids: np.ndarray, base: int) -> bytes:
    ends = np.cumsum(counts)
    g, symbols, symbol_ends = Grammar.build(ids, ends, base)
    rules = np.stack([g.left, g.right], axis=1) if len(g.left) else np.zeros((0, 2), np.uint32)
    head = np.array([len(doc_ids), len(g.left), base, len(symbols), len(ids)], "<u8")
    names = np.array([np.iinfo(np.int64).min if d is None else d for d in doc_ids], "<i8")
    return b"".join([MAGIC, head.tobytes(), rules.astype("<u4").tobytes(), g.size.astype("<u4").tobytes(), names.tobytes(),
                     np.r_[0, symbol_ends].astype("<u4").tobytes(), counts.astype("<u4").tobytes(), symbols.astype("<u4").tobytes()])


class Shard:
    """Reader of one shard."""

    def __init__(self, blob: bytes | memoryview):
        if bytes(blob[:8]) != MAGIC:
            raise ValueError("not a shard of this format")
        docs, rules, base, symbols, self.total = np.frombuffer(blob, "<u8", 5, 8).tolist()
        at = 48

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(blob, kind, n, at)
            at += got.nbytes
            return got

        pairs = take("<u4", 2 * rules).reshape(-1, 2)
        self.grammar = Grammar(base, pairs[:, 0], pairs[:, 1], take("<u4", rules).astype(np.int64))
        self.doc_ids, self.first, self.counts, self.symbols = take("<i8", docs), take("<u4", docs + 1), take("<u4", docs), take("<u4", symbols)

    def document(self, i: int) -> np.ndarray:
        """Ids of document ``i`` alone."""
        return self.grammar.expand(self.symbols[self.first[i]:self.first[i + 1]])

    def all(self) -> np.ndarray:
        return self.grammar.expand(self.symbols)


class ChunkEncoder:
    """The library's ids of texts cut at single spaces and line ends. The
    vocabulary's tokens hold no white space and its split drops it, so the ids
    of a text are those of its cuts; equal cuts are encoded once.

    A new cut of letters with punctuation after them is those two in its split
    as well. Unknown letter runs are given to the library many at once, joined
    by spaces: each is one word, so its ids end at the first word-end token."""

    CUTS, WORDS = 400_000, 600_000      # entries kept per worker
    JOIN = 512
    TAIL = ".,;:!?|%&*$#-_=+/()[]{}"

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.ends = np.zeros(self.size, bool)
        for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items():
            self.ends[i] = token.endswith("</w>")
        self.known: dict[str, bytes] = {"": b""}
        self.words: dict[str, bytes] = {"": b""}

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, words: list[str]) -> list[bytes]:
        """Ids of words of letters only."""
        groups = [words[i:i + self.JOIN] for i in range(0, len(words), self.JOIN)]
        out: list[bytes] = []
        for group, joined in zip(groups, self._each([" ".join(g) for g in groups]), strict=True):
            ids = np.frombuffer(joined, "<u4")
            cut = 4 * (np.flatnonzero(self.ends[ids]) + 1)
            if len(cut) == len(group) and cut[-1] == len(joined):
                out += [joined[a:b] for a, b in zip([0, *cut.tolist()], cut.tolist(), strict=False)]
            else:
                out += self._each(group)
        return out

    def _new(self, lost: list[str]) -> dict[str, bytes]:
        words, tail_bytes = self.words, self.TAIL
        letters, other, parts = set(), set(), []
        for w in lost:
            core = w.rstrip(tail_bytes)
            if core.isascii():
                plain, key = core.isalpha(), core.lower()
            else:
                plain, key = core.isalpha() and core.lower().isalpha(), core
            if plain:
                if key not in words:
                    letters.add(key)
                tail = w[len(core):]
                if tail and tail not in words:
                    other.add(tail)
                parts.append((w, key, tail))
            else:
                other.add(w)
        fresh = list(letters)
        new = dict(zip(fresh, self._letters(fresh), strict=True))
        rest = list(other)
        new.update(zip(rest, self._each(rest), strict=True))
        if len(words) < self.WORDS and max(map(len, new), default=0) <= 64:
            words.update(new)
            found = {w: words[key] + words[tail] for w, key, tail in parts}
        else:
            found = {}
            for w, key, tail in parts:
                b = words.get(key)
                t = words.get(tail)
                found[w] = (new[key] if b is None else b) + (new[tail] if t is None else t)
        if len(parts) < len(lost):
            done = found.keys()
            found.update((w, new[w] if w in new else words[w]) for w in lost if w not in done)
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids (little-endian 32 bit) of each text."""
        cuts = [t.replace("\n", " ").split(" ") if t else [] for t in texts]
        known = self.known
        found = [list(map(known.get, c)) for c in cuts]
        lost = list({w for c, f in zip(cuts, found, strict=True) if None in f for w, g in zip(c, f, strict=True) if g is None})
        if lost:
            new = self._new(lost)
            for c, f in zip(cuts, found, strict=True):
                if None in f:
                    for i, g in enumerate(f):
                        if g is None:
                            f[i] = new[c[i]]
            if len(known) < self.CUTS:
                known.update(new if max(map(len, lost)) <= 64 else {w: b for w, b in new.items() if len(w) <= 64})
        return [b"".join(f) for f in found]


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    return ChunkEncoder(path)


def _write_shards(path: str, end_id: int, shard_ids: int) -> Callable:
    names = ["part", "shard", "n_docs", "n_ids", "payload"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        base = max(enc.size, end_id + 1)
        part, shard = TaskContext.get().partitionId(), 0
        end = np.array([end_id], "<u4").tobytes()
        ids: list[bytes] = []
        docs: list[int | None] = []
        held = 0

        def flush() -> pa.RecordBatch:
            nonlocal ids, docs, held, shard
            counts = np.array([len(b) // 4 for b in ids], np.int64)
            blob = pack(docs, counts, np.frombuffer(b"".join(ids), "<u4"), base)
            row = [part, shard, len(docs), int(counts.sum()), blob]
            ids, docs, held, shard = [], [], 0, shard + 1
            return pa.RecordBatch.from_arrays(
                [pa.array([v], k) for v, k in zip(row, (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names)

        # no cycles are made here: the collector would only walk the long lists
        gc.disable()
        try:
            for batch in batches:
                for lo in range(0, batch.num_rows, 128):
                    rows = batch.slice(lo, 128)
                    for d, b in zip(rows.column(0).to_pylist(), enc.encode(rows.column(1).to_pylist()), strict=True):
                        docs.append(d)
                        ids.append(b + end)
                        held += len(b) // 4 + 1
                        if held >= shard_ids:
                            yield flush()
            if docs:
                yield flush()
        finally:
            gc.enable()
    return run


def write_ids(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
              shard_ids: int = SHARD_IDS) -> DataFrame:
    """Shards (part, shard, n_docs, n_ids, payload) of all documents' ids, each
    with ``end_id`` appended, in ascending id order over (part, shard); the
    caller writes them where they belong. Null texts are empty (the end id
    alone); rows with a null id come first; rows of one id follow each other in
    the order of their texts. Texts of any length are whole; a very long one is
    a shard of its own. Other columns are not read."""
    d = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    d = d.repartitionByRange("id").sortWithinPartitions("id", "text")
    return d.mapInArrow(_write_shards(vocabulary, end_id, shard_ids), "part long, shard long, n_docs long, n_ids long, payload binary")


def _read_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lowest = np.iinfo(np.int64).min
    for batch in batches:
        for part, shard, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
            s = Shard(blob.as_buffer().to_pybytes())
            ids = s.all().astype("<u4")
            ends = np.cumsum(s.counts.astype(np.int64))
            starts = ends - s.counts
            view = memoryview(ids.tobytes())
            crc = [zlib.crc32(view[4 * a:4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            n = len(crc)
            yield pa.RecordBatch.from_arrays([
                pa.array(np.full(n, part), pa.int64()), pa.array(np.full(n, shard), pa.int64()),
                pa.array(s.doc_ids, pa.int64(), mask=s.doc_ids == lowest), pa.array(starts, pa.int64()),
                pa.array(s.counts, pa.int64()), pa.array(crc, pa.int64()),
            ], ["part", "shard", "id", "within", "n_tokens", "ids_crc32"])


def read_digests(shards: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document, decoded from the
    shards: the number of ids before it, of its own ids, and their checksum."""
    sizes = shards.select("part", "shard", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n"))
    # one row per written partition
    before = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("parts_before"))
    own = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    place = sizes.join(before, "part").select("part", "shard", (F.col("parts_before") + F.coalesce(F.sum("n_ids").over(own), F.lit(0))).alias("before"))
    rows = shards.select("part", "shard", "payload").mapInArrow(
        _read_shards, "part long, shard long, id long, within long, n_tokens long, ids_crc32 long")
    rows = rows.join(place, ["part", "shard"])
    return rows.select(F.col("id").alias(id_col), (F.col("before") + F.col("within")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, vocabulary: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the shards into the shared folder and read every document back."""
    return read_digests(land(write_ids(docs, vocabulary, end_id, id_col, text_col)), id_col)
