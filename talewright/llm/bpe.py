"""BPE encoding by backtracking over longest matches, decoding by offset table.

A token sequence is what the merges give exactly when (1) its tokens spell the
text and (2) every two neighbours are *compatible*: merging the text of the two
alone gives these two tokens. So a piece is encoded left to right: take the
longest token at the position (Aho-Corasick finds all matches in one pass); if
it is not compatible with the token before, take the next shorter token that is
its prefix; if none is left, drop the token before and shorten that one. Places
known to lead nowhere are marked, which bounds the work linearly.

Compatibility of a pair follows from the merge ranks: undo the later of the two
tokens' own merges again and again and look whether a merge across the border
would have come first. Answers are kept in a table of bounded size.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb

CACHE_ENTRIES = 200_000     # encoded cuts, encoded pieces and compatibility answers kept per worker, each

# Fixed values of byte-level BPE: the split pattern and the printable stand-ins of bytes.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


def byte_symbols() -> dict[str, int]:
    """Symbol of each byte: itself if printable, else the next from U+0100."""
    rest = [b for b in range(256) if b not in set(PRINTABLE)]
    return {chr(b): b for b in PRINTABLE} | {chr(0x100 + i): b for i, b in enumerate(rest)}


class BytePairCoder:
    """Encoder and decoder of one byte-level vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        symbols = byte_symbols()
        raw = {t: bytes(symbols[c] for c in t) for t in model["vocab"]}
        self.ids: dict[bytes, int] = {raw[t]: i for t, i in model["vocab"].items()}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = max([*model["vocab"].values(), *self.special.values()]) + 1
        self.token: list[bytes] = [b""] * size
        for b, i in self.ids.items():
            self.token[i] = b
        for t, i in self.special.items():
            self.token[i] = t.encode()
        # rank of a token: that of the merge that makes it; single bytes have none
        self.rank = [-1] * size
        self.parts: list[tuple[int, int] | None] = [None] * size
        self.merge: dict[tuple[int, int], int] = {}
        for r, pair in enumerate(model["merges"]):
            a, b = pair if not isinstance(pair, str) else pair.split(" ")
            x, y = self.ids[raw[a]], self.ids[raw[b]]
            whole = self.ids[raw[a] + raw[b]]
            self.merge[x, y] = r
            if self.parts[whole] is None:
                self.parts[whole], self.rank[whole] = (x, y), r
        # Only tokens that merging their own bytes yields can occur.
        self.find = ahocorasick.Automaton()
        for b, i in self.ids.items():
            self.find.add_word(b.decode("latin-1"), (len(b), i))
        self.find.make_automaton()
        self.shorter = [-1] * size
        for b, i in self.ids.items():
            for cut in range(len(b) - 1, 0, -1):
                if (j := self.ids.get(b[:cut])) is not None:
                    self.shorter[i] = j
                    break
        length = np.array([len(t) for t in self.token], np.int64)
        self.offset = np.r_[0, np.cumsum(length)]
        self.bytes = np.frombuffer(b"".join(self.token), np.uint8)
        self._fits: dict[int, bool] = {}
        self._pieces: dict[str, bytes] = {}
        self._chunks: dict[str, bytes] = {}
        self._split = regex.compile(SPLIT)
        self._special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        self._odd_space = regex.compile(r" (?=\s|\Z)")

    def fits(self, a: int, b: int) -> bool:
        """Whether merging the bytes of ``a`` then ``b`` gives just a, b."""
        known = self._fits.get(key := a << 20 | b)
        if known is None:
            known = self._undo(a, b)
            if len(self._fits) < 2 * CACHE_ENTRIES:
                self._fits[key] = known
        return known

    def _undo(self, a: int, b: int) -> bool:
        rank, parts, merge = self.rank, self.parts, self.merge
        # Seen backwards in time: ``a`` and ``b`` are the border tokens after all
        # merges of a rank below ``limit``. A merge across the border at a rank
        # below that of the one undone next (ties: the left place goes first)
        # would have come earlier and used one of them up.
        limit, strict = len(merge), True
        while True:
            m = merge.get((a, b))
            if m is not None and (m < limit or (m == limit and not strict)):
                return False
            ra, rb = rank[a], rank[b]
            if ra < 0 and rb < 0:
                return True
            if ra >= rb and ra >= 0 and not (ra == rb):
                limit, strict, a = ra, True, parts[a][1]
            elif ra == rb:
                # one rule made both: the left one first, so the right is undone first
                limit, strict, b = rb, False, parts[b][0]
            else:
                limit, strict, b = rb, False, parts[b][0]

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.ids.get(piece)
        if whole is not None and self._own(whole):
            return [whole]
        n = len(piece)
        longest = [0] * n
        pick = [-1] * n
        for end, (size, token) in self.find.iter(piece.decode("latin-1")):
            at = end - size + 1
            if size > longest[at]:
                longest[at], pick[at] = size, token
        out: list[int] = []
        dead = bytearray(n + 1)
        at, token = 0, pick[0]
        tokens, shorter, fits = self.token, self.shorter, self.fits
        while True:
            end = at + len(tokens[token])
            if not dead[end] and (not out or fits(out[-1], token)) and (out or self._own(token)):
                out.append(token)
                at = end
                if at == n:
                    return out
                token = pick[at]
                continue
            token = shorter[token]
            while token < 0:
                dead[at] = 1
                token = out.pop()
                at -= len(tokens[token])
                token = shorter[token]

    def _own(self, token: int) -> bool:
        """Whether merging a token's own bytes gives the token."""
        p = self.parts[token]
        return p is None and len(self.token[token]) == 1 or p is not None

    def _encode_plain(self, text: str) -> bytes:
        """Ids (little-endian 32 bit) of a text without special tokens."""
        pieces, out = self._pieces, []
        for p in self._split.findall(text):
            got = pieces.get(p)
            if got is None:
                got = np.array(self.encode_piece(p.encode()), "<u4").tobytes()
                if len(p) <= 64 and len(pieces) < CACHE_ENTRIES:
                    pieces[p] = got
            out.append(got)
        return b"".join(out)

    def _encode_spaced(self, text: str) -> bytes:
        """A piece always begins at a space that a non-space follows, so the
        text is cut there and equal cuts are encoded once."""
        if self._odd_space.search(text):
            cuts, glued = text.split(" "), []
            for c in cuts:  # a space before white space or the end is no cut
                if glued and (not c or c[0].isspace()):
                    glued[-1] += " " + c
                else:
                    glued.append(c)
            cuts = glued
        else:
            cuts = text.split(" ")
        chunks = self._chunks
        out = [self._encode_plain(cuts[0])]
        rest = cuts[1:]
        found = list(map(chunks.get, rest))
        if None in found:
            for i, got in enumerate(found):
                if got is None:
                    c = rest[i]
                    got = self._encode_plain(" " + c)
                    if len(c) <= 64 and len(chunks) < CACHE_ENTRIES:
                        chunks[c] = got
                    found[i] = got
        return b"".join(out + found)

    def encode(self, text: str) -> np.ndarray:
        """Ids of a whole text; strings of special tokens become their ids."""
        if self._special is None or not any(s in text for s in self.special):
            return np.frombuffer(self._encode_spaced(text), "<u4") if text else np.zeros(0, "<u4")
        out = [np.array([self.special[p]], "<u4") if p in self.special else np.frombuffer(self._encode_spaced(p), "<u4")
               for p in self._special.split(text) if p]
        return np.concatenate(out) if out else np.zeros(0, "<u4")

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, gathered from the table of token offsets."""
        ids = ids.astype(np.int64)
        start = self.offset[ids]
        size = self.offset[ids + 1] - start
        end = np.cumsum(size)
        if not len(ids):
            return b""
        at = np.arange(end[-1]) + np.repeat(start - end + size, size)
        return self.bytes[at].tobytes()


@lru_cache(maxsize=2)
def coder(path: str) -> BytePairCoder:
    """One coder per worker process and vocabulary file."""
    return BytePairCoder(path)


def _rows(path: str, id_first: bool, full: bool) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = coder(path)
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            count, sha, dsha, ids_out, text_out = [], [], [], [], []
            for t in texts:
                ids = c.encode(t.as_py() or "")
                back = c.decode_bytes(ids).decode("utf-8", "replace")
                if full:
                    ids_out.append(ids.astype(np.int32))
                    text_out.append(back)
                else:
                    count.append(len(ids))
                    sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    dsha.append(hashlib.sha256(back.encode()).hexdigest())
            if full:
                cols, extra = [pa.array(ids_out, pa.list_(pa.int32())), pa.array(text_out, pa.string())], ["ids", "decoded"]
            else:
                cols, extra = [pa.array(count, pa.int64()), pa.array(sha, pa.string()), pa.array(dsha, pa.string())], ["n_tokens", "ids_sha256", "decoded_sha256"]
            yield pa.RecordBatch.from_arrays([*rest, *cols], [*names, *extra])
    return run


def encode_documents(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, ids, decoded) for every row: the token ids of the whole text and
    the text they decode to. Null texts count as empty (no ids); null ids and
    repeated rows stay, row for row; other columns are not read. ``vocabulary``
    is a byte-level BPE file that every executor can read."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    out = d.mapInArrow(_rows(vocabulary, True, True), f"id {kind}, ids array<int>, decoded string")
    return out.withColumnRenamed("id", id_col)


def token_digests(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256): as :func:`encode_documents`,
    with digests (ids as little-endian unsigned 32 bit, text as UTF-8) in place
    of the ids and texts themselves."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    out = d.mapInArrow(_rows(vocabulary, True, False), f"id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return out.withColumnRenamed("id", id_col)
