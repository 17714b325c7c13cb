"""Numpy helpers over the UTF-8 bytes of Arrow text columns, used inside Spark
tasks: bounded sub-batches, word spans, word hashes and rolling k-gram hashes.

All hashes are 64 bit and depend on the bytes only (fixed seeds), so every
task, retry and session computes the same values.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 20      # text bytes handled at once inside a task

_GOLD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer: every input bit reaches every output bit."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BYTE_CODE = mix((np.arange(1, 257, dtype=np.uint64)) * _GOLD)

_pow: np.ndarray = np.ones(1, np.uint64)
_inv: np.ndarray = np.ones(1, np.uint64)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """``_BASE**i`` and its inverses for i < n, grown by doubling."""
    global _pow, _inv
    if len(_pow) < n:
        size = 1 << int(n - 1).bit_length()
        out = []
        for b in (_BASE, pow(_BASE, -1, 1 << 64)):
            p, step = np.ones(1, np.uint64), b
            while len(p) < size:
                p = np.concatenate([p, p * np.uint64(step)])
                step = step * step % (1 << 64)
            out.append(p)
        _pow, _inv = out
    return _pow[:n], _inv[:n]


def ascii_lower_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = ascii_lower_table()


def byte_class(pattern: list[tuple[int, int]]) -> np.ndarray:
    """Boolean table of the bytes in the given inclusive ranges."""
    t = np.zeros(256, bool)
    for a, b in pattern:
        t[a:b + 1] = True
    return t


#: Bytes of a word that ends at ASCII white space.
NOT_SPACE = ~byte_class([(0x20, 0x20), (0x09, 0x0D)])
#: Bytes of a word of digits, letters and everything beyond ASCII (text is
#: lower-cased before, so upper-case letters count as letters here).
ALNUM = byte_class([(0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A), (0x80, 0xFF)])


def text_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; nulls are empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    col = column.cast(pa.large_binary())
    if col.null_count:
        col = col.fill_null(b"")
    _, off, data = col.buffers()
    offs = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1] if len(col) else np.zeros(1, np.int64)
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return buf[offs[0]:offs[-1]], offs - offs[0]


def blocks(batches: Iterator[pa.RecordBatch], text: str = "text",
           limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most ``limit`` bytes of text each (one
    row at least), with the bytes and row offsets of their texts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        buf, offs = text_bytes(batch.column(batch.schema.get_field_index(text)))
        lo, n = 0, batch.num_rows
        while lo < n:
            hi = int(np.searchsorted(offs, offs[lo] + limit, side="right")) - 1
            hi = min(max(hi, lo + 1), n)
            yield batch.slice(lo, hi - lo), buf[offs[lo]:offs[hi]], offs[lo:hi + 1] - offs[lo]
            lo = hi


def word_spans(buf: np.ndarray, offs: np.ndarray, in_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first word of each row + total) of the maximal runs of
    ``in_word`` bytes; a run never crosses a row boundary."""
    n = len(buf)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(offs), np.int64)
    m = np.zeros(n + 1, bool)
    m[:n] = in_word[buf]
    cut = np.zeros(n + 1, bool)
    cut[offs] = True
    first = m.copy()
    first[1:] &= ~m[:-1] | cut[1:]
    last = m[:n] & (~m[1:] | cut[1:])
    start = np.flatnonzero(first[:n])
    end = np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offs)


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = True) -> np.ndarray:
    """Hash of the bytes of every span (A-Z lower-cased first)."""
    if not len(start):
        return np.zeros(0, np.uint64)
    p, inv = _powers(len(buf) + 1)
    code = _BYTE_CODE[LOWER] if lower else _BYTE_CODE
    c = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(code[buf] * p[:-1], out=c[1:])
    return mix((c[end] - c[start]) * inv[start] + (end - start).astype(np.uint64) * _GOLD)


def kgram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k consecutive values (length n - k + 1, empty if n < k)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    p, inv = _powers(len(h) + 1)
    c = np.zeros(len(h) + 1, np.uint64)
    np.cumsum(h * p[:-1], out=c[1:])
    return mix((c[k:] - c[:-k]) * inv[:n] + np.uint64(k))


def in_row(first: np.ndarray, n_words: int, k: int) -> np.ndarray:
    """Mask of the word positions at which k words of the same row begin."""
    ok = np.ones(max(n_words - k + 1, 0), bool)
    for b in first[1:-1].tolist():
        ok[max(b - k + 1, 0):b] = False
    return ok


def word_hash_of(phrase: str) -> np.ndarray:
    """Hashes of the ALNUM words of a short phrase (templates, lexicons)."""
    buf = np.frombuffer(phrase.encode(), np.uint8)
    s, e, _ = word_spans(buf, np.array([0, len(buf)]), ALNUM)
    return span_hashes(buf, s, e)


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def list_column(values: np.ndarray, first: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and row offsets."""
    return pa.ListArray.from_arrays(pa.array(first, pa.int32()), pa.array(values, kind))
