"""N-gram Jaccard join with multiple global orders.

Sorted by any one order of all tokens, two sets of Jaccard similarity t share a
token in their prefixes, the first |x| - ceil(t |x|) + 1 tokens. That holds for
every order at once, so a pair is a candidate only if the prefixes meet under
each of several orders. All orders put rare tokens first (by the number of
documents, counted over the whole corpus into a table of fixed size); tokens of
about the same count stand in another random sequence in each of them.

Plan: (1) token counts of the corpus; (2) one pass over the texts gives set
size, set digest and the prefixes; equal sets collapse to one class; (3) the
classes meet in the buckets of their first order's prefix tokens. In a bucket
the smallest class is paired with each other one; pairs whose parity maps (a few
bits for each token of the set) differ in more places than linked sets may
differ in tokens are dropped, then those that miss each other
under another order, the rest is confirmed on the full sets and
joined to components. (4) Buckets whose other members are of several components
still (buckets of the same members count once) are compared across components
in blocks of bounded size, texts of about one size together: size and place of
the token, the parity maps of the sets, then the number of tokens that the prefixes
must share, first bounded by bit maps of them, under each order, every pair in the bucket of its first common token
alone; pairs that span the candidates of a block are confirmed first, and the
full sets of what is left apart are compared. No
link between different texts is lost; how well the counts separate rare from
frequent tokens only changes the number of candidates.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .minhash import FILTER_BITS, _linked, _set_rows, shingle_sets
from .shared import components, land

ORDERS = 3
CELLS = 1 << 18            # cells of the count table; a class of counts is one byte
MAP_BITS = 1024            # bits of a prefix's bit map
SIZE_BAND = 4              # a band of sizes is this many times as wide (in logarithms) as a link's sizes may differ
BLOCK_MEMBERS = 256        # members of a torn bucket compared at once with those of another block

_SALT = [0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0, 0x082EFA98EC4E6C89]


def _cell(tokens: np.ndarray, cells: int) -> np.ndarray:
    return (tokens >> np.uint64(65 - cells.bit_length())).astype(np.int64)


def _cell_rows(k: int, word: np.ndarray, cells: int) -> Callable:
    """(cell, documents) of a whole task, cells without a document left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(cells, np.int64)
        for _, buf, offs in tb.blocks(batches):
            sets, _ = shingle_sets(buf, offs, k, word)
            at, n = np.unique(_cell(sets, cells), return_counts=True)
            count[at] += n
        some = np.flatnonzero(count)
        for lo in range(0, len(some), 1 << 16):
            part = some[lo:lo + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(count[part])], ["cell", "n"])
    return run


def count_classes(docs: DataFrame, k: int, word: np.ndarray, cells: int = CELLS) -> np.ndarray:
    """Half steps of the binary logarithm of each cell's document count, over
    the whole corpus: one byte for each of ``cells`` (a power of two), whatever
    the input."""
    counts = docs.select("text").mapInArrow(_cell_rows(k, word, cells), "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    level = F.floor(2 * F.log2(F.col("n") + 1)).cast("int")
    got = counts.select("cell", level.alias("level")).toArrow()     # at most so many rows as cells
    out = np.zeros(cells, np.uint8)
    out[got["cell"].to_numpy()] = got["level"].to_numpy()
    return out


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    """Tokens of a set of ``n`` of which a linked set has one in its prefix."""
    return n - (percent * n + 99) // 100 + 1


def prefixes(sets: np.ndarray, first: np.ndarray, classes: np.ndarray, percent: int, orders: range) -> list[np.ndarray]:
    """Prefix tokens of every row under each of the orders, as 64-bit places of
    the order, row after row."""
    size = np.diff(first)
    row = np.repeat(np.arange(len(size)), size)
    at = np.arange(len(sets)) - first[:-1][row]
    inside = at < prefix_size(size, percent)[row]
    rank = classes[_cell(sets, len(classes))].astype(np.uint64) << np.uint64(56)
    out = []
    for o in orders:
        place = rank | (tb.mix(sets ^ np.uint64(_SALT[o])) >> np.uint64(8))
        out.append(place[np.lexsort((place, row))][inside])
    return out


def parity_maps(sets: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, row ends) of a map of each set: a bit tells whether an odd number
    of its tokens falls there, so maps of two sets differ in no more bits than
    the sets in tokens. Two to four bits a token, a power of two and 64 at least:
    the two halves of a map, one xor the other, are the map of half the width."""
    size = np.diff(first)
    width = np.where(size > 0, np.maximum(64, 1 << (1 + np.ceil(np.log2(np.maximum(size, 1))).astype(np.int64))), 0)
    ends = np.r_[0, np.cumsum(width)]
    row = np.repeat(np.arange(len(size)), size)
    at = (tb.mix(sets ^ np.uint64(_SALT[3])) & (width[row] - 1).astype(np.uint64)).astype(np.int64)
    odd = np.zeros(ends[-1], bool)
    token, n = np.unique(ends[row] + at, return_counts=True)
    odd[token[n % 2 == 1]] = True
    return np.packbits(odd, bitorder="little"), ends // 8


def _folded(maps: np.ndarray, words: int) -> np.ndarray:
    """The maps (rows of 64-bit words) at a smaller width."""
    while (half := maps.shape[-1] // 2) >= words:
        maps = maps[..., :half] ^ maps[..., half:]
    return maps


def most_apart(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that only one of two linked sets of sizes n and m has, at most."""
    return n + m - 2 * common_tokens(n, m, percent)


def _near(percent: int) -> Callable:
    """The pairs (a, b) of rows with both ends' sizes and maps whose maps allow
    a link."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            most = most_apart(*(batch.column(f"{e}_n").to_numpy() for e in "ab"), percent)
            keep = np.zeros(batch.num_rows, bool)
            for i, ends in enumerate(zip(batch.column("a_map"), batch.column("b_map"), strict=True)):
                x, y = (np.frombuffer(e.as_buffer(), np.uint64) for e in ends)
                words = min(len(x), len(y))
                keep[i] = np.bitwise_count(_folded(x, words) ^ _folded(y, words)).sum(dtype=np.int64) <= most[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _profile_rows(k: int, percent: int, word: np.ndarray, classes: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, buf, offs in tb.blocks(batches):
            sets, first = shingle_sets(buf, offs, k, word)
            size = np.diff(first)
            some = size > 0
            digests = [np.add.reduceat(np.r_[tb.mix(sets ^ np.uint64(s)), np.uint64(0)], first[:-1]) for s in (0, _SALT[3])]
            ends = np.r_[0, np.cumsum(np.where(some, prefix_size(size, percent), 0))]
            place, = prefixes(sets, first, classes, percent, range(1))
            maps, map_ends = parity_maps(sets, first)
            blob = pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(map_ends.astype(np.int32).tobytes()), pa.py_buffer(maps.tobytes())])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(size, pa.int64()),
                 *[pa.array(tb.signed(d), pa.int64(), mask=~some) for d in digests],
                 tb.list_column(tb.signed(place), ends, pa.int64()), blob], ["id", "n", "d1", "d2", "prefix", "map"])
    return run


def _prefix_rows(percent: int, classes: np.ndarray, orders: range) -> Callable:
    """Prefixes of full sets under the orders: whole places of the first order
    (0), which tell which of two tokens comes first, 32 bits of the others'."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(1)]
            first = np.r_[0, np.cumsum([len(r) for r in rows])].astype(np.int64)
            size = np.diff(first)
            ends = np.r_[0, np.cumsum(np.where(size > 0, prefix_size(size, percent), 0))]
            sets = np.concatenate(rows) if rows else np.zeros(0, np.uint64)
            lists = [tb.list_column(p.astype(np.uint32).view(np.int32), ends, pa.int32()) if o else tb.list_column(tb.signed(p), ends, pa.int64())
                     for o, p in zip(orders, prefixes(sets, first, classes, percent, orders), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *lists], ["rep", *[f"p{o}" for o in orders]])
    return run


def _bit_maps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, bits) of rows (id, prefix): the set bits of the prefix's tokens."""
    for batch in batches:
        flat, first = batch.column(1).flatten().to_numpy(), batch.column(1).offsets.to_numpy()
        bits = np.zeros((batch.num_rows, MAP_BITS), bool)
        at = tb.mix(flat.view(np.uint64)) >> np.uint64(65 - MAP_BITS.bit_length())
        bits[np.repeat(np.arange(batch.num_rows), np.diff(first)), at.astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([r.tobytes() for r in np.packbits(bits, axis=1)], pa.binary())], ["rep", "bits"])


def _meeting(percent: int, orders: list[str]) -> Callable:
    """The pairs (a, b) of rows with both ends' sizes and prefixes whose
    prefixes share enough tokens under each order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a_n, b_n = (batch.column(f"{e}_n").to_numpy() for e in "ab")
            least = common_prefix_tokens(a_n, b_n, percent)
            keep = np.ones(batch.num_rows, bool)
            for o in orders:
                for i, (x, y) in enumerate(zip(batch.column(f"a_{o}"), batch.column(f"b_{o}"), strict=True)):
                    keep[i] = keep[i] and np.isin(x.values.to_numpy(), y.values.to_numpy()).sum() >= least[i]
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return run


def _with_pivots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, rep, pos, pivot) of rows (key, rep, pos) in order: every row but the
    first of its key, with that first row's class."""
    last, held = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        key, rep = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        fresh = np.r_[key[0] != last, key[1:] != key[:-1]]
        at = np.maximum.accumulate(np.where(fresh, np.arange(len(key)), -1))
        pivot = np.where(at < 0, held, rep[at])
        last, held = key[-1], pivot[-1]
        more = ~fresh
        pos = batch.column(2).to_numpy()
        yield pa.RecordBatch.from_arrays([pa.array(c[more]) for c in (key, rep, pos, pivot)], ["key", "rep", "pos", "pivot"])


def _confirm(percent: int) -> Callable:
    """Links of rows (a, salt, b, elements) in the order of a and salt, the sets
    of a itself (b null) before those of its partners."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, own = None, []
        for batch in batches:
            found = []
            for a, salt, b, blob in zip(*(batch.column(c).to_pylist() for c in range(3)), batch.column(3), strict=True):
                if at != (a, salt):
                    at, own = (a, salt), []
                elements = np.frombuffer(blob.as_buffer(), np.uint64)
                if b is None:
                    own.append(elements.copy())
                elif any(_linked(x, elements, percent) for x in own):
                    found.append((a, b))
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], ["a", "b"])
    return run


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the similarity. Each partner's set goes
    to its ``a`` once; a class of many partners is dealt over several tasks. The
    sets meet all rows that need them in one join."""
    salts = F.ceil(F.count("*") / BLOCK_MEMBERS).cast("int")
    ends = pairs.groupBy("a").agg(salts.alias("salts"))
    salt = F.pmod(F.xxhash64("b"), F.col("salts")).cast("int")
    partners = pairs.join(ends, "a").select(F.col("b").alias("id"), "a", salt.alias("salt"), "b")
    own = ends.select(F.col("a").alias("id"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("long").alias("b"))
    rows = partners.union(own).join(sets, "id").select("a", "salt", "b", "elements")
    rows = rows.repartition("a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    return land(rows.mapInArrow(_confirm(percent), "a long, b long").distinct())


def _sets_of(ids: DataFrame, docs: DataFrame, k: int, word: np.ndarray) -> DataFrame:
    """(id, elements) of the given ids. Texts whose id's bit is not set in a map
    of 2**24 bits (the only thing broadcast) are not shuffled; inner joins, as a
    semi join would be pushed below the map. Repeated rows give repeated sets."""
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    own = F.expr("shiftleft(1L, cast(bit & 63 as int))")
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(F.bit_or(own).alias("mask"))
    near = docs.withColumn("bit", bit).withColumn("w", F.shiftright("bit", 6)).join(F.broadcast(words), "w")
    near = near.where(F.col("mask").bitwiseAND(own) != 0).select("id", "text")
    return near.join(ids.distinct().hint("merge"), "id").mapInArrow(_set_rows(k, word), "id long, elements binary")


def _on_ends(pairs: DataFrame, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Pairs (a, b) with the columns of both classes' rows, as a_<name>, b_<name>."""
    for end in ("a", "b"):
        pairs = pairs.join(rows.select(F.col("rep").alias(end), *[F.col(c).alias(f"{end}_{c}") for c in columns]), end)
    return pairs


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of equal ``keys``, which follow each other."""
    held: list[pa.RecordBatch] = []
    now = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in keys])
        cuts = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, batch.num_rows]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if now != (at := tuple(key[:, lo])):
                if held:
                    yield pa.Table.from_batches(held)
                held, now = [], at
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


_BLOCK = ["key", "band", "i", "j"]
_MEMBER = [*_BLOCK, "blk", "rep", "home", "pos", "n", "component"]


def common_tokens(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that linked sets of sizes n and m share at least."""
    return -(-percent * (n + m) // (100 + percent))


def common_prefix_tokens(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Tokens that the prefixes of linked sets of sizes n and m share at least.
    They share o tokens; the first c common tokens have o - c common ones behind
    them, so they stand among the first n - o + c and m - o + c tokens, which the
    prefixes hold."""
    return common_tokens(n, m, percent) + np.minimum(prefix_size(n, percent) - n, prefix_size(m, percent) - m)


def _partners(run: pa.Table, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(member, members of the other block, of another component, of a size that
    allows a link, and with enough tokens left from the bucket's token on).
    Two visitors of a band of sizes meet in the band that is their home."""
    rep, comp, n, blk, home, pos = (run[c].to_numpy() for c in ("rep", "component", "n", "blk", "home", "pos"))
    i, j, band = (run[c][0].as_py() for c in ("i", "j", "band"))
    left = n - pos
    right = np.flatnonzero(blk == j)
    for u in np.flatnonzero(blk == i).tolist():
        v = right[(comp[right] != comp[u]) & ((rep[right] > rep[u]) | (i != j)) & ((home[right] == band) | (home[u] == band))]
        fits = 100 * np.minimum(n[v], n[u]) >= percent * np.maximum(n[v], n[u])
        yield u, v[fits & (np.minimum(left[v], left[u]) >= common_tokens(n[u], n[v], percent))]


def _lists(run: pa.Table, order: str) -> tuple[np.ndarray, np.ndarray]:
    column = run[order].combine_chunks()
    return column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()


def _candidates(run: pa.Table, percent: int, orders: list[str]) -> Iterator[tuple[int, np.ndarray]]:
    """(member, partners by size and component whose prefixes share enough
    tokens under each of the orders, or may do so by their bit maps if one of the
    orders is ``bits``, or whose sets' maps allow a link if one is ``map``). A pair with a common token before the
    bucket's (under the first order, ``p0``) belongs to an earlier bucket: to
    that of its first common token, or to one of the same members before it; if
    one of the pair was paired there with all others, it was confirmed then."""
    n, key = run["n"].to_numpy(), run["key"][0].as_py()
    if by_parity := "map" in orders:
        maps = [np.frombuffer(x.as_buffer(), np.uint64) for x in run["map"]]
        words = np.array([len(x) for x in maps])
        wide = {w: np.flatnonzero(words >= w) for w in np.unique(words).tolist()}
        folded = {w: np.stack([_folded(maps[r], w) for r in rows]) for w, rows in wide.items()}
    if by_map := "bits" in orders:
        bits = np.frombuffer(b"".join(run["bits"].to_pylist()), np.uint64).reshape(len(n), -1)
        size = prefix_size(n, percent)
    orders = [o for o in orders if o not in ("map", "bits")]
    lists = [_lists(run, o) for o in orders]
    for u, v in _partners(run, percent):
        if by_parity and len(v):
            common = np.minimum(words[v], words[u])
            apart = np.zeros(len(v), np.int64)
            for w in np.unique(common).tolist():
                at = np.flatnonzero(common == w)
                x, y = (folded[w][np.searchsorted(wide[w], rows)] for rows in (u, v[at]))
                apart[at] = np.bitwise_count(x ^ y).sum(axis=1, dtype=np.int64)
            v = v[apart <= most_apart(n[u], n[v], percent)]
        if by_map and len(v):   # a bit that one of them has alone stands for a token that is not shared
            alone = [np.bitwise_count(x & ~y).sum(axis=1, dtype=np.int64) for x, y in ((bits[u], bits[v]), (bits[v], bits[u]))]
            v = v[np.minimum(size[u] - alone[0], size[v] - alone[1]) >= common_prefix_tokens(n[u], n[v], percent)]
        for order, (flat, ends) in zip(orders, lists, strict=True):
            if not len(v):
                break
            own = np.sort(flat[ends[u]:ends[u + 1]])
            size = ends[v + 1] - ends[v]
            at = np.arange(size.sum()) + np.repeat(ends[v] - np.r_[0, np.cumsum(size)[:-1]], size)
            token, row = flat[at], np.repeat(np.arange(len(v)), size)
            hit = own[np.minimum(np.searchsorted(own, token), len(own) - 1)] == token
            fits = np.bincount(row, hit, len(v)) >= common_prefix_tokens(n[u], n[v], percent)
            if order == "p0":
                fits &= np.bincount(row, hit & (token < key), len(v)) == 0
            v = v[fits]
        if len(v):
            yield u, v


def _block_members(percent: int, orders: list[str]) -> Callable:
    """The rows of each run that are in a candidate pair."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, _BLOCK):
            used = np.zeros(table.num_rows, bool)
            for u, v in _candidates(table, percent, orders):
                used[u] = True
                used[v] = True
            if used.any():
                yield from table.filter(pa.array(used)).select(_MEMBER).to_batches()
    return run


class _Forest:
    """Union-find over ids."""

    def __init__(self) -> None:
        self.parent: dict[int, int] = {}

    def join(self, x: int, y: int) -> bool:
        """Whether x and y were apart until now."""
        x, y = self.root(x), self.root(y)
        self.parent[max(x, y)] = min(x, y)
        return x != y

    def root(self, x: int) -> int:
        while (p := self.parent.setdefault(x, x)) != x:
            self.parent[x] = x = self.parent[p]
        return x


def _block_forest(percent: int, orders: list[str]) -> Callable:
    """Candidate pairs of each run that span what its candidates connect: fewer
    than it has members."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, _BLOCK):
            rep, comp = table["rep"].to_pylist(), table["component"].to_pylist()
            forest, found = _Forest(), []
            for u, partners in _candidates(table, percent, orders):
                found += [(min(rep[u], rep[v]), max(rep[u], rep[v])) for v in partners.tolist() if forest.join(comp[u], comp[v])]
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], ["a", "b"])
    return run


def _block_links(percent: int) -> Callable:
    """Links of each run, confirmed on the full sets; pairs that the links found
    so far join are not looked at."""
    def links(run: pa.Table) -> list[tuple[int, int]]:
        rep, comp = run["rep"].to_pylist(), run["component"].to_pylist()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in run["elements"]]
        forest = _Forest()
        found = []
        for u, partners in _partners(run, percent):
            for v in partners.tolist():
                if forest.root(comp[u]) != forest.root(comp[v]) and _linked(sets[u], sets[v], percent):
                    forest.join(comp[u], comp[v])
                    found.append((min(rep[u], rep[v]), max(rep[u], rep[v])))
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, _BLOCK):
            found = links(table)
            yield pa.RecordBatch.from_arrays([pa.array([f[c] for f in found], pa.int64()) for c in (0, 1)], ["a", "b"])
    return run


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5,
                       percent: int = 80, word: np.ndarray = tb.NOT_SPACE, orders: int = ORDERS,
                       cells: int = CELLS) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id).

    Two documents are linked when 100 * |intersection| >= percent * |union| of
    their sets of ``words``-word shingles (A-Z lower-cased; a text of fewer words
    is one shingle). ``component_id`` is the smallest id reachable over links.

    Null or wordless texts have an empty set and are linked with nothing. Rows
    with a null id get a null component. Rows with one id are one document: its
    links are those of any of its texts. An empty table gives an empty result;
    other columns are not read. Texts of any length are taken whole.
    """
    if not 0 < percent <= 100 or not 0 < orders <= len(_SALT) or cells & (cells - 1):
        raise ValueError("percent is 1 to 100, there are 1 to 4 orders, cells is a power of two")
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    classes = count_classes(docs, words, word, cells)
    sig = land(docs.mapInArrow(_profile_rows(words, percent, word, classes), "id long, n long, d1 long, d2 long, prefix array<long>, map binary"))
    known = sig.where("id is not null and n > 0")
    same = land(known.groupBy("d1", "d2").agg(F.min("id").alias("rep")))
    members = known.select("id", "d1", "d2").join(same, ["d1", "d2"])
    reps = known.groupBy("d1", "d2").agg(F.min(F.struct("id", "prefix")).alias("r")).select(F.col("r.id").alias("rep"), "r.prefix")
    others = [f"p{o}" for o in range(1, orders)]
    every = ["p0", *others]

    def prefixes_of(sets: DataFrame, names: list[str]) -> DataFrame:
        kind = ", ".join(["rep long", *[f"{p} array<{'int' if p in others else 'long'}>" for p in names]])
        return sets.mapInArrow(_prefix_rows(percent, classes, range(orders - len(names), orders)), kind)

    # the smallest class of each bucket against the others
    rows = reps.select(F.posexplode("prefix").alias("pos", "key"), "rep").select("key", "rep", "pos")
    rows = rows.repartition("key").sortWithinPartitions("key", "rep")
    shared = land(rows.mapInArrow(_with_pivots, "key long, rep long, pos int, pivot long"))
    pairs = shared.select(F.col("pivot").alias("a"), F.col("rep").alias("b")).distinct()
    maps = known.groupBy("d1", "d2").agg(F.min(F.struct("id", "n", "map")).alias("r")).select(F.col("r.id").alias("rep"), "r.n", "r.map")
    maps = land(maps)
    sizes = land(maps.groupBy("rep", "n").agg(F.count("*").alias("texts")))
    fits = f"100 * least(a_n, b_n) >= {int(percent)} * greatest(a_n, b_n)"
    pairs = _on_ends(_on_ends(pairs, sizes, ["n"]).where(fits), maps, ["map"])
    pairs = land(pairs.mapInArrow(_near(percent), "a long, b long"))
    sets = land(_sets_of(pairs.select(F.explode(F.array("a", "b")).alias("id")), docs, words, word))
    if others:
        pairs = _on_ends(_on_ends(pairs, sizes, ["n"]), prefixes_of(sets, others), others)
        pairs = pairs.select("a", "b", "a_n", "b_n", *[f"{e}_{p}" for p in others for e in "ab"])
        pairs = pairs.mapInArrow(_meeting(percent, others), "a long, b long")
    links = _confirmed(land(pairs.select("a", "b").distinct()), sets, percent)
    label = land(components(links, "a", "b"))

    # the other pairs of each bucket, where the links found so far leave several
    # components; buckets of the same members count once
    named = shared.join(label.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select("key", "rep", "pos", F.coalesce("component", "rep").alias("component"))
    torn = named.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"),
                                    F.bit_xor(F.xxhash64("rep")).alias("s1"), F.bit_xor(F.xxhash64("rep", F.lit(1))).alias("s2"))
    torn = torn.where("lo < hi").groupBy("size", "s1", "s2").agg(F.min("key").alias("key"))
    # where one id has several texts, a token's place may be that of another text: it counts as the first
    many = sizes.groupBy("rep").agg(F.sum("texts").alias("texts")).where("texts > 1")
    torn = named.join(torn.select("key"), "key").join(sizes.select("rep", "n"), "rep").join(many, "rep", "left")
    slack = math.log(100 / percent) + 1e-9
    width = max(SIZE_BAND * slack, 0.01)
    torn = torn.select("key", "rep", "component", F.when(F.col("texts").isNull(), F.col("pos")).otherwise(0).alias("pos"), "n",
                       F.floor(F.log("n") / width).cast("int").alias("home"), F.floor((F.log("n") + slack) / width).cast("int").alias("last"))
    torn = land(torn.withColumn("band", F.explode(F.sequence("home", "last"))).drop("last"))
    bands = torn.groupBy("key", "band").agg(F.count("*").alias("size"), F.min("component").alias("lo"), F.max("component").alias("hi"),
                                            F.max("home").alias("top"))
    torn = torn.join(bands.where("lo < hi and top = band").select("key", "band", "size"), ["key", "band"])
    blocks = F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int")
    torn = torn.withColumn("blk", F.pmod(F.xxhash64("rep"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    torn = torn.withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")).select(*_MEMBER)

    def runs(rows: DataFrame) -> DataFrame:
        return rows.repartition(*_BLOCK).sortWithinPartitions(*_BLOCK)

    kind = "key long, band int, i int, j int, blk int, rep long, home int, pos int, n long, component long"
    torn = land(runs(torn).mapInArrow(_block_members(percent, []), kind))
    torn = runs(torn.join(maps, ["rep", "n"]).select(*_MEMBER, "map"))
    torn = land(torn.mapInArrow(_block_members(percent, ["map"]), kind))
    members_of = lambda rows: _sets_of(rows.select(F.col("rep").alias("id")), docs, words, word)
    lists = land(prefixes_of(members_of(torn), every))

    def listed(rows: DataFrame, names: list[str]) -> DataFrame:
        return runs(rows.join(lists.select("rep", *names), "rep").select(*_MEMBER, *names))

    bits = lists.select("rep", "p0").mapInArrow(_bit_maps, "rep long, bits binary").distinct()
    torn = runs(torn.join(bits, "rep").select(*_MEMBER, "bits"))
    torn = land(torn.mapInArrow(_block_members(percent, ["bits"]), kind))
    torn = land(listed(torn, ["p0"]).mapInArrow(_block_members(percent, ["p0"]), kind))
    if others:
        torn = land(listed(torn, every).mapInArrow(_block_members(percent, every), kind))
    # most candidates left are links: what spans them joins nearly all, and the
    # rows whose components are one by then go
    sets = land(members_of(torn))
    span = land(listed(torn, every).mapInArrow(_block_forest(percent, every), "a long, b long").distinct())
    forest = label.select(F.col("component").alias("a"), F.col("node").alias("b"))
    label = land(components(forest.union(_confirmed(span, sets, percent)), "a", "b"))
    torn = torn.drop("component").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    torn = torn.withColumn("component", F.coalesce("component", "rep")).select(*_MEMBER)
    torn = land(listed(torn, every).mapInArrow(_block_members(percent, every), kind))
    torn = runs(torn.join(sets.withColumnRenamed("id", "rep"), "rep").select(*_MEMBER, "elements"))
    last = land(torn.mapInArrow(_block_links(percent), "a long, b long"))
    # one id over several texts joins the classes of those texts
    apart = members.where("id <> rep").select(F.col("rep").alias("a"), F.col("id").alias("b"))
    forest = label.select(F.col("component").alias("a"), F.col("node").alias("b"))
    label = land(components(forest.union(last).union(apart), "a", "b"))
    out = sig.join(label.withColumnRenamed("node", "id"), "id", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"),
                      F.coalesce("component", "id").alias("component_id"))
