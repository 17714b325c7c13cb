"""MinHash near-dedup with SuperMinHash signatures.

Every shingle walks its own random permutation of the signature slots; step
``j`` offers the value ``j + r`` (r in [0, 1)) to the slot at rank ``j`` of the
permutation. A slot keeps its smallest offer, so ranks of one element are
correlated over the slots (lower variance than independent hashes), and a
document stops as soon as every slot holds less than the next step could offer.

Plan: (1) one pass over the texts gives set size, set digest and band keys;
(2) equal sets collapse to a class, represented by its smallest id; (3) in each
band bucket every class is compared with the bucket's smallest class, so a
bucket of n classes costs n - 1 pairs; (4) pairs whose signatures agree in too few slots for a link (a
chance of one in 10**9) are left out, the others are confirmed on the full sets and joined to
components; (5) pairs of a bucket that those links have not joined yet are
compared as well, in blocks of bounded size, so no link between different
texts is lost; (6) the components of all links give one id per document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textbytes as tb
from .shared import components, land

SLOTS = 128
BAND_ROWS = 4       # 32 bands: a pair of similarity 0.8 meets in none of them with probability 5e-8
BLOCK_MEMBERS = 256  # members of a bucket compared at once with those of another block

FILTER_BITS = 24


def shingle_sets(buf: np.ndarray, offs: np.ndarray, k: int, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct k-word shingle hashes of each row, row offsets). A row
    of fewer than k words has its whole sequence as its only shingle; a row
    without words has none."""
    s, e, first = tb.word_spans(buf, offs, word)
    h = tb.span_hashes(buf, s, e)
    grams = tb.kgram_hashes(h, k)
    out, sizes = [], []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= k:
            g = np.sort(grams[a:b - k + 1])
            g = g[np.r_[True, g[1:] != g[:-1]]]
        else:
            g = tb.kgram_hashes(h[a:b], b - a) if b > a else h[:0]
        out.append(g)
        sizes.append(len(g))
    return (np.concatenate(out) if out else h[:0]), np.r_[0, np.cumsum(sizes)].astype(np.int64)


def superminhash(sets: np.ndarray, first: np.ndarray, slots: int = SLOTS) -> np.ndarray:
    """Signatures (rows x slots, int64 ``step << 32 | random``) of the sets."""
    n = len(first) - 1
    sig = np.full((n, slots), np.iinfo(np.int64).max, np.int64)
    flat = sig.reshape(-1)
    row = np.repeat(np.arange(n), np.diff(first))
    state = sets
    perm = None
    gold = np.uint64(0x9E3779B97F4A7C15)
    for j in range(slots):
        if not len(row):
            break
        state = state + gold
        z = tb.mix(state)
        r = (z >> np.uint64(32)).astype(np.int64)
        at = j + ((z & np.uint64(0xFFFFFFFF)) * np.uint64(slots - j) >> np.uint64(32)).astype(np.int64)
        if perm is None:
            slot = at
        else:
            i = np.arange(len(row))
            slot = perm[i, at].astype(np.int64)
            perm[i, at] = perm[i, j]
        np.minimum.at(flat, row * slots + slot, (np.int64(j) << np.int64(32)) | r)
        open_rows = sig.max(axis=1) >= (np.int64(j + 1) << np.int64(32))
        keep = open_rows[row]
        if not keep.all() or perm is None:
            if perm is None:
                kept = np.flatnonzero(keep)
                perm = np.tile(np.arange(slots, dtype=np.uint8 if slots <= 256 else np.int32), (len(kept), 1))
                perm[np.arange(len(kept)), at[kept]] = 0
            else:
                perm = perm[keep]
            row, state = row[keep], state[keep]
    return sig


def band_words(sig: np.ndarray, rows: int = BAND_ROWS) -> np.ndarray:
    """Rows x bands, int64: 16 bits of each of the 4 slots of a band. A band's
    word is its bucket key, and the words together estimate the similarity."""
    if rows != 4:
        raise ValueError("a band word holds 4 slots")
    lane = (tb.mix(sig.reshape(-1).view(np.uint64)) >> np.uint64(48)).astype(np.uint16)
    return lane.view(np.int64).reshape(len(sig), -1)


def _signature_rows(k: int, word: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, buf, offs in tb.blocks(batches):
            sets, first = shingle_sets(buf, offs, k, word)
            keys = band_words(superminhash(sets, first))
            size = np.diff(first)
            some = size > 0
            # two independent sums of mixed elements identify a set
            d1 = np.add.reduceat(np.r_[tb.mix(sets), np.uint64(0)], first[:-1]) if len(size) else size
            d2 = np.add.reduceat(np.r_[tb.mix(sets ^ np.uint64(0xA5A5A5A5A5A5A5A5)), np.uint64(0)], first[:-1]) if len(size) else size
            ends = np.r_[0, np.cumsum(np.where(some, keys.shape[1], 0))]
            yield pa.RecordBatch.from_arrays([
                batch.column(0),
                pa.array(size, pa.int64()),
                pa.array(tb.signed(d1.astype(np.uint64)), pa.int64(), mask=~some),
                pa.array(tb.signed(d2.astype(np.uint64)), pa.int64(), mask=~some),
                tb.list_column(keys[some].reshape(-1), ends, pa.int64()),
            ], ["id", "n", "d1", "d2", "bands"])
    return run


def _set_rows(k: int, word: np.ndarray) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, buf, offs in tb.blocks(batches):
            sets, first = shingle_sets(buf, offs, k, word)
            blob = pa.Array.from_buffers(
                pa.binary(), len(first) - 1,
                [None, pa.py_buffer((first * 8).astype(np.int32).tobytes()), pa.py_buffer(sets.tobytes())])
            yield pa.RecordBatch.from_arrays([batch.column(0), blob], ["id", "elements"])
    return run


def _confirm(percent: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok = [_linked(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), percent)
                  for x, y in zip(batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(ok, pa.bool_()))
    return run


def _least_matches(percent: int) -> int:
    """Equal slots that a linked pair has but for a chance of one in 10**9: six
    standard deviations below the threshold's mean."""
    j = percent / 100
    return max(0, int(SLOTS * (j - 6 * (j * (1 - j) / SLOTS) ** 0.5)))


def _lanes(column: pa.Array) -> np.ndarray:
    return np.ascontiguousarray(column.flatten().to_numpy(zero_copy_only=False)).view(np.uint16).reshape(len(column), -1)


def _likely(least: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                same = (_lanes(batch.column(2)) == _lanes(batch.column(3))).sum(axis=1)
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(same >= least))
    return run


def _candidates(run: pa.Table, least: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """(member, its partners) of a (bucket, block, block) run: pairs that no
    earlier band has, that are not joined yet, and whose size and signature
    allow a link."""
    rep, comp, n, blk = (run[c].to_numpy() for c in ("rep", "component", "n", "blk"))
    band, i, j = (run[c][0].as_py() for c in ("band", "i", "j"))
    x = _lanes(run["bands"].combine_chunks())
    right = np.flatnonzero(blk == j)
    for u in np.flatnonzero(blk == i).tolist():
        v = right[(comp[right] != comp[u]) & ((rep[right] > rep[u]) | (i != j))]
        v = v[100 * np.minimum(n[v], n[u]) >= percent * np.maximum(n[v], n[u])]
        if len(v):
            same = x[v] == x[u]
            enough = same.sum(axis=1) >= least
            v, same = v[enough], same[enough]
        if len(v):
            v = v[same.reshape(len(v), -1, BAND_ROWS).all(axis=2).argmax(axis=1) == band]
        if len(v):
            yield u, v


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """The rows of each (bucket, block, block), which follow each other."""
    held: list[pa.RecordBatch] = []
    at = None
    for batch in batches:
        if not batch.num_rows:
            continue
        key = np.stack([batch.column(c).to_numpy() for c in ("band", "word", "i", "j")])
        cuts = np.r_[0, np.flatnonzero((key[:, 1:] != key[:, :-1]).any(axis=0)) + 1, batch.num_rows]
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            if at != (now := tuple(key[:, lo])):
                if held:
                    yield pa.Table.from_batches(held)
                held, at = [], now
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def _block_members(least: int, percent: int) -> Callable:
    """The rows of each run that have a partner in it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            used = np.zeros(table.num_rows, bool)
            for u, v in _candidates(table, least, percent):
                used[u] = True
                used[v] = True
            if used.any():
                yield from table.filter(pa.array(used)).to_batches()
    return run


def _linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    if len(s) > len(t):
        s, t = t, s
    both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum())
    return 100 * both >= percent * (len(s) + len(t) - both)


def _block_links(least: int, percent: int) -> Callable:
    """Links of each run, confirmed on the full sets; a pair that the links
    found so far already join is not looked at."""
    def links(table: pa.Table) -> pa.RecordBatch | None:
        rep, comp = table["rep"].to_numpy(), table["component"].to_numpy()
        sets = [np.frombuffer(x.as_buffer(), np.uint64) for x in table["elements"]]
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while (p := parent.setdefault(x, x)) != x:
                parent[x] = x = parent[p]
            return x

        found = []
        for u, partners in _candidates(table, least, percent):
            for v in partners.tolist():
                a, b = find(int(comp[u])), find(int(comp[v]))
                if a != b and _linked(sets[u], sets[v], percent):
                    parent[max(a, b)] = min(a, b)
                    found.append((min(rep[u], rep[v]), max(rep[u], rep[v])))
        if not found:
            return None
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches):
            if got := links(table):
                yield got
    return run


def _sets_of(ids: DataFrame, docs: DataFrame, k: int, word: np.ndarray) -> DataFrame:
    """(id, elements) of the given ids. The texts are first thinned by a bit map
    of the ids' hashes (2**24 bits, so at most 2**18 words to broadcast for any
    number of ids); only what passes it is shuffled for the exact match."""
    bit = F.pmod(F.xxhash64("id"), F.lit(1 << FILTER_BITS))
    words = ids.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("w")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("mask"))
    near = docs.withColumn("bit", bit).withColumn("w", F.shiftright("bit", 6)).join(F.broadcast(words), "w")
    near = near.where(F.expr("(shiftright(mask, cast(bit & 63 as int)) & 1L) = 1")).select("id", "text")
    exact = near.join(ids.hint("merge"), "id", "left_semi")
    return land(exact.mapInArrow(_set_rows(k, word), "id long, elements binary").distinct())


def _confirmed(pairs: DataFrame, docs: DataFrame, k: int, percent: int, word: np.ndarray) -> DataFrame:
    """The pairs whose full sets reach the similarity. Only texts that occur in
    a pair are read into sets again."""
    ids = pairs.select(F.col("a").alias("id")).union(pairs.select(F.col("b").alias("id"))).distinct()
    sets = _sets_of(ids, docs, k, word)
    left = pairs.join(sets.select(F.col("id").alias("a"), F.col("elements").alias("x")), "a")
    full = left.join(sets.select(F.col("id").alias("b"), F.col("elements").alias("y")), "b")
    return full.select("a", "b", "x", "y").mapInArrow(_confirm(percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, words: int = 5,
                    percent: int = 80, word: np.ndarray = tb.NOT_SPACE) -> DataFrame:
    """One row per input row: (id, n_shingles, component_id, kept).

    Two documents are linked when 100 * |intersection| >= percent * |union| of
    their sets of ``words``-word shingles (A-Z lower-cased). ``component_id`` is
    the smallest id reachable over links, ``kept`` tells id = component_id.

    Null or wordless texts have an empty set, are linked with nothing and are
    kept. Rows with a null id get a null component and ``kept`` false. Rows with
    one id are one document: its links are those of any of its texts. An empty
    table gives an empty result; other columns are not read. Text of any length
    is used whole.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    sig = land(docs.mapInArrow(_signature_rows(words, word), "id long, n long, d1 long, d2 long, bands array<long>"))
    known = sig.where("id is not null and n > 0")
    classes = land(known.groupBy("d1", "d2").agg(F.min("id").alias("rep")))
    members = known.select("id", "d1", "d2").join(classes, ["d1", "d2"])
    reps = land(known.join(classes, ["d1", "d2"]).where("id = rep").dropDuplicates(["d1", "d2"]).select("rep", "n", "bands"))
    least = _least_matches(percent)
    fits = f"100 * least(n, m) >= {int(percent)} * greatest(n, m)"
    buckets = reps.select("rep", "n", F.posexplode("bands").alias("band", "word"))
    key = ["band", "word"]
    pivots = buckets.groupBy(*key).agg(F.count("*").alias("size"), F.min(F.struct("rep", "n")).alias("p")).where("size > 1")
    shared = land(buckets.join(pivots, key).select(*key, "rep", "n", "p", "size"))
    pairs = shared.select(F.col("p.rep").alias("a"), F.col("rep").alias("b"), "n", F.col("p.n").alias("m"))
    pairs = pairs.where("a < b").where(fits).select("a", "b").distinct()
    pairs = pairs.join(reps.select(F.col("rep").alias("a"), F.col("bands").alias("x")), "a")
    pairs = pairs.join(reps.select(F.col("rep").alias("b"), F.col("bands").alias("y")), "b").select("a", "b", "x", "y")
    pairs = land(pairs.mapInArrow(_likely(least), "a long, b long"))
    links = land(_confirmed(pairs, docs, words, percent, word))
    label = components(links, "a", "b")

    # what the first links have not joined: the other pairs of each bucket
    named = shared.where("size > 2 and rep <> p.rep").join(label.withColumnRenamed("node", "rep"), "rep", "left")
    named = named.select(*key, "rep", "n", F.coalesce("component", "rep").alias("component"))
    torn = named.groupBy(*key).agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
    torn = torn.where("lo < hi").select(*key, F.ceil(F.col("size") / BLOCK_MEMBERS).cast("int").alias("blocks"))
    torn = named.join(torn, key).join(reps.select("rep", "bands"), "rep")
    blk = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    torn = torn.withColumn("blk", blk).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    run = [*key, "i", "j"]
    columns = [*run, "blk", "rep", "n", "component", "bands"]
    torn = torn.withColumn("i", F.least("blk", "other")).withColumn("j", F.greatest("blk", "other")).select(*columns)
    torn = torn.repartition(*run).sortWithinPartitions(*run)
    kind = "band int, word long, i int, j int, blk int, rep long, n long, component long, bands array<long>"
    torn = land(torn.mapInArrow(_block_members(least, percent), kind))
    sets = _sets_of(torn.select(F.col("rep").alias("id")).distinct(), docs, words, word)
    torn = torn.join(sets.withColumnRenamed("id", "rep"), "rep").select(*columns, "elements")
    torn = torn.repartition(*run).sortWithinPartitions(*run)
    links = links.union(land(torn.mapInArrow(_block_links(least, percent), "a long, b long")))
    # one id over several texts joins the classes of those texts
    same = members.where("id <> rep").select(F.col("id").alias("b"), F.col("rep").alias("a"))
    links = links.union(same.select("a", "b"))
    label = land(components(links, "a", "b"))
    out = sig.join(label.withColumnRenamed("node", "id"), "id", "left")
    component = F.coalesce("component", "id")
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
