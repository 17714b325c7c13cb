"""Byte-level BPE: training and encoding (TOK8, TOK10, TOK3).

A word's state is a delimited string of token ids such as ``<76><105>``, so a
merge is one ``replace('<76><105>', '<260>')``: left to right, without overlap,
as BPE needs. Which merge comes next inside a word is looked up by position:
the rank of every adjacent pair is read from a table indexed by the left id,
and the lowest rank is merged, until no pair has one. The cost follows the
word, not the length of the merge list.

A whole text is encoded where it is read if the merge list is short: each byte and
each token is one character of a coded text, and the merges are replacements in
it, one after the other (:class:`TextCoder`).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import drop_landed, land_table
from .lookup import by_id, constant, let
from .tokenizer import BOS_ID, EOS_ID, SPECIALS, UNK_ID, add_specials, chars_of, pretokenize

FIRST_PAIRS, MOST_PAIRS = 16, 8192   # pairs of one training round: at first, and at most
CHAIN_LIMIT = 20_000                 # chains of symbols that one round may bring to the driver
TEXT_PASSES = 1024                   # replacements that a text is encoded with; beyond, its words are looked up
MARK = "\u0100"                      # between the words of a coded text: the first code point that is no byte
JOINT = "\uffff"                     # stands for MARK while words are text


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores: a word costs much more than its bytes suggest, and
    a small table would be left in one partition."""
    spark = df.sparkSession
    n = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(n, key)


# ---------------------------------------------------------------- segments of ids


def byte_text(col) -> Column:
    """The UTF-8 bytes of a string, each as the character of that code point."""
    return F.decode(F.encode(_c(col), "UTF-8"), "ISO-8859-1")


def byte_values(col) -> Column:
    """The UTF-8 bytes of a string as integers."""
    return F.transform(chars_of(byte_text(col)), lambda c: F.ascii(c))


def to_segment(ids: Column) -> Column:
    return F.concat(F.lit("<"), F.array_join(ids.cast("array<string>"), "><"), F.lit(">"))


def symbols(seg) -> Column:
    """The ids of a segment, as strings."""
    return F.split(F.btrim(_c(seg), F.lit("<>")), "><")


def byte_segment(col, byte_ids: Column) -> Column:
    """A word as the ids of its bytes; a byte outside the alphabet is ``[UNK]``."""
    return to_segment(F.transform(byte_values(col), lambda b: F.coalesce(F.get(byte_ids, b), F.lit(UNK_ID))))


def adjacent(syms: Column, pair) -> Column:
    """``pair(left, right)`` of every two neighbours."""
    n = F.greatest(F.size(syms) - 1, F.lit(0))
    return F.zip_with(F.slice(syms, 1, n), F.slice(syms, 2, n), pair)


class MergeTable:
    """Merges (left id, right id, new id) in rank order, as constants."""

    def __init__(self, merges: Iterable[tuple[int, int, int]]) -> None:
        ranks: dict[int, dict[str, int]] = {}
        merges = list(merges)
        for rank, (a, b, _) in enumerate(merges):
            ranks.setdefault(a, {}).setdefault(str(b), rank)
        self.ranks = by_id(ranks.items(), "map<string,int>")
        self.found = constant([f"<{a}><{b}>" for a, b, _ in merges], "array<string>")
        self.made = constant([f"<{c}>" for _, _, c in merges], "array<string>")

    def rank(self, left: Column, right: Column) -> Column:
        return F.try_element_at(F.get(self.ranks, left.cast("int")), right)

    def lowest(self, seg: Column) -> Column:
        """The first rank among the pairs of a segment; null if none has one."""
        return let(symbols(seg), lambda s: F.array_min(adjacent(s, self.rank)))

    def apply(self, seg) -> Column:
        """All merges, the lowest rank first."""
        def step(acc, _):
            merged = lambda r: F.when(r.isNull(), F.struct(acc["s"].alias("s"), F.lit(True).alias("done"))).otherwise(
                F.struct(F.replace(acc["s"], F.get(self.found, r), F.get(self.made, r)).alias("s"), F.lit(False).alias("done")))
            return F.when(acc["done"], acc).otherwise(let(self.lowest(acc["s"]), merged))

        def merge(s):
            # each step but the last takes one symbol away at least
            steps = F.sequence(F.lit(1), F.greatest(F.length(s) - F.length(F.replace(s, F.lit("<"), F.lit(""))), F.lit(1)))
            return F.aggregate(steps, F.struct(s.alias("s"), F.lit(False).alias("done")), step, lambda acc: acc["s"])

        return let(_c(seg), merge)


# ---------------------------------------------------------------- training


def id_pair_counts(state: DataFrame) -> DataFrame:
    """(l, r, n): weighted frequency of adjacent ids over (seg, freq)."""
    pairs = adjacent(symbols("seg"), lambda a, b: F.struct(a.alias("l"), b.alias("r")))
    return state.select(F.explode(pairs).alias("p"), "freq").groupBy("p.l", "p.r").agg(F.sum("freq").alias("n"))


def _changed_pairs(state: DataFrame) -> DataFrame:
    """What the pair counts gain and lose by the words whose ``old`` segment
    became another ``seg``."""
    signed = lambda col, sign: adjacent(
        symbols(col), lambda a, b: F.struct(a.alias("l"), b.alias("r"), F.lit(sign).alias("sign")))
    touched = state.filter(F.col("old") != F.col("seg"))
    return touched.select(F.explode(F.concat(signed("old", -1), signed("seg", 1))).alias("p"), "freq").select(
        "p.l", "p.r", (F.col("p.sign") * F.col("freq")).alias("n"))


def chains(state: DataFrame, pairs: Sequence[tuple[int, int]]) -> DataFrame:
    """(chain, freq): the words cut at every two neighbours that are none of
    ``pairs``; pieces of two symbols and more, equal ones added up."""
    table = MergeTable((a, b, 0) for a, b in pairs)
    # each symbol is written after the mark that joins it to the one before
    marked = lambda s: F.concat(F.element_at(s, 1), F.array_join(adjacent(
        s, lambda a, b: F.concat(F.when(table.rank(a, b).isNull(), F.lit("|")).otherwise(F.lit(" ")), b)), ""))
    text = let(symbols("seg"), marked)
    pieces = F.filter(F.split(text, "[|]"), lambda x: F.contains(x, F.lit(" ")))
    return state.select(F.explode(pieces).alias("chain"), "freq").groupBy("chain").agg(F.sum("freq").alias("freq"))


def merge_chains(pieces: list[tuple[list[int], int]], tokens: list[str], known: dict[str, int], bar: int,
                 room: int, most: int, force: bool = False) -> tuple[list[tuple[int, int, int, int]], bool]:
    """Merges (left, right, count, new id) that one-by-one training takes next,
    and whether the last of them makes a token that existed already.

    ``pieces`` are the chains over the pairs that count more than ``bar``. Any
    other pair, and any pair that a merge makes across the end of a chain, counts
    ``bar`` at most, so as long as the best pair counts more, the chains alone
    decide, and exactly: a token is made by one merge only, so all places of a
    pair come from places of one earlier pair, which are all inside chains or all
    outside. A merge whose token exists already ends the round, since its pairs
    may have further places outside. ``tokens`` (by id) and ``known`` (ids by
    token) grow; ``room``: tokens still to be made, ``most``: merges at most;
    ``force``: the first pair is taken whatever the bar."""
    count: dict[tuple[int, int], int] = {}
    where: dict[tuple[int, int], set[int]] = {}
    for k, (syms, freq) in enumerate(pieces):
        for p in zip(syms, syms[1:]):
            count[p] = count.get(p, 0) + freq
            where.setdefault(p, set()).add(k)
    heap = [(-n, tokens[a], tokens[b], a, b) for (a, b), n in count.items()]
    heapq.heapify(heap)
    out: list[tuple[int, int, int, int]] = []
    while heap and room > 0 and len(out) < most:
        n, left, right, a, b = heapq.heappop(heap)
        if count.get((a, b)) != -n:
            continue                       # an older count of the pair
        if -n <= bar and not (force and not out):
            break
        token = left + right
        new = known.get(token)
        ends = new is not None
        if not ends:
            new = known[token] = len(tokens)
            tokens.append(token)
            room -= 1
        out.append((a, b, -n, new))
        if ends:
            return out, True
        changed: set[tuple[int, int]] = set()
        for k in where.pop((a, b)):
            syms, freq = pieces[k]
            merged, i = [], 0
            while i < len(syms):
                if i + 1 < len(syms) and syms[i] == a and syms[i + 1] == b:
                    merged.append(new)
                    i += 2
                else:
                    merged.append(syms[i])
                    i += 1
            for p in zip(syms, syms[1:]):
                count[p] -= freq
                changed.add(p)
            for p in zip(merged, merged[1:]):
                count[p] = count.get(p, 0) + freq
                where.setdefault(p, set()).add(k)
                changed.add(p)
            pieces[k] = (merged, freq)
        for p in changed:
            if count[p] > 0:
                heapq.heappush(heap, (-count[p], tokens[p[0]], tokens[p[1]], *p))
            else:
                del count[p]
                where.pop(p, None)
    return out, False


def _first_pair(counts: DataFrame, best: int, tokens: list[str]) -> tuple[int, int]:
    """The first of the pairs that count ``best``, by their tokens."""
    names = by_id(enumerate(tokens), "string")
    tied = counts.filter(F.col("n") == best).select("l", "r", F.get(names, F.col("l").cast("int")).alias("x"),
                                                    F.get(names, F.col("r").cast("int")).alias("y"))
    row = tied.orderBy("x", "y").limit(1).collect()[0]
    return int(row["l"]), int(row["r"])


def bpe_train(words: DataFrame, vocab_size: int | None = None, num_merges: int | None = None, min_frequency: int = 2,
              word_col: str = "word", freq_col: str = "freq", chain_limit: int = CHAIN_LIMIT,
              first_pairs: int = FIRST_PAIRS, most_pairs: int = MOST_PAIRS) -> tuple[DataFrame, DataFrame]:
    """TOK8: learn byte-level BPE merges from a (word, freq) table.

    Stops when the vocabulary (4 specials + byte alphabet + new tokens) reaches
    ``vocab_size`` (or after ``num_merges`` merges) or when the best pair counts
    less than ``min_frequency``. Pairs rank by (count desc, left, right).

    A round takes the most frequent pairs, cuts all words into chains of them
    and adds equal chains up; the distinct chains (``chain_limit`` at most, else
    the round takes half as many pairs) suffice to tell many merges ahead exactly
    (:func:`merge_chains`). Then the words are merged, each by the merges that
    occur in it, and the table of pair counts takes the difference of the words
    that changed. So a training of 4,096 tokens is some dozens of rounds over the
    distinct words, and nothing of unbounded size reaches the driver. The state
    of every round is written to the shared folder, where it replaces the one before.

    Returns (vocab(id, token), merges(rank, left_tok, right_tok, count))."""
    spark = words.sparkSession
    seen = words.select(F.explode(F.array_distinct(byte_values(word_col))).alias("b")).distinct()
    alphabet = sorted(f"{r.b:02X}" for r in seen.collect())
    tokens = SPECIALS + alphabet
    known = {t: i for i, t in enumerate(tokens)}
    byte_ids = by_id(((int(t, 16), known[t]) for t in alphabet), "int")
    pairs_in = F.contains(F.col("seg"), F.lit("><"))
    # the words travel, not their segments, which are several times as long
    state = _spread(words.select(word_col, F.col(freq_col).cast("bigint").alias("freq")), word_col)
    state = land_table(state.select(byte_segment(word_col, byte_ids).alias("seg"), "freq").filter(pairs_in))
    counts = land_table(id_pair_counts(state))
    merges: list[tuple[int, int, int, int]] = []
    size = first_pairs

    def left() -> tuple[int, int]:
        room = vocab_size - len(tokens) if vocab_size is not None else 1 << 30
        most = num_merges - len(merges) if num_merges is not None else 1 << 30
        return room, most

    while min(left()) > 0:
        top = [(int(r["l"]), int(r["r"]), r["n"]) for r in counts.orderBy(F.desc("n")).limit(size + 1).collect()]
        if not top or top[0][2] < min_frequency:
            break
        bar = max(top[size][2] if len(top) > size else 0, min_frequency - 1)
        pairs = [(a, b) for a, b, n in top if n > bar]
        alone = not pairs
        if alone and size < most_pairs:
            size = min(2 * size, most_pairs)      # more pairs of one count than the round takes
            continue
        if alone:
            pairs = [_first_pair(counts, top[0][2], tokens)]
        rows = chains(state, pairs).limit(chain_limit + 1).collect()
        if len(rows) > chain_limit and len(pairs) > 1:
            size = max(1, min(size, len(pairs)) // 2)
            continue
        pieces = [([int(x) for x in r["chain"].split(" ")], r["freq"]) for r in rows]
        batch, repeats = merge_chains(pieces, tokens, known, bar, *left(), force=alone)
        merges += batch
        own = [(a, b, c) for a, b, _, c in batch]
        # a token made again may make an earlier pair again: that merge comes last, by itself
        last = own.pop() if repeats else None
        seg = MergeTable(own).apply("seg") if own else F.col("seg")
        if last:
            seg = F.replace(seg, F.lit(f"<{last[0]}><{last[1]}>"), F.lit(f"<{last[2]}>"))
        done = land_table(state.select(F.col("seg").alias("old"), seg.alias("seg"), "freq"))
        left_over = state, counts
        state = done.select("seg", "freq").filter(pairs_in)
        counts = land_table(counts.unionByName(_changed_pairs(done)).groupBy("l", "r").agg(F.sum("n").alias("n")).filter("n > 0"))
        drop_landed(*left_over)
        if len(rows) < chain_limit // 4:
            size = min(2 * size, most_pairs)

    drop_landed(state, counts)
    vocab = spark.createDataFrame(list(enumerate(tokens)), "id int, token string")
    learned = [(i, tokens[a], tokens[b], n) for i, (a, b, n, _) in enumerate(merges)]
    return vocab, spark.createDataFrame(learned, "rank int, left_tok string, right_tok string, count bigint")


# ---------------------------------------------------------------- encoding


class Encoder:
    """A trained tokenizer (its size is a parameter) as constants of a plan."""

    def __init__(self, vocab: DataFrame, merges: DataFrame) -> None:
        self.tokens = {r["token"]: r["id"] for r in vocab.select("token", "id").collect()}
        rows = merges.orderBy("rank").select("left_tok", "right_tok").collect()
        self.known = [(self.tokens[a], self.tokens[b], self.tokens[a + b]) for a, b in rows
                      if {a, b, a + b} <= self.tokens.keys()]
        self.merges = MergeTable(self.known)
        self.byte_ids = by_id(((int(t, 16), i) for t, i in self.tokens.items() if len(t) == 2), "int")

    def ids(self, word) -> Column:
        """The ids of a word."""
        segment = self.merges.apply(byte_segment(word, self.byte_ids))
        return F.when(F.length(_c(word)) == 0, F.array().cast("array<int>")).otherwise(symbols(segment).cast("array<int>"))


def merge_passes(merges: Sequence[tuple[int, int, int]], most: int = TEXT_PASSES) -> list[tuple[int, int, int]] | None:
    """The merges in an order in which each is applied once to a whole text, with
    the result of always merging the lowest rank; null if it takes over ``most``.

    Where a merge was applied, pairs of lower ranks can only be new ones with the
    token it made. If earlier merges use that token (which another merge made
    first), they come again, in rank order, and with them those that use what they
    make in turn. Each of these tokens is longer than the one before, so this ends."""
    first_use: dict[int, int] = {}
    for rank, (a, b, _) in enumerate(merges):
        first_use.setdefault(a, rank)
        first_use.setdefault(b, rank)
    out: list[tuple[int, int, int]] = []

    def again(token: int, limit: int) -> set[int]:
        new = {token}
        for rank in range(first_use.get(token, limit), limit):
            if len(out) > most:
                break
            a, b, made = merges[rank]
            if a in new or b in new:
                out.append(merges[rank])
                new |= again(made, rank)
        return new

    for rank, merge in enumerate(merges):
        out.append(merge)
        again(merge[2], rank)
        if len(out) > most:
            return None
    return out


class TextCoder:
    """Texts as coded texts: a byte is the character of its code point, a token
    of a merge is one of those after :data:`MARK`. ``passes`` is none if there are
    too many."""

    def __init__(self, encoder: Encoder) -> None:
        ids = encoder.tokens
        codes = {i: chr(int(t, 16)) for t, i in ids.items() if len(t) == 2}
        points = (p for p in range(ord(MARK) + 1, 0x110000) if not 0xD800 <= p < 0xE000)
        codes |= {i: chr(next(points)) for i in sorted(set(ids.values()) - codes.keys())}
        self.ends = codes.get(BOS_ID), codes.get(EOS_ID)
        passes = merge_passes(encoder.known)
        self.passes = passes and constant(
            [{"pair": codes[a] + codes[b], "made": codes[c]} for a, b, c in passes], "array<struct<pair:string,made:string>>")
        self.any_merge = passes is None or bool(passes)
        self.id_of = by_id(((ord(c), i) for i, c in codes.items()), "int")
        self.code_of = by_id(codes.items(), "string")

    def coded(self, words, text) -> Column:
        """The words of a text, each by its tokens, with marks between."""
        joined = F.replace(byte_text(F.array_join(_c(words), JOINT)), F.lit(JOINT.encode().decode("latin-1")), F.lit(MARK))
        apart = F.array_join(F.transform(_c(words), byte_text), MARK)
        s = F.when(F.contains(_c(text), F.lit(JOINT)), apart).otherwise(joined)
        return F.aggregate(self.passes, s, lambda acc, p: F.replace(acc, p["pair"], p["made"])) if self.any_merge else s

    def ids(self, coded) -> Column:
        """The ids of a coded text without marks; a byte outside the alphabet is ``[UNK]``."""
        return let(_c(coded), lambda s: F.transform(chars_of(s), lambda c: F.coalesce(F.get(self.id_of, F.ascii(c)), F.lit(UNK_ID))))

    def of_ids(self, ids) -> Column:
        """The coded text of ids, without marks."""
        return F.array_join(F.transform(_c(ids), lambda i: F.get(self.code_of, i)), "")


def encode_words(words: DataFrame, vocab: DataFrame, merges: DataFrame, word_col: str = "word", out: str = "ids") -> DataFrame:
    """TOK10 core: ids of every word; an unknown byte is ``[UNK]``."""
    return words.withColumn(out, Encoder(vocab, merges).ids(word_col))


def _repeats(df: DataFrame, keys: Sequence[str]) -> bool:
    return not df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def _by_words(df: DataFrame, encoder: Encoder, keys: Sequence[str], col: str) -> DataFrame:
    """(keys, ids) by way of the distinct words, for long merge lists: each is encoded
    once and joined back (AQE broadcasts the encoded words when small and splits hot
    words otherwise)."""
    words = F.when(F.size("words") > 0, F.col("words")).otherwise(F.array(F.lit("")))
    toks = pretokenize(df, col).select(*keys, F.posexplode(words).alias("tpos", "word"))
    enc = _spread(toks.select("word").distinct(), "word").withColumn("wids", encoder.ids("word"))
    parts = toks.join(enc, "word").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("tpos", "wids"))).alias("_parts"))
    return parts.select(*keys, F.flatten(F.transform("_parts", lambda p: p["wids"])).alias("ids"))


def bpe_code(df: DataFrame, encoder: Encoder, coder: TextCoder, key_cols: Sequence[str], col: str = "story",
             out: str = "code") -> DataFrame:
    """Text -> coded text, one row per key. A text is pre-tokenized and encoded where
    it is read, and nothing of it travels. If keys repeat, the tokens of their rows
    are put together by place (seen beforehand from the keys alone)."""
    keys = list(key_cols)
    texts = df.select(*keys, F.coalesce(F.col(col), F.lit("")).alias(col))
    if coder.any_merge and coder.passes is None:
        return _by_words(texts, encoder, keys, col).select(*keys, coder.of_ids("ids").alias(out))
    code = pretokenize(texts, col).select(*keys, coder.coded("words", col).alias(out))
    if _repeats(df, keys):
        part = lambda w, i: F.struct(i.alias("tpos"), coder.ids(w).alias("wids"), w.alias("w"))
        parts = code.select(*keys, F.transform(F.split(out, MARK), part).alias("_parts"))
        parts = parts.groupBy(*keys).agg(F.array_sort(F.flatten(F.collect_list("_parts"))).alias("_parts"))
        return parts.select(*keys, F.array_join(F.transform("_parts", lambda p: p["w"]), "").alias(out))
    return code.withColumn(out, F.replace(F.col(out), F.lit(MARK), F.lit("")))


def bpe_encode(df: DataFrame, vocab: DataFrame, merges: DataFrame, key_cols: Sequence[str], col: str = "story",
               out: str = "ids", specials: bool = True) -> DataFrame:
    """TOK10: text -> ids: pre-tokenize, merge inside every word, add BOS/EOS. A
    text without a pre-token keeps its row (see :func:`bpe_code`)."""
    encoder = Encoder(vocab, merges)
    coder = TextCoder(encoder)
    coded = bpe_code(df, encoder, coder, key_cols, col, "_code")
    ids = coder.ids("_code")
    found = coded.select(*key_cols, (add_specials(ids) if specials else ids).alias(out))
    # by way of a row for each: a filter on the ids would be put below them, and encode again
    return found.select(*key_cols, F.explode(F.array(out)).alias(out))


def bpe_decode(df: DataFrame, vocab: DataFrame, col: str = "ids", out: str = "text", skip_specials: bool = True) -> DataFrame:
    """TOK3 for BPE: ids -> hex bytes -> UTF-8 text; ids that are special tokens
    or outside the vocabulary give nothing, or their name."""
    rows = [(r["id"], r["token"]) for r in vocab.select("id", "token").collect()]
    first = len(SPECIALS)
    special = {t: t.encode().hex().upper() for t in SPECIALS}
    names = by_id(((i, ("" if skip_specials else special[t]) if i < first else t) for i, t in rows), "string")
    hexed = F.transform(F.col(col), lambda i: F.coalesce(F.get(names, i), F.lit("")))
    return df.withColumn(out, F.decode(F.unhex(F.array_join(hexed, "")), "UTF-8"))
