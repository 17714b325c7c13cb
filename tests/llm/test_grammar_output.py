"""Re-Pair shards: exact round trips, and the library's ids."""

import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from talewright.llm.grammar_output import ChunkEncoder, Grammar, Shard, pack, read_digests, token_files, write_ids


@pytest.mark.parametrize("seed", range(6))
def test_round_trip(seed):
    rng = np.random.default_rng(seed)
    alphabet = [3, 40, 1000, 2, 7, 50_000][seed]
    counts = rng.integers(1, 400, 200)
    ids = rng.integers(0, alphabet, int(counts.sum())).astype(np.uint32)
    ids[np.cumsum(counts) - 1] = 2
    s = Shard(pack(list(range(200)), counts, ids, 60_000))
    assert (s.all() == ids).all()
    ends = np.cumsum(counts)
    for i in (0, 57, 199):
        assert (s.document(i) == ids[ends[i] - counts[i]:ends[i]]).all()
    if alphabet < 100:
        assert len(s.symbols) < len(ids) / 1.3 and len(s.grammar.left)


def test_a_run_of_one_id_and_an_empty_shard():
    ids = np.zeros(4097, np.uint32)
    s = Shard(pack([5], np.array([4097]), ids, 10))
    assert (s.all() == ids).all() and len(s.symbols) < 64
    assert len(Shard(pack([], np.zeros(0, np.int64), np.zeros(0, np.uint32), 10)).all()) == 0
    g, symbols, ends = Grammar.build(np.array([1, 2, 1, 2], np.uint32), np.array([4]), 10)
    assert symbols.tolist() == [1, 2, 1, 2] and ends.tolist() == [4]


def test_chunks_give_the_librarys_ids(public_file):
    path = public_file("word_bpe_49k.json")
    library, enc = Tokenizer.from_file(path), ChunkEncoder(path)
    rnd = random.Random(2)
    parts = [" ", "  ", "\n", "\t", "\r", " ", "　", "\x1c", "\x85", "'s", "'LL", "a", "B", "the", "tion", "1", "23", "é", "É", "漢",
             "😀", "<|endoftext|>", "!", "...", "İ", "ΑΣ", "ß", "ǅ", "​", "́", "ﬁ"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 14))) for _ in range(5000)]
    for t, b in zip(texts, enc.encode(texts), strict=True):
        assert np.frombuffer(b, "<u4").tolist() == library.encode(t, add_special_tokens=False).ids, t


def expected(pairs, library):
    out, at = [], 0
    for i, t in sorted(pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or "")):
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        out.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_files_hold_every_document(spark, make_docs, public_file):
    path = public_file("word_bpe_49k.json")
    rnd = random.Random(4)
    words = ["the", "Cat", "sat,", "on", "mat.", "42", "naïve"]
    pairs = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 90)))) for i in range(120)]
    pairs += [(200, None), (201, ""), (None, "no id"), (5, "again"), (5, "again"), (300, "long word " * 20_000)]
    rows = token_files(make_docs(pairs), path, 2).collect()
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected(pairs, Tokenizer.from_file(path))
    # many small shards give the same answer
    shards = write_ids(make_docs(pairs), path, 2, shard_ids=100)
    small = read_digests(shards).collect()
    assert sorted(map(tuple, small)) == sorted(map(tuple, rows)) if None not in [p[0] for p in pairs] else sorted(map(str, small)) == sorted(map(str, rows))
    assert token_files(make_docs(pairs).limit(0), path, 2).collect() == []
