"""The backtracking encoder against the tokenizers library."""

import hashlib
import random

import pytest
from tokenizers import Tokenizer

from talewright.llm.bpe import BytePairCoder, encode_documents, token_digests

PIECES = [" ", "  ", "\n", "\t", "\r", " ", "　", "\x1c", "\x85", "'s", "'ll", "a", "b", "the", "in", "ing", "tion", "1", "23",
          "é", "漢", "😀", "<|endoftext|>", "!", "...", "==", "A", "Ġ", "́", "ß", "²", "​", "aaaa", "zz", "qx"]


@pytest.fixture(scope="module")
def coder(public_file):
    return BytePairCoder(public_file("byte_bpe_50k.json"))


@pytest.fixture(scope="module")
def library(public_file):
    return Tokenizer.from_file(public_file("byte_bpe_50k.json"))


def test_random_texts(coder, library):
    rnd = random.Random(3)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 14))) for _ in range(4000)]
    texts += ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzäéñ") for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    for t, e in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = coder.encode(t)
        assert ids.tolist() == e.ids, t
        assert coder.decode_bytes(ids).decode() == library.decode(e.ids, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["a" * 50_000, "ab" * 20_000, "=-" * 20_000, " " * 50_000, "é" * 20_000])
def test_long_pieces(coder, library, text):
    assert coder.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


def test_documents(spark, make_docs, public_file, library):
    pairs = [(1, None), (2, ""), (3, "Hello  world\n"), (None, "x <|endoftext|> y"), (5, "same"), (5, "same"), (6, "word " * 30_000)]
    rows = token_digests(make_docs(pairs), public_file("byte_bpe_50k.json")).collect()
    assert len(rows) == len(pairs)
    sha = lambda b: hashlib.sha256(b).hexdigest()
    expected = []
    for i, t in pairs:
        ids = library.encode(t or "", add_special_tokens=False).ids
        expected.append((i, len(ids), sha(b"".join(x.to_bytes(4, "little") for x in ids)), sha((t or "").encode())))
    assert sorted(map(tuple, rows), key=str) == sorted(expected, key=str)
    full = {r.doc_id: r for r in encode_documents(make_docs(pairs[:4]), public_file("byte_bpe_50k.json")).collect()}
    assert full[3].ids == library.encode("Hello  world\n").ids and full[3].decoded == "Hello  world\n" and full[1].ids == []
    assert token_digests(make_docs(pairs).limit(0), public_file("byte_bpe_50k.json")).collect() == []


def test_whole_table(spark, sf001, library, public_file):
    from talewright.llm.queries import op3_bpe

    rows = {r.doc_id: r for r in op3_bpe(spark, sf001).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf001}/documents.parquet").collect()}
    assert rows.keys() == texts.keys()
    for i, t in texts.items():
        assert rows[i].n_tokens == len(library.encode(t, add_special_tokens=False).ids)
        assert rows[i].decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
