"""q-gram filtering against a plain edit-distance search, and the odd cases."""

import random
import re

import numpy as np
import pytest

from talewright.llm.qgram_decontam import EDIT_RATE, PASSAGE, ItemIndex, edit_distance, leaks


def plain_distance(pattern, text):
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def normal(t):
    return " ".join(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()))


def test_banded_alignment():
    rnd = random.Random(1)
    for _ in range(150):
        p = "".join(rnd.choice("abc ") for _ in range(rnd.randint(20, 60)))
        t = list(p)
        for _ in range(rnd.randint(0, 5)):
            at = rnd.randrange(len(t))
            t[at:at + rnd.randint(0, 1)] = rnd.choice(["", "x", "yz"])
        t = "abca"[:rnd.randint(0, 4)] + "".join(t) + "cab"[:rnd.randint(0, 3)]
        exact = plain_distance(p, t)
        got, _ = edit_distance(p.encode(), t.encode(), 6, 40)
        assert got == min(exact, 7)


def corpus(seed):
    rnd = random.Random(seed)
    parts = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or", "nt", "ea", "ti"]
    word = lambda: "".join(rnd.choice(parts) for _ in range(rnd.randint(1, 4)))
    items = [(i, " ".join(word() for _ in range(rnd.randint(6, 45))).capitalize() + ".") for i in range(30)]
    docs = []
    for i in range(150):
        text = " ".join(word() for _ in range(rnd.randint(0, 150)))
        if i % 2:
            item = rnd.choice(items)[1]
            chars = list(item)
            for _ in range(rnd.randint(0, len(item) // 10)):
                at = rnd.randrange(len(chars))
                chars[at] = rnd.choice(["", "q", "xx", chars[at]])
            text = text[:len(text) // 2] + " " + "".join(chars) + " " + text[len(text) // 2:]
        docs.append((i, text.upper() if i % 5 == 0 else text.replace(" ", "  \n") if i % 5 == 1 else text))
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_search(spark, make_docs, seed):
    docs, items = corpus(seed)
    index = ItemIndex(items, EDIT_RATE)
    expected = set()
    for i, t in docs:
        text = normal(t)
        for item, part, _, most in index.segments:
            part = part.decode()
            # pieces of which one must stand unchanged if at most `most` edits were made
            size = len(part) // (most + 1)
            if any(part[k * size:(k + 1) * size] in text for k in range(most + 1)) and plain_distance(part, text) <= most:
                expected.add((i, item))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in leaks(make_docs(docs), bench).collect()}
    # a region is found at its surroundings' spaces as well, which the row's ends do not have
    assert expected <= got
    for i, item in got - expected:
        assert plain_distance(normal(dict(items)[item])[:40], normal(dict(docs)[i])) <= 40 * 0.2
    assert len(got - expected) <= 0.02 * len(got) + 1


def test_spans_in_characters(spark, make_docs):
    item = "Éané the thonder of inea ereth ÜBER onting shther anont, reeding; tionth esar"
    text = "Ç first… " + item.upper() + " and more words behind it"
    r = leaks(make_docs([(1, text)]), spark.createDataFrame([(9, item)], "item_id long, text string")).first()
    assert (r.doc_id, r.item_id, r.edits) == (1, 9, 0) and text.lower()[r.start:r.end].strip() == item.lower()


def test_odd_rows(spark, make_docs):
    item = " ".join(f"bench{i}mark" for i in range(14))
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "short"), (None, item)], "item_id long, text string")
    pairs = [(1, None), (2, ""), (3, item), (3, item), (None, "x " + item), (4, "pad " * 40_000 + item + " pad" * 10), (5, "clean words only")]
    rows = leaks(make_docs(pairs), bench).collect()
    assert sorted(str((r.doc_id, r.item_id, r.edits)) for r in rows) == sorted(["(3, 1, 0)", "(3, 1, 0)", "(None, 1, 0)", "(4, 1, 0)"])
    assert leaks(make_docs(pairs), bench.limit(0)).collect() == []
    assert leaks(make_docs(pairs).limit(0), bench).collect() == []


def test_chunks_of_items(spark, make_docs, monkeypatch):
    from talewright.llm import qgram_decontam

    docs, items = corpus(5)
    bench = spark.createDataFrame(items, "item_id long, text string")
    one = {tuple(r)[1:] for r in leaks(make_docs(docs, 1), bench).collect()}
    monkeypatch.setattr(qgram_decontam, "CHUNK_BYTES", 4000)
    many = {tuple(r)[1:] for r in leaks(make_docs(docs, 1), bench).collect()}
    assert one == many and len(one) > 20


def test_index_bound_is_positive():
    index = ItemIndex([(1, "word " * 60), (2, "x" * 20), (3, "tiny")], 0.5)
    assert (index.bound >= 1).all() and len({s[0] for s in index.segments}) == 2
    assert index.find(np.zeros(0, np.uint8), np.array([0, 0])) == []


def test_partial_quotes_at_every_word(spark, make_docs):
    items = [(i, t) for i, t in corpus(3)[1] if len(t.split()) >= PASSAGE]
    quotes = [(item, " ".join(words[a:a + PASSAGE])) for item, t in items for words in [t.split()] for a in range(len(words) - PASSAGE + 1)]
    docs = [(i, f"some clean words stand before {q}, and others behind it") for i, (_, q) in enumerate(quotes)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r for r in leaks(make_docs(docs), bench).collect()}
    assert len(docs) > 300 and all(got[i, item].edits == 0 for i, (item, _) in enumerate(quotes))
    assert all(text[r.start:r.end].lower().strip(" ,.") in text.lower() and r.start >= 20 for (i, _), r in got.items() for text in [docs[i][1]])
    # three edits in the middle of every passage
    edited = [(q[:20] + "z" + q[21:40] + "zz" + q[40:]) for _, q in quotes]
    docs = [(i, f"some clean words stand before {q}, and others behind it") for i, q in enumerate(edited)]
    found = {(r.doc_id, r.item_id) for r in leaks(make_docs(docs), bench).collect()}
    assert all((i, item) in found for i, (item, q) in enumerate(quotes) if len(q) >= 60)


def test_passage_of_a_script_without_spaces(spark, make_docs):
    rnd = random.Random(4)
    item = "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(300))
    docs = [(a, "一二三" + item[a:a + 28] + "四五六") for a in range(0, 272)]
    got = leaks(make_docs(docs), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r.doc_id for r in got} == set(range(272))


def test_short_items_are_whole_words(spark, make_docs):
    bench = spark.createDataFrame([(1, "Paris"), (2, "the big house"), (3, "ü"), (4, "house: 7")], "item_id long, text string")
    docs = [(1, "In PARIS."), (2, "parish"), (3, "comparis"), (4, "The big\nhouse 7"), (5, "the big"), (6, "house"), (7, "see the big houses"), (8, "x Ü y")]
    got = {(r.doc_id, r.item_id): r for r in leaks(make_docs(docs), bench).collect()}
    assert set(got) == {(1, 1), (4, 2), (4, 4), (8, 3)}
    assert (got[4, 4].start, got[4, 4].end, got[4, 4].edits, got[4, 4].matched) == (8, 15, 0, 7)


def test_passage_cut_off_by_the_end_of_a_row():
    item = " ".join(f"some{i}thing els{i}e" for i in range(12))
    index = ItemIndex([(1, item)], EDIT_RATE)
    for n in range(1, len(item)):
        for part in (item[:n], item[-n:]):
            buf = np.frombuffer((part + "another row of words").encode(), np.uint8)
            found = index.find(buf, np.array([0, n, len(buf)]))
            assert all(r == 0 and b <= n for r, _, _, _, b in found)
            assert bool(found) or n < index.length.max() + 20
