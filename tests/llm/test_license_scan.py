"""License scan: base counts against brute force, gaps, and the odd cases."""

import random
import re

import pytest

from talewright.llm.license_scan import BASE_PHRASES, license_scan

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(text):
    w = words_of(text)
    places = [(i, label) for phrase, label in BASE_PHRASES for i in range(len(w)) if w[i:i + len(phrase.split())] == phrase.split()]
    at = [i for i, _ in places]
    return (len(w), len(places), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


def test_base_equals_brute_force(spark, make_docs):
    rnd = random.Random(1)
    parts = ["cc", "by", "CC BY", "general", "public", "license", "General Public License", "all", "rights", "reserved", "all rights-reserved",
             "GNU", "é", "x1", "-", "\n", "cc_by"]
    pairs = [(i, " ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60)))) for i in range(300)]
    rows = license_scan(make_docs(pairs)).collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows}
    assert got == {i: brute(t) for i, t in pairs}
    assert all(0 <= r.score <= 1 and (r.n_base == 0 or r.score == 1) for r in rows)
    assert all(set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) or not r.base_labels for r in rows)


@pytest.mark.parametrize("text,label", [
    ("Released under the MIT License.", "mit"),
    ("Permission is hereby granted, free of charge, to any person who is obtaining a copy of this software and the associated documentation files", "mit"),
    ("Redistribution and use in source or binary forms, with or without modification, are permitted provided the following conditions are met", "bsd"),
    ("xx yy Licensed under CC BY-NC 4.0. zz", "cc-by-nc"),
])
def test_notices_with_gaps(spark, make_docs, text, label):
    row = license_scan(make_docs([(1, "before it " + text + " and after")])).first()
    assert label in row.labels.split(",") and any(s.label == label and s.start >= 0 for s in row.spans)


def test_odd_rows(spark, make_docs):
    pairs = [(1, None), (2, ""), (3, "cc by"), (3, "cc by"), (None, "all rights reserved"), (4, "word " * 50_000 + "cc by"), (5, "-- ..")]
    rows = license_scan(make_docs(pairs)).collect()
    got = sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.base_labels, r.score) for r in rows), key=str)
    assert got == sorted([(1, 0, 0, None, "", 0.0), (2, 0, 0, None, "", 0.0), (3, 2, 1, 0, "cc-by", 1.0), (3, 2, 1, 0, "cc-by", 1.0),
                          (None, 3, 1, 0, "reserved", 1.0), (4, 50_002, 1, 50_000, "cc-by", 1.0), (5, 0, 0, None, "", 0.0)], key=str)
    assert license_scan(make_docs(pairs).limit(0)).collect() == []
    with pytest.raises(ValueError):
        license_scan(make_docs(pairs), notices=[("single", "x")])
