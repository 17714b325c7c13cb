"""Toxicity and quality classifiers: held-out accuracy, the counterfactual
penalty, ordered thresholds, and the odd cases."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from talewright.llm import quality, toxicity
from talewright.llm.queries import op4_toxicity, op5_quality
from talewright.llm.shared import table


def test_toxicity_held_out(spark, sf01):
    labels = {r.doc_id: r.toxic for r in table(spark, sf01, "labels").collect()}
    rows = op4_toxicity(spark, sf01).collect()
    assert len(rows) == table(spark, sf01, "documents").count()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in held) / len(held) > 0.9
    bad = [r.predicted for r in held if labels[r.doc_id]]
    fine = [r.predicted for r in held if not labels[r.doc_id]]
    assert np.mean(bad) > 0.5 and np.mean(fine) < 0.03


def test_held_out_labels_do_not_matter(spark, make_docs):
    rnd = random.Random(1)
    pairs = [(i, ("vile " if i % 3 == 0 else "kind ") + " ".join(rnd.choice(["a", "b", "c"]) for _ in range(5))) for i in range(200)]
    rows = [(i, 1, int(i % 3 == 0)) for i, _ in pairs]
    flipped = [(i, q, 1 - t if zlib.crc32(str(i).encode()) % 5 == 0 else t) for i, q, t in rows]
    kind = "doc_id long, quality int, toxic int"
    models = [toxicity.train(make_docs(pairs), spark.createDataFrame(x, kind)) for x in (rows, flipped)]
    assert models[0] == models[1] and len(models[0]) > 1


def swap_gap(weight):
    """Mean score change of neutral sentences when an identity term is swapped."""
    rnd = np.random.default_rng(2)
    terms = [t for k, t in toxicity.TERMS if k == "orientation"]
    plain = [f"neutral{i}x" for i in range(40)]
    labels, slots, held = [], [], []
    for i in range(600):
        toxic = i % 2
        words = list(rnd.choice(plain, 6)) + (["insulting"] if toxic and rnd.random() < 0.7 else [])
        # "gay" mostly stands in labelled insults, "straight" in neutral sentences
        term = "gay" if rnd.random() < (0.8 if toxic else 0.1) else "straight"
        buf = np.frombuffer(" ".join([*words, term]).encode(), np.uint8)
        labels.append(toxic)
        slots.append(np.unique(toxicity.features(buf, np.array([0, len(buf)]))[1]))
        held.append(np.array([[t for _, t in toxicity.TERMS].index(term)]))
    toxicity.SWAP_WEIGHT, old = weight, toxicity.SWAP_WEIGHT
    try:
        chosen, w, b = toxicity.fit(np.array(labels), slots, held, 0.5)
    finally:
        toxicity.SWAP_WEIGHT = old
    at = dict(zip(chosen.tolist(), w.tolist(), strict=True))
    score = {t: 1 / (1 + np.exp(-b - sum(at.get(int(s), 0) for s in toxicity.term_features(t)))) for t in terms}
    insult = 1 / (1 + np.exp(-b - sum(at.get(int(s), 0) for s in toxicity.term_features("insulting"))))
    return abs(score["gay"] - score["straight"]), insult


def test_counterfactual_penalty_narrows_the_gap():
    free, _ = swap_gap(0.0)
    bound, insult = swap_gap(1.0)
    assert bound < 0.6 * free and insult > 0.6


def test_toxicity_odd_rows(spark, make_docs):
    pairs = [(1, None), (2, ""), (3, "bad " * 30_000), (None, "x"), (4, "y"), (4, "y")]
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    model = toxicity.train(make_docs(pairs), none)
    rows = toxicity.score(make_docs(pairs), model).collect()
    assert len(rows) == 6 and len({r.score for r in rows}) == 1
    assert {r.held_out for r in rows if r.doc_id is None} == {None}
    odd = spark.createDataFrame([(None, 1, 1), (3, None, None), (4, 1, 1), (4, 1, 0)], "doc_id long, quality int, toxic int")
    assert len(toxicity.score(make_docs(pairs), toxicity.train(make_docs(pairs), odd)).collect()) == 6
    assert toxicity.score(make_docs(pairs).limit(0), model).collect() == []


def test_quality_held_out(spark, sf01):
    labels = table(spark, sf01, "labels")
    half = quality.graded(labels.where("doc_id % 2 = 0"))
    docs = table(spark, sf01, "documents")
    model = quality.train(docs, half, grades=3)
    cuts = [w for s, w in sorted(model, reverse=True) if s < 0]
    assert len(cuts) == 2 and cuts[0] <= cuts[1]
    rows = quality.score(docs, model).join(labels.where("doc_id % 2 = 1"), "doc_id").collect()
    good, poor = [r.selected for r in rows if r.quality], [r.selected for r in rows if not r.quality]
    assert np.mean(good) > 0.98 and np.mean(poor) < 0.1
    assert all(0 <= r.tail <= 1 and r.tail <= r.expected_grade <= 2 for r in rows)


def test_quality_query_and_selection_agree(spark, sf01):
    docs = table(spark, sf01, "documents")
    model = quality.train(docs, quality.graded(table(spark, sf01, "labels")), grades=3)
    chosen = {r.doc_id for r in op5_quality(spark, sf01).where("selected").collect()}
    kept = quality.select_documents(docs, model)
    assert kept.columns == docs.columns and {r.doc_id for r in kept.collect()} == chosen


def test_ordinal_fit_orders_grades():
    rng = np.random.default_rng(0)
    grade = rng.integers(0, 4, 900)
    slots = [np.array([5, 9]) for _ in grade]
    values = [np.array([g + rng.normal(0, 0.4), 1.0]) for g in grade]
    w, theta = quality.fit(grade, slots, values, 4)
    assert (np.diff(theta) > 0).all()
    z = np.array([w[5] * v[0] + w[9] * v[1] for v in values])
    tail = 1 / (1 + np.exp(-(z[:, None] - theta)))
    assert np.mean(np.round(tail.sum(axis=1)) == grade) > 0.7


def test_quality_odd_rows(spark, make_docs):
    pairs = [(1, None), (2, ""), (3, "word " * 30_000), (None, "x y"), (4, "z"), (4, "z")]
    docs = make_docs(pairs)
    none = spark.createDataFrame([], "doc_id long, grade int")
    rows = quality.score(docs, quality.train(docs, none, grades=3)).collect()
    assert sorted(str((r.doc_id, r.selected)) for r in rows) == sorted(str((i, bool(t))) for i, t in pairs)
    kept = quality.select_documents(docs, [])
    assert kept.columns == docs.columns and sorted(str(r.text)[:3] for r in kept.collect()) == ["wor", "x y", "z", "z"]
    one = spark.createDataFrame([(3, 2), (None, 1), (4, None)], "doc_id long, grade int")
    assert len(quality.score(docs, quality.train(docs, one, grades=3)).collect()) == 6
    assert quality.score(docs.limit(0), []).collect() == []
    with pytest.raises(ValueError):
        quality.train(docs, one, grades=1)


def test_sample_is_bounded(spark):
    labels = spark.range(5000).select(F.col("id").alias("doc_id"), (F.col("id") % 2).alias("toxic"))
    sample = toxicity.bounded_sample(labels, "toxic", 100).groupBy("label").count().collect()
    assert {r["label"]: r["count"] for r in sample} == {0: 100, 1: 100}
