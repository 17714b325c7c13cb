"""The pipeline's stages against what each must keep and drop."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F
from test_minhash import brute as near_brute
from test_suffix_dedup import brute as repeats

from __spark_entry__ import oracle_sql, queries
from talewright.llm.shared import land, table


@pytest.fixture(scope="module")
def steps(spark, sf001):
    docs, out = table(spark, sf001, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        docs = land(stage(spark, docs, sf001))
        out.append((name, docs))
    return out


def rows(df):
    return {r.doc_id: r for r in df.collect()}


def test_stage_names_and_columns(steps, spark, sf001):
    names = table(spark, sf001, "documents").columns
    assert [n for n, _ in steps] == ["quality_classifier", "minhash_near_dedup", "suffix_array_dedup", "benchmark_decontamination", "bpe_encoding"]
    assert all(df.columns == names for _, df in steps[:-1])


def test_quality_keeps_good_documents(steps, spark, sf001):
    kept = set(rows(steps[0][1]))
    labels = table(spark, sf001, "labels").collect()
    good, poor = {r.doc_id for r in labels if r.quality}, {r.doc_id for r in labels if not r.quality}
    assert len(good - kept) <= 0.02 * len(good) and len(poor & kept) <= 0.1 * len(poor)


def test_near_dedup_keeps_one_of_each_group(steps):
    before, after = rows(steps[0][1]), rows(steps[1][1])
    comp = near_brute([(i, r.text) for i, r in before.items()], 5, 80)
    assert set(after) == set(comp.values()) and all(after[i] == before[i] for i in after)


def test_passages_are_cut_once(steps):
    before, after = rows(steps[1][1]), rows(steps[2][1])
    spans = repeats([(i, r.text) for i, r in before.items()], 50)
    later = {i for i, _, _, kept in spans if not kept}
    assert all(after[i].text == r.text for i, r in before.items() if i not in later)
    for i in later:
        gone = set()
        for j, a, b, kept in spans:
            if j == i and not kept:
                gone |= set(range(a, b))
        words = [w for n, w in enumerate(before[i].text.split()) if n not in gone]
        assert (after[i].text.split() if i in after else []) == words


def test_leaks_go(steps, spark, sf001):
    before, after = rows(steps[2][1]), rows(steps[3][1])
    items = [" ".join(r.text.split()) for r in table(spark, sf001, "benchmark").collect()]
    leaked = {i for i, r in before.items() if any(t in " ".join(r.text.split()) for t in items)}
    assert not leaked & set(after) and len(before) - len(after) <= len(leaked) + 2


def test_encoding_and_run(steps, spark, sf001):
    assert set(rows(steps[4][1])) == set(rows(steps[3][1]))
    run = corpus_pipeline.run(spark, sf001)
    assert {tuple(r) for r in run.collect()} == {tuple(r) for r in steps[4][1].collect()}


def test_odd_rows_pass_every_stage(spark, make_docs, sf001):
    docs = make_docs([(1, None), (2, ""), (3, "some words here"), (3, "some words here"), (None, "a text without id"), (4, "word " * 20_000)])
    for start in (docs, docs.limit(0)):
        d = start
        for _, stage in corpus_pipeline.STAGES:
            d = land(stage(spark, d, sf001))
            d.count()
    near = dict(corpus_pipeline.STAGES)["minhash_near_dedup"](spark, docs, sf001)
    assert sorted(str(r.doc_id) for r in near.collect()) == sorted(["1", "2", "3", "None", "4"])


def test_unlike_texts_of_one_id_stay(spark, make_docs, sf001):
    words = lambda name, n=60: " ".join(f"{name}{i}" for i in range(n))
    a, b, c = words("a"), words("b"), words("c")
    docs = [(1, a), (1, b), (1, a), (1, a + " more"), (2, b + " tail"), (2, c), (3, c), (3, None), (3, None), (3, ""), (None, a), (None, a)]
    docs = make_docs(docs).withColumn("label", F.concat(F.lit("l"), F.monotonically_increasing_id().cast("string")))
    near = dict(corpus_pipeline.STAGES)["minhash_near_dedup"]
    kept = [tuple(r) for r in near(spark, docs, sf001).collect()]
    texts = sorted(str((r[0], r[1])) for r in kept)
    one = [t for t in texts if t in (str((1, a)), str((1, a + " more")))]
    assert len(one) == 1
    assert sorted(set(texts) - set(one)) == sorted(map(str, [(1, b), (2, c), (3, None), (3, ""), (None, a)])) and len(texts) == 7
    again = [tuple(r) for r in near(spark, docs.repartition(7, "label"), sf001).collect()]
    assert sorted(map(str, again)) == sorted(map(str, kept))


def test_every_operator_is_registered():
    names = queries()
    assert {n.split("_")[0] for n in names if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in names and set(oracle_sql()) <= set(names)
