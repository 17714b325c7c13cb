"""License scan by diagonal voting.

Every word 2-gram of a text is hashed and Spark-joined to the positions at
which license templates hold it (a fixed table of a few hundred rows). A hit at
text word ``p`` and template word ``q`` votes for the diagonal ``p - q``, the
place at which the template would begin. A diagonal with all votes is the
template word for word. Neighbouring diagonals are merged, which allows
inserted and missing words, and a merged span is accepted when enough of the
template's 2-grams are in it and it is not much longer than the template.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import textbytes as tb

K = 2
MERGE_DIAGONALS = 3      # diagonals this near belong to one span
MIN_COVER = 0.7          # share of the template's 2-grams a span must hold
MAX_STRETCH = 1.5        # span words per template word
BASE = "base"

#: Phrases whose every place counts, with the labels they give.
BASE_PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]

#: Notices of well-known licenses, matched with gaps.
NOTICES = [
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at", "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gpl"),
    ("this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl-2.0"),
    ("permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
]


def template_table(spark: SparkSession, base: list[tuple[str, str]], notices: list[tuple[str, str]]) -> DataFrame:
    """(h, template, at, grams, label, exact): one row per 2-gram position,
    and the end mark that every text has once."""
    rows = [(0, -1, 0, 1, None, False)]
    for t, (phrase, label) in enumerate([*base, *notices]):
        grams = tb.signed(tb.kgram_hashes(tb.word_hash_of(phrase), K))
        if not len(grams):
            raise ValueError(f"a template needs {K} words at least: {phrase!r}")
        rows += [(int(h), t, q, len(grams), label, t < len(base)) for q, h in enumerate(grams)]
    return spark.createDataFrame(rows, "h long, template int, at int, grams int, label string, exact boolean")


def _grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, buf, offs in tb.blocks(batches):
        s, e, first = tb.word_spans(buf, offs, tb.ALNUM)
        h = tb.signed(tb.kgram_hashes(tb.span_hashes(buf, s, e), K))
        ok = tb.in_row(first, len(s), K)
        n = np.diff(first)
        sizes = np.maximum(n - K + 1, 0)
        ends = np.cumsum(sizes + 1)
        out = np.zeros(int(ends[-1]), np.int64)       # 0 marks the end of a text
        mark = np.zeros(len(out), bool)
        mark[ends - 1] = True
        out[~mark] = h[ok] if len(h) else h
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(n, pa.int64()), tb.list_column(out, np.r_[0, ends], pa.int64())],
            ["row", "id", "n_words", "grams"])


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *,
                 base: list[tuple[str, str]] = BASE_PHRASES, notices: list[tuple[str, str]] = NOTICES) -> DataFrame:
    """One row per input row: (id, n_words, n_base, first_word, last_word,
    base_labels, labels, spans, score).

    Words are runs of digits, letters and characters beyond ASCII, A-Z lower-
    cased. ``n_base`` counts all places of the base phrases, ``first_word`` and
    ``last_word`` are their smallest and largest start (null without any).
    ``spans`` lists (label, start, end, cover) of the accepted spans in order
    and ``score`` is the largest cover (0 without a span, 1 with a base
    phrase). Label strings are empty without labels. Null and empty texts have
    0 words and no spans; null ids and repeated rows stay, row for row.
    """
    spark = docs.sparkSession
    d = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = d.schema["id"].dataType.simpleString()
    grams = d.mapInArrow(_grams, f"row long, id {kind}, n_words long, grams array<long>")
    rolled = grams.select("row", "id", "n_words", F.posexplode("grams").alias("p", "h"))
    # the template table is fixed by the arguments: a row per template word
    hits = rolled.join(F.broadcast(template_table(spark, base, notices)), "h").repartition("row")
    diagonal = (F.col("p") - F.col("at")).alias("diagonal")
    votes = hits.groupBy("row", "id", "n_words", "template", "grams", "label", "exact", diagonal).agg(
        F.count("*").alias("votes"), F.collect_set("at").alias("held"), F.min("p").alias("lo"), F.max("p").alias("hi"))
    near = Window.partitionBy("row", "template").orderBy("diagonal")
    new = F.when(F.col("exact") | (F.col("template") < 0), True).otherwise(
        F.coalesce(F.col("diagonal") - F.lag("diagonal").over(near) > MERGE_DIAGONALS, F.lit(True)))
    votes = votes.withColumn("new", new.cast("int")).withColumn("span", F.sum("new").over(near))
    spans = votes.groupBy("row", "id", "n_words", "template", "grams", "label", "exact", "span").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("held")))).alias("covered"),
        F.min("lo").alias("start"), (F.max("hi") + K).cast("long").alias("end"))
    cover = F.col("covered") / F.col("grams")
    good = (F.col("template") >= 0) & F.when(F.col("exact"), F.col("covered") == F.col("grams")).otherwise(
        (cover >= MIN_COVER) & (F.col("end") - F.col("start") <= MAX_STRETCH * (F.col("grams") + K - 1)))
    spans = spans.withColumn("good", good).withColumn("cover", cover).withColumn("start", F.col("start").cast("long"))
    is_base = F.col("good") & F.col("exact")
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    out = spans.groupBy("row", "id", "n_words").agg(
        F.count(F.when(is_base, 1)).alias("n_base"),
        F.min(F.when(is_base, F.col("start"))).alias("first_word"),
        F.max(F.when(is_base, F.col("start"))).alias("last_word"),
        joined(F.when(is_base, F.col("label"))).alias("base_labels"),
        joined(F.when(F.col("good"), F.col("label"))).alias("labels"),
        F.array_sort(F.collect_list(F.when(F.col("good"), F.struct("start", "end", "label", "cover")))).alias("spans"),
        F.coalesce(F.max(F.when(F.col("good"), F.col("cover"))), F.lit(0.0)).alias("score"))
    return out.drop("row").withColumnRenamed("id", id_col)


def oracle(base: list[tuple[str, str]] = BASE_PHRASES, notices: list[tuple[str, str]] = NOTICES) -> str:
    """The digest columns of :func:`license_scan` in DuckDB SQL."""
    rows = ", ".join(f"({t}, '{p}', '{label}', {str(t < len(base)).lower()})" for t, (p, label) in enumerate([*base, *notices]))
    return f"""
WITH t AS (SELECT * FROM (VALUES {rows}) v(template, phrase, label, exact)),
tw AS (SELECT template, label, exact, string_split(phrase, ' ') ws FROM t),
tg AS (SELECT template, label, exact, len(ws) - 1 AS grams, i - 1 AS q, ws[i] || ' ' || ws[i + 1] AS g
       FROM (SELECT *, unnest(range(1, len(ws))) AS i FROM tw)),
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') ws FROM documents),
dg AS (SELECT doc_id, i - 1 AS p, ws[i] || ' ' || ws[i + 1] AS g
       FROM (SELECT doc_id, ws, unnest(range(1, len(ws))) AS i FROM d)),
hit AS (SELECT doc_id, template, label, exact, grams, p, q, p - q AS diagonal FROM dg JOIN tg USING (g)),
diag AS (SELECT DISTINCT doc_id, template, exact, diagonal FROM hit),
fresh AS (SELECT *, CASE WHEN exact THEN 1 WHEN diagonal - lag(diagonal) OVER w <= {MERGE_DIAGONALS} THEN 0 ELSE 1 END AS f
          FROM diag WINDOW w AS (PARTITION BY doc_id, template ORDER BY diagonal)),
numbered AS (SELECT *, sum(f) OVER (PARTITION BY doc_id, template ORDER BY diagonal) AS span FROM fresh),
spans AS (SELECT h.doc_id, h.template, h.label, h.exact, h.grams, n.span, count(DISTINCT q) AS covered, min(p) AS s, max(p) + {K} AS e
          FROM hit h JOIN numbered n ON h.doc_id = n.doc_id AND h.template = n.template AND h.diagonal = n.diagonal
          GROUP BY ALL),
good AS (SELECT * FROM spans WHERE CASE WHEN exact THEN covered = grams
         ELSE covered / grams >= {MIN_COVER} AND e - s <= {MAX_STRETCH} * (grams + {K} - 1) END),
agg AS (SELECT doc_id, count(*) FILTER (exact) AS n_base, min(s) FILTER (exact) AS first_word, max(s) FILTER (exact) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
        string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(covered / grams) AS score FROM good GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_base, 0) AS n_base, CAST(first_word AS BIGINT) AS first_word,
       CAST(last_word AS BIGINT) AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       CAST(coalesce(score, 0) AS DOUBLE) AS score
FROM d LEFT JOIN agg USING (doc_id)
"""
