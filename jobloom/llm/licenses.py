"""License texts by diagonal voting over word k-grams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from jobloom.llm.words import ALNUM_WORD, LOWER, UPPER, ascii_lower, known, words

# The phrases whose places are counted, with their labels.
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Public license notices, with their labels.
TEMPLATES = [
    ("apache", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not "
     "use this file except in compliance with the License. You may obtain a copy of the "
     "License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
     "or agreed to in writing, software distributed under the License is distributed on an "
     "\"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. "
     "See the License for the specific language governing permissions and limitations under "
     "the License."),
    ("apache", "Licensed under the Apache License, Version 2.0."),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, "
     "are permitted provided that the following conditions are met: Redistributions of source "
     "code must retain the above copyright notice, this list of conditions and the following "
     "disclaimer."),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International "
     "License."),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the "
     "terms of the GNU General Public License as published by the Free Software Foundation, "
     "either version 3 of the License, or (at your option) any later version."),
    ("gpl", "This program is distributed in the hope that it will be useful, but WITHOUT ANY "
     "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A "
     "PARTICULAR PURPOSE. See the GNU General Public License for more details."),
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of "
     "this software and associated documentation files (the \"Software\"), to deal in the "
     "Software without restriction, including without limitation the rights to use, copy, "
     "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
     "to permit persons to whom the Software is furnished to do so, subject to the following "
     "conditions: The above copyright notice and this permission notice shall be included in "
     "all copies or substantial portions of the Software."),
    ("mit", "Released under the MIT License."),
]

K = 4               # words of a gram
NEIGHBOUR = 2       # diagonals at most so far apart are one span
LEAST_SCORE = 0.5   # share of the template's words that a verified span holds


def _grams(tokens: Column) -> Column:
    """All K-word grams in order: hash, and the words themselves."""
    return F.when(F.size(tokens) >= K, F.transform(
        F.sequence(F.lit(0), F.size(tokens) - K),
        lambda i: F.struct(F.xxhash64(*[F.get(tokens, i + j) for j in range(K)]).alias("gram"),
                           F.slice(tokens, i + 1, K).alias("own"))))


def _tokens(text_col: str) -> Column:
    return words(ascii_lower(known(F.col(text_col))))


def template_table(spark: SparkSession, templates=TEMPLATES) -> DataFrame:
    """template, label, tokens: one row per template text."""
    values = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(templates))
    rows = spark.sql(f"select * from values {values} as t(template, label, text)")
    return rows.select("template", "label", _tokens("text").alias("tokens"))


def diagonal_spans(docs: DataFrame, templates: DataFrame, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Verified spans: _id, _text, template, label, first_word, last_word, score.

    Every gram of every document is joined with the template positions of that gram, and
    each match is verified word for word; votes are counted for each (document, template,
    diagonal), where the diagonal is the document position minus the template position;
    neighbouring diagonals merge into one span, which is kept when the template words it
    covers are LEAST_SCORE of the template. Templates are a fixed table of some hundred grams,
    so they are broadcast: only votes leave the task that reads a document, pre-aggregated.
    """
    length = F.size("tokens").alias("length")
    grams = templates.select("template", "label", length, F.posexplode(
        _grams(F.col("tokens"))).alias("_t", "g")).select(
        "template", "label", "length", "_t", F.col("g.gram").alias("gram"), F.col("g.own").alias("_w"))
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(known(F.col(text_col))).alias("_text"),
                       _tokens(text_col).alias("tokens"))
    places = rows.select("_id", "_text", F.posexplode(_grams(F.col("tokens"))).alias("_d", "g"))
    places = places.select("_id", "_text", "_d", F.col("g.gram").alias("gram"),
                           F.col("g.own").alias("_o"))
    met = places.join(F.broadcast(grams), "gram").filter(F.col("_o") == F.col("_w"))
    votes = met.groupBy("_id", "_text", "template", "label", "length",
                        (F.col("_d") - F.col("_t")).alias("diagonal")).agg(
        F.min("_d").alias("first"), F.max("_d").alias("last"), F.collect_set("_t").alias("hit"))
    # One document's votes for one template: bounded by the document.
    by = Window.partitionBy("_id", "_text", "template").orderBy("diagonal")
    far = F.col("diagonal") - F.lag("diagonal").over(by) > NEIGHBOUR
    runs = votes.withColumn("_new", F.coalesce(far, F.lit(True)).cast("int")).withColumn(
        "_run", F.sum("_new").over(by))
    spans = runs.groupBy("_id", "_text", "template", "label", "length", "_run").agg(
        F.min("first").alias("first_word"), (F.max("last") + K - 1).alias("last_word"),
        F.array_distinct(F.flatten(F.collect_list("hit"))).alias("hit"))
    covered = F.array_distinct(F.flatten(F.transform(
        "hit", lambda t: F.sequence(t, t + (K - 1)))))
    scored = spans.withColumn("score", F.size(covered) / F.col("length"))
    return scored.filter(F.col("score") >= LEAST_SCORE).select(
        "_id", "_text", "template", "label", "first_word", "last_word", "score")


def phrase_places(tokens: Column, phrase: str) -> Column:
    """Word positions at which the phrase's words stand one after another."""
    parts = phrase.split(" ")

    def at(x, i):
        test = x == parts[0]
        for j, p in enumerate(parts[1:], 1):
            test = test & F.coalesce(F.get(tokens, i + j) == p, F.lit(False))
        return F.when(test, i.cast("long"))

    return F.when(F.array_contains(tokens, parts[-1]) & F.array_contains(tokens, parts[0]),
                  F.filter(F.transform(tokens, at), lambda p: p.isNotNull())).otherwise(
        F.array().cast("array<long>"))


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  templates=TEMPLATES) -> DataFrame:
    """One row per document: id, n_words, n_base, first_word, last_word, base_labels, labels,
    score.

    The base columns report the phrases; ``labels`` adds those of verified spans; ``score`` is
    the largest share of a template's words that a verified span covers, or 0.5 where
    only phrases were found, else 0. Null text counts as empty: no words, null places, empty
    labels. Rows that repeat id and text give equal rows; other columns are ignored.
    """
    spark = docs.sparkSession
    spans = diagonal_spans(docs, template_table(spark, templates), id_col, text_col)
    method = spans.groupBy("_id", "_text").agg(
        F.collect_set("label").alias("_labels"), F.max("score").alias("_score")).select(
        F.col("_id").alias("_i"), F.col("_text").alias("_x"), "_labels", "_score")
    rows = docs.select(F.col(id_col).alias("_id"), F.xxhash64(known(F.col(text_col))).alias("_text"),
                       _tokens(text_col).alias("tokens"))
    found = rows.select("_id", "_text", F.size("tokens").cast("long").alias("n_words"), *[
        phrase_places(F.col("tokens"), p).alias(f"_p{i}") for i, p in enumerate(PHRASES)])
    places = [F.col(f"_p{i}") for i in range(len(PHRASES))]
    base = F.array_sort(F.array_distinct(F.filter(F.array(*[
        F.when(F.size(p) > 0, F.lit(label)) for p, label in zip(places, PHRASES.values())]),
        lambda x: x.isNotNull())))
    everywhere = F.concat(*places)
    narrow = found.select("_id", "_text", "n_words", F.size(everywhere).cast("long").alias("n_base"),
                          F.array_min(everywhere).alias("first_word"),
                          F.array_max(everywhere).alias("last_word"), base.alias("_base"))
    joined = narrow.join(method, F.col("_id").eqNullSafe(F.col("_i"))
                         & (F.col("_text") == F.col("_x")), "left")
    labels = F.coalesce(F.col("_labels"), F.array().cast("array<string>"))
    return joined.select(
        F.col("_id").alias(id_col), "n_words", "n_base", "first_word", "last_word",
        F.array_join("_base", ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(F.col("_base"), labels)), ",").alias("labels"),
        F.coalesce(F.col("_score"), F.when(F.col("n_base") > 0, F.lit(0.5)), F.lit(0.0)).alias(
            "score"))


def _sql() -> str:
    """The same scan in SQL: grams as texts instead of hashes."""
    split = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{ALNUM_WORD}')"
    places = " union all ".join(
        f"select doc_id, k - 1 as pos, '{label}' as label from p where "
        + " and ".join(f"ws[k + {j}] = '{w}'" for j, w in enumerate(phrase.split(" ")))
        for phrase, label in PHRASES.items())
    texts = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))
    return f"""
with w as (select doc_id, {split} as ws from documents),
p as (select doc_id, ws, unnest(range(1, len(ws) + 1)) as k from w),
base as ({places}),
t as (select template, label, {split} as ws from (values {texts}) as v(template, label, text)),
g as (select template, label, len(ws) as length, k, array_to_string(ws[k:k + {K - 1}], ' ') as gram
  from (select *, unnest(range(1, len(ws) - {K - 2})) as k from t)),
votes as (
  select doc_id, template, label, length, p.k as d, g.k as t, p.k - g.k as diagonal
  from p join g on array_to_string(ws[p.k:p.k + {K - 1}], ' ') = gram
  where p.k + {K - 1} <= len(ws)),
marked as (
  select *, sum(fresh) over (partition by doc_id, template order by diagonal) as run from (
    select *, case when diagonal - lag(diagonal) over (
        partition by doc_id, template order by diagonal) <= {NEIGHBOUR} then 0 else 1 end as fresh
    from (select distinct doc_id, template, diagonal from votes))),
spans as (
  select doc_id, label, count(distinct pos) / length as score from (
    select doc_id, template, label, length, run, unnest(range(t, t + {K})) as pos
    from votes join marked using (doc_id, template, diagonal))
  group by doc_id, template, label, length, run),
method as (select doc_id, list(distinct label) as labels, max(score) as score
  from spans where score >= {LEAST_SCORE} group by doc_id),
counted as (select doc_id, count(*) as n, min(pos) as lo, max(pos) as hi,
  list(distinct label) as labels from base group by doc_id)
select doc_id, cast(len(ws) as bigint) as n_words, cast(coalesce(n, 0) as bigint) as n_base,
  cast(lo as bigint) as first_word, cast(hi as bigint) as last_word,
  array_to_string(list_sort(coalesce(c.labels, [])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(c.labels, []),
    coalesce(m.labels, [])))), ',') as labels,
  coalesce(m.score, case when n > 0 then 0.5 end, 0.0)::double as score
from w left join counted c using (doc_id) left join method m using (doc_id)
"""


SQL = _sql()
