"""Licence scan: statements in files by TF-IDF cosine to templates, then inheritance down the directories.

A statement is a sentence or line with a licence word in it. Its distinct terms
are weighted by how rare they are among all statements of the corpus and compared
with every template; no row is multiplied and nothing is shuffled for that. A
directory's licence is stated by a licence file in it, or by a file that opens or
ends with a statement; other files take the one of the nearest directory above.
"""

from __future__ import annotations

import math
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gaugeflow.session import materialise

# Usual sentences by which licences are named.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0", "You may not use this file except in compliance with the License"],
    "BSD-3-Clause": ["Redistribution and use in source and binary forms, with or without modification, are permitted", "Released under the BSD License"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License"],
    "CC0-1.0": ["Released under CC0 1.0 Universal public domain dedication license"],
    "GPL-2.0": ["This work is licensed under the GNU General Public License, version 2"],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3"],
    "ISC": ["Released under the ISC License"],
    "LGPL-3.0": ["This library is licensed under the GNU Lesser General Public License, version 3"],
    "MIT": ["Released under the MIT License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software under the MIT License"],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0"],
    "Proprietary": ["All rights reserved. Use without a written license agreement is prohibited", "Proprietary and confidential license"],
}
# Fixed values.
CUE = r"licen[cs]|copyright|redistribution|all rights reserved|spdx|permission is hereby granted|public domain"
LICENCE_FILE = r"(?i)(^|/)(licen[cs]es?|copying|notice|unlicense)(\.[a-z]+)?$"
SENTENCE_END = r"[.;!?]\s+"
TERM = r"[a-z0-9]+(?:[.][0-9]+)*"
MIN_SCORE = 0.6


def template_terms() -> list[tuple[str, list[str]]]:
    """(licence, distinct terms) of every template sentence."""
    return [(name, sorted(set(re.findall(TERM, t.lower())))) for name, texts in sorted(TEMPLATES.items()) for t in texts]


def statements(text: Column) -> Column:
    """Distinct terms of each sentence or line with a licence word, in order: array of (line, terms)."""
    lines = F.filter(F.transform(F.split(text, "\n", -1), lambda x, i: F.struct(i.alias("line"), F.lower(x).alias("text"))), lambda x: x["text"].rlike(CUE))
    sentences = F.flatten(F.transform(lines, lambda x: F.transform(F.split(x["text"], SENTENCE_END, -1), lambda s: F.struct(x["line"].alias("line"), s.alias("text")))))
    hit = F.filter(sentences, lambda s: s["text"].rlike(CUE))
    return F.transform(hit, lambda s: F.struct(s["line"].alias("line"), F.array_distinct(F.regexp_extract_all(s["text"], F.lit(TERM), F.lit(0))).alias("terms")))


def term_weights(found: DataFrame) -> tuple[dict[str, float], float]:
    """Weight of every template term, and of all other terms, from the statements of all files."""
    vocabulary = sorted({t for _, terms in template_terms() for t in terms})
    # Never more rows than the templates have terms.
    each = found.select(F.explode("statements").alias("s"))
    rows = each.select(F.explode(F.array_union(F.array_intersect("s.terms", F.array(*map(F.lit, vocabulary))), F.array(F.lit("")))).alias("term"))
    seen = {r.term: r.n for r in rows.groupBy("term").agg(F.count("*").alias("n")).collect()}
    total = seen.get("", 0)  # one empty term for each statement
    return {t: round(math.log((1 + total) / (1 + seen.get(t, 0))) + 1, 6) for t in vocabulary}, round(math.log(1 + total) + 1, 6)


def best_template(terms: Column, weights: dict[str, float], other: float) -> Column:
    """struct(score, licence): the highest cosine, ties to the first name."""
    vocabulary = F.array(*(F.lit(t) for t in sorted(weights)))

    def total(known: Column) -> Column:
        table = F.create_map(*(F.lit(x) for t, w in sorted(weights.items()) for x in (t, w * w)))
        return F.aggregate(known, F.lit(0.0), lambda a, t: a + table[t])

    def score(known: Column) -> Column:
        norm = F.sqrt(total(known) + (F.size(terms) - F.size(known)) * F.lit(other * other))
        cosines = []
        for name, own in template_terms():
            length = math.sqrt(sum(weights[t] ** 2 for t in own))
            common = F.array_intersect(known, F.array(*map(F.lit, own)))
            cosines.append(F.struct((-F.round(total(common) / (norm * length), 4)).alias("minus"), F.lit(name).alias("licence")))
        best = F.array_min(F.array(*cosines))
        return F.struct((-best["minus"]).alias("score"), best["licence"].alias("licence"))

    return F.transform(F.array(F.array_intersect(terms, vocabulary)), score)[0]


def scan_licences(files: DataFrame, id_col: str = "doc_id", path_col: str = "path", text_col: str = "text", min_score: float = MIN_SCORE) -> DataFrame:
    """(doc_id, path, own_licence, own_score, licence, found_in) of every row.

    ``found_in`` is the directory whose licence was inherited, null for the file's
    own. A text that is null or has no statement close enough has no own licence;
    a file without path inherits nothing. If several files speak for a directory,
    the one with the smallest path does. Repeated rows give repeated rows.
    """
    files = files.select(F.col(id_col).cast("long").alias("doc_id"), F.col(path_col).cast("string").alias("path"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    hinted = F.when(F.lower("text").rlike(CUE), statements(F.col("text"))).otherwise(F.expr("cast(array() as array<struct<line:int,terms:array<string>>>)"))
    lines = F.size(F.split("text", "\n", -1))
    found = materialise(files.select("doc_id", "path", lines.alias("lines"), hinted.alias("statements")), "statements")
    weights, other = term_weights(found)
    scored = F.transform("statements", lambda s: F.transform(F.array(best_template(s["terms"], weights, other)), lambda b: F.struct((-b["score"]).alias("minus"), b["licence"].alias("licence"), s["line"].alias("line")))[0])
    close = F.filter(scored, lambda s: s["minus"] <= -min_score)
    own = found.select("doc_id", "path", F.array_min(close).alias("best"), F.exists(close, lambda s: s["line"].isin(0, F.col("lines") - 1)).alias("outer"))
    own = own.select("doc_id", "path", F.regexp_replace("path", "/[^/]*$", "").alias("dir"), "outer", F.col("best.licence").alias("own_licence"), (-F.col("best.minus")).alias("own_score"))
    own = materialise(own, "own-licences")

    speaks = own.where(F.col("own_licence").isNotNull() & F.col("path").contains("/") & (F.col("outer") | F.col("path").rlike(LICENCE_FILE)))
    stated = speaks.groupBy("dir").agg(F.min_by("own_licence", F.struct("path", "own_licence")).alias("stated")).withColumnRenamed("dir", "above")
    dirs = own.where(F.col("path").contains("/")).select("dir").distinct()
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    chain = dirs.select("dir", F.explode(above).alias("above")).join(stated, "above")
    nearest = chain.groupBy("dir").agg(F.max_by(F.struct("stated", "above"), F.length("above")).alias("n")).select(F.col("dir").alias("d"), "n.stated", "n.above")
    all_ = own.join(nearest, (F.col("dir") == F.col("d")) & F.col("path").contains("/"), "left")
    inherited = F.col("own_licence").isNull()
    return all_.select("doc_id", "path", "own_licence", "own_score", F.coalesce("own_licence", "stated").alias("licence"), F.when(inherited, F.col("above")).alias("found_in"))


def document_paths(docs: DataFrame) -> DataFrame:
    """Documents as files: their source is a directory, every hundred ids one below it."""
    return docs.select("doc_id", F.concat_ws("/", F.lit(""), "source", F.expr("doc_id div 100"), "doc_id").alias("path"), "text")


def oracle() -> str:
    """The same for DuckDB."""
    templates = ", ".join(f"({k}, '{name}', '{t}')" for k, (name, terms) in enumerate(template_terms()) for t in terms)
    return f"""
WITH templates(k, licence, term) AS (VALUES {templates}),
vocabulary AS (SELECT DISTINCT term FROM templates),
files AS (SELECT doc_id, '/' || source || '/' || (doc_id // 100) || '/' || doc_id AS path, '/' || source || '/' || (doc_id // 100) AS dir, source, text FROM documents),
lines AS (SELECT doc_id, unnest(string_split(lower(text), chr(10))) AS line, generate_subscripts(string_split(lower(text), chr(10)), 1) AS n, len(string_split(text, chr(10))) AS m FROM files),
sentences AS (SELECT doc_id, n, n IN (1, m) AS outermost, unnest(string_split_regex(line, '{SENTENCE_END}')) AS s FROM lines WHERE regexp_matches(line, '{CUE}')),
statements AS (SELECT doc_id, n, outermost, row_number() OVER () AS sid, list_distinct(regexp_extract_all(s, '{TERM}')) AS terms FROM sentences WHERE regexp_matches(s, '{CUE}')),
terms AS (SELECT doc_id, n, outermost, sid, unnest(terms) AS term FROM statements),
total AS (SELECT count(*) AS n FROM statements),
weights AS (SELECT v.term, round(ln((1.0 + (SELECT n FROM total)) / (1.0 + count(t.term))) + 1, 6) AS w FROM vocabulary v LEFT JOIN terms t USING (term) GROUP BY v.term),
lengths AS (SELECT sid, sqrt(sum(coalesce(w * w, power((SELECT round(ln(1.0 + n) + 1, 6) FROM total), 2)))) AS norm FROM terms LEFT JOIN weights USING (term) GROUP BY sid),
template_lengths AS (SELECT k, sqrt(sum(w * w)) AS norm FROM templates JOIN weights USING (term) GROUP BY k),
cosines AS (
  SELECT t.doc_id, t.n, t.outermost, t.sid, p.licence, round(sum(w.w * w.w) / (any_value(l.norm) * any_value(tl.norm)), 4) AS score
  FROM terms t JOIN templates p USING (term) JOIN weights w USING (term) JOIN lengths l USING (sid) JOIN template_lengths tl USING (k)
  GROUP BY t.doc_id, t.n, t.outermost, t.sid, p.k, p.licence),
best AS (SELECT doc_id, n, outermost, licence, score FROM cosines QUALIFY row_number() OVER (PARTITION BY sid ORDER BY score DESC, licence) = 1),
own AS (
  SELECT doc_id, arg_min(licence, (-score, licence, n)) AS own_licence, max(score) AS own_score, bool_or(outermost) AS opens
  FROM best WHERE score >= {MIN_SCORE} GROUP BY doc_id),
stated AS (SELECT dir AS above, arg_min(own_licence, path) AS stated FROM files JOIN own USING (doc_id) WHERE opens GROUP BY dir)
SELECT f.doc_id, f.path, o.own_licence, o.own_score, coalesce(o.own_licence, s.stated) AS licence, CASE WHEN o.own_licence IS NULL THEN s.above END AS found_in
FROM files f LEFT JOIN own o USING (doc_id) LEFT JOIN stated s ON f.dir = s.above
"""
