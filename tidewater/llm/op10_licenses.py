"""Licence scans by sparse TF-IDF cosine, with nearest-ancestor inheritance, in DataFrame functions only.

Every line of a file (its headers) and the file as a whole are units. A unit's sparse vector (term count times idf) is
joined by term to the templates' vectors; a unit's licence is the template of the largest cosine, if that reaches
``threshold``. Document frequencies are counted over all files and for every term, so a unit's norm and with it the
answer do not depend on how large the input is. Terms of a hundredth of all files or more are joined by broadcast (at
most a hundred times the words of a mean file), the rest by a shuffle. Units without any *anchor* term are left out before the join: a template's anchors are its
heaviest terms, as many as it takes that the others alone keep the cosine below the threshold (Cauchy-Schwarz), so this
loses nothing. The templates are the fixed list below, so their vectors are small whatever the input.

Files named like a licence file give their directory a licence (the one of most such files, then of the best score,
then the first by name). Every distinct directory takes the licence of its nearest ancestor or itself that has one, by
a join of its ancestor paths; a file without a licence of its own inherits it by a join on its directory.

Defined cases: null, empty and wordless texts have no licence of their own but inherit. Repeated rows get equal results.
A null path has the directory "" and inherits nothing. Equal scores go to the first licence by name. Extra columns are
ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidewater.llm.common import WorkTables, lower_ascii, own_columns, table

THRESHOLD = 0.6
#: A term that one in so many files holds is common: no task gets all units of such a term.
COMMON = 100

#: Short notices by which public licences are usually named, one or more to a licence.
TEMPLATES = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met."),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License."),
    ("LGPL-3.0", "Licensed under the GNU Lesser General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]
#: Fixed pattern: file names of licence files.
LICENSE_FILE = r"(?i)^(licen[cs]e|copying|notice|copyright)([._-].*)?$"
BETWEEN = "[^a-z0-9]+"


def terms_of(text: str) -> Counter[str]:
    return Counter(re.findall("[a-z0-9]+", text.lower()))


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(lower_ascii(text), BETWEEN), "")


def weigh(seen: dict[str, int], n_files: int, templates: list[tuple[str, str]]) -> list[tuple[int, str, float, float]]:
    """Template vectors (template, term, idf, weight at unit length)."""
    idf = {t: math.log((n_files + 1) / (seen.get(t, 0) + 1)) + 1 for _, text in templates for t in terms_of(text)}
    rows = []
    for k, (_, text) in enumerate(templates):
        vector = {t: n * idf[t] for t, n in terms_of(text).items()}
        norm = math.sqrt(sum(w * w for w in vector.values()))
        rows += [(k, t, idf[t], w / norm) for t, w in sorted(vector.items())]
    return rows


def anchors_of(rows: list[tuple[int, str, float, float]], threshold: float) -> list[str]:
    chosen: set[str] = set()
    for k in {r[0] for r in rows}:
        rest = 1.0
        for _, term, _, weight in sorted((r for r in rows if r[0] == k), key=lambda r: (-r[3], r[1])):
            if rest < threshold * threshold * 0.999:
                break
            chosen.add(term)
            rest -= weight * weight
    return sorted(chosen)


def own_licenses(files: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(key, license, score) of the files whose own text names a licence; ``files`` is (key, text)."""
    spark = files.sparkSession
    texts = files.select("key", F.coalesce("text", F.lit("")).alias("text"))
    # Of each term, the files that hold it; the empty term counts the files.
    held = texts.select(F.explode(F.concat(F.array(F.lit("")), F.array_distinct(words_of(F.col("text"))))).alias("term"))
    held = WorkTables(spark).put(held.groupBy("term").agg(F.count(F.lit(1)).alias("seen")), "seen", compression="zstd")
    asked = ["", *sorted({t for _, text in templates for t in terms_of(text)})]
    seen = {r["term"]: r["seen"] for r in held.filter(F.col("term").isin(asked)).collect()}
    n_files = seen.pop("", 0)
    vectors = weigh(seen, n_files, templates)
    anchors = F.array(*[F.lit(t) for t in anchors_of(vectors, threshold)])
    found = texts.withColumn("words", words_of(F.col("text"))).filter(F.arrays_overlap("words", anchors)).dropDuplicates(["key"])
    lines = F.transform(F.split("text", "\n"), words_of)
    units = found.select("key", F.posexplode(F.concat(F.array(F.col("words")), lines)).alias("unit", "words")).filter(F.arrays_overlap("words", anchors))
    counted = units.select("key", "unit", F.explode("words").alias("term")).groupBy("key", "unit", "term").agg(F.count(F.lit(1)).alias("n"))
    weights = held.filter("term <> ''").select("term", "seen", (F.log(F.lit(n_files + 1.0) / (F.col("seen") + 1)) + 1).alias("idf"))
    often = counted.join(F.broadcast(weights.filter(F.col("seen") * COMMON >= n_files).select("term", "idf")), "term", "left")
    rare = often.filter("idf IS NULL").drop("idf").join(weights.filter(F.col("seen") * COMMON < n_files).select("term", "idf"), "term")
    sparse = often.filter("idf IS NOT NULL").unionByName(rare).withColumn("w", F.col("n") * F.col("idf"))
    by_term = spark.createDataFrame([(t, k, w) for k, t, _, w in vectors], "term string, template int, weight double")
    lists = by_term.groupBy("term").agg(F.collect_list(F.struct("template", "weight")).alias("entries"))
    # One row per unit: its norm, and its products with every template that shares a term.
    sums = [F.sum(F.coalesce(F.expr(f"aggregate(filter(entries, e -> e.template = {k}), 0D, (s, e) -> s + e.weight)"), F.lit(0.0)) * F.col("w")).alias(f"dot{k}") for k in range(len(templates))]
    dots = sparse.join(F.broadcast(lists), "term", "left").groupBy("key", "unit").agg(F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"), *sums)
    scored = dots.select("key", F.inline(F.array(*[F.struct(F.round(F.col(f"dot{k}") / F.col("norm"), 6).alias("score"), F.lit(name).alias("license")) for k, (name, _) in enumerate(templates)])))
    best = scored.filter(F.col("score") >= threshold).groupBy("key").agg(F.min(F.struct((-F.col("score")).alias("minus"), "license")).alias("best"))
    return best.select("key", "best.license", (-F.col("best.minus")).alias("score"))


def inherited(directories: DataFrame, given: DataFrame) -> DataFrame:
    """(dir, from_dir, license): for each distinct directory the nearest of itself and its ancestors in ``given`` (dir, license)."""
    parts = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.array_join(F.slice(parts, 1, n), "/"))
    paths = directories.select("dir").distinct().select("dir", F.explode(above).alias("from_dir"))
    met = paths.join(given.select(F.col("dir").alias("from_dir"), "license"), "from_dir")
    nearest = met.groupBy("dir").agg(F.max(F.struct(F.length("from_dir").alias("depth"), "from_dir", "license")).alias("near"))
    return nearest.select("dir", "near.from_dir", "near.license")


def scan(files: DataFrame, threshold: float = THRESHOLD, templates: list[tuple[str, str]] = TEMPLATES) -> DataFrame:
    """(file_id, path, license, score, origin, from_dir) of each row of ``files`` (file_id, path, text).

    ``origin`` is "own", "inherited" or "none".
    """
    work = WorkTables(files.sparkSession)
    rows = own_columns(files, "file_id", "path", "text").withColumn("key", F.xxhash64("path", "text"))
    own = work.put(own_licenses(rows, threshold, templates), "own")
    parts = F.split(F.coalesce("path", F.lit("")), "/")
    places = rows.select("file_id", "path", "key", F.array_join(F.slice(parts, 1, F.size(parts) - 1), "/").alias("dir"), F.element_at(parts, -1).alias("name"))
    known = work.put(places.join(own, "key", "left"), "files")
    votes = known.filter(F.col("license").isNotNull() & F.col("name").rlike(LICENSE_FILE)).groupBy("dir", "license").agg(F.count(F.lit(1)).alias("files"), F.max("score").alias("score"))
    first = Window.partitionBy("dir").orderBy(F.desc("files"), F.desc("score"), "license")
    given = votes.withColumn("nth", F.row_number().over(first)).filter("nth = 1").select("dir", "license")
    near = inherited(known.filter("path IS NOT NULL"), given).withColumnRenamed("license", "near_license")
    out = known.join(near, "dir", "left")
    origin = F.when(F.col("license").isNotNull(), "own").when(F.col("near_license").isNotNull(), "inherited").otherwise("none")
    return out.select("file_id", "path", F.coalesce("license", "near_license").alias("license"), "score", origin.alias("origin"), F.when(F.col("license").isNull(), F.col("from_dir")).alias("from_dir"))


def document_files(docs: DataFrame) -> DataFrame:
    """``documents`` as a source tree: /source/language/block/<id>.txt, and texts of up to 400 characters as NOTICE
    files of the language's directory."""
    notice = F.concat_ws("/", F.lit(""), "source", "lang", F.concat(F.lit("NOTICE."), F.col("doc_id")))
    file = F.concat_ws("/", F.lit(""), "source", "lang", F.floor(F.col("doc_id") / 100), F.concat(F.col("doc_id"), F.lit(".txt")))
    path = F.when(F.length(F.coalesce("text", F.lit(""))) <= 400, notice).otherwise(file)
    return own_columns(docs, "doc_id", "text", "lang", "source").select(F.col("doc_id").alias("file_id"), path.alias("path"), "text")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(document_files(table(spark, sf_dir, "documents")))
    return found.select(F.col("file_id").alias("doc_id"), "path", "license", F.round("score", 4).alias("score"), "origin", "from_dir")


_VALUES = ", ".join(f"({k}, '{name}', '{text}')" for k, (name, text) in enumerate(TEMPLATES))
_SPLIT = "[x FOR x IN regexp_split_to_array(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+') IF x <> '']"

ORACLE = rf"""
WITH templates(template, license, text) AS (VALUES {_VALUES}
), template_terms AS (
  SELECT template, license, term, count(*) AS n
  FROM (SELECT template, license, unnest({_SPLIT.format('text')}) AS term FROM templates) GROUP BY ALL
), files AS (
  SELECT doc_id, coalesce(text, '') AS text,
         '/' || source || '/' || lang || '/' || CASE WHEN length(coalesce(text, '')) <= 400 THEN 'NOTICE.' || doc_id
           ELSE (doc_id // 100) || '/' || doc_id || '.txt' END AS path
  FROM documents
), held AS (
  SELECT term, count(DISTINCT doc_id) AS seen
  FROM (SELECT doc_id, unnest({_SPLIT.format('text')}) AS term FROM files) WHERE term IN (SELECT term FROM template_terms) GROUP BY term
), size AS (SELECT count(*) AS n FROM files
), idf AS (
  SELECT DISTINCT t.term, ln((size.n + 1) / (coalesce(h.seen, 0) + 1)) + 1 AS idf
  FROM template_terms t CROSS JOIN size LEFT JOIN held h ON h.term = t.term
), vectors AS (
  SELECT template, license, term, n * idf / sqrt(sum(n * idf * n * idf) OVER (PARTITION BY template)) AS weight
  FROM template_terms JOIN idf USING (term)
), units AS (
  SELECT doc_id, 0 AS unit, text FROM files
  UNION ALL
  SELECT doc_id, unnest(range(len(string_split(text, chr(10))))) + 1 AS unit, unnest(string_split(text, chr(10))) AS text FROM files
), unit_terms AS (
  SELECT doc_id, unit, term, count(*) AS n FROM (SELECT doc_id, unit, unnest({_SPLIT.format('text')}) AS term FROM units) GROUP BY ALL
), sparse AS (
  SELECT doc_id, unit, u.term, u.n * coalesce(idf, ln((size.n + 1) / 2) + 1) AS w
  FROM unit_terms u CROSS JOIN size LEFT JOIN idf USING (term)
), norms AS (SELECT doc_id, unit, sqrt(sum(w * w)) AS norm FROM sparse GROUP BY ALL
), scores AS (
  SELECT doc_id, license, round(sum(s.w * v.weight) / any_value(norm), 6) AS score
  FROM sparse s JOIN vectors v USING (term) JOIN norms USING (doc_id, unit) GROUP BY doc_id, unit, template, license
), own AS (
  SELECT doc_id, license, score FROM scores WHERE score >= {THRESHOLD}
  QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, license) = 1
), known AS (
  SELECT f.doc_id, f.path, regexp_replace(f.path, '/[^/]*$', '') AS dir, regexp_extract(f.path, '[^/]*$') AS name, o.license, o.score
  FROM files f LEFT JOIN own o USING (doc_id)
), given AS (
  SELECT dir, license FROM known WHERE license IS NOT NULL AND name LIKE 'NOTICE.%' GROUP BY dir, license
  QUALIFY row_number() OVER (PARTITION BY dir ORDER BY count(*) DESC, max(score) DESC, license) = 1
), near AS (
  SELECT d.dir, g.dir AS from_dir, g.license FROM (SELECT DISTINCT dir FROM known) d
  JOIN given g ON d.dir = g.dir OR starts_with(d.dir, g.dir || '/')
  QUALIFY row_number() OVER (PARTITION BY d.dir ORDER BY length(g.dir) DESC) = 1
)
SELECT k.doc_id, k.path, coalesce(k.license, n.license) AS license, round(k.score, 4) AS score,
       CASE WHEN k.license IS NOT NULL THEN 'own' WHEN n.license IS NOT NULL THEN 'inherited' ELSE 'none' END AS origin,
       CASE WHEN k.license IS NULL THEN n.from_dir END AS from_dir
FROM known k LEFT JOIN near n USING (dir)
"""
