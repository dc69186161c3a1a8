"""License scans: MinHash bands over overlapping windows retrieve templates, shingle containment verifies.

Words are alphanumeric runs with A-Z lower-cased, shingles five words. A template of s shingles is
looked for in windows of 2s' shingles that start every s', s' being s rounded up to a power of two,
so that a full copy lies wholly in a window and fills at least a quarter of it. A window and a
template have one MinHash value per band (the least value of the band's own hash of the shingles).
With ``BANDS`` bands of one row, a Jaccard similarity of J is retrieved with probability
1 - (1 - J) ** BANDS: at the least J of a match, 0.8 / 4, with 64 bands that is more than 0.999999.
A retrieved template matches where the window holds at least 80 % of its distinct shingles.

A window's least value can only equal a template's if the window holds that very shingle. Documents'
shingles are therefore compared with those of the templates first, in place and without a shuffle
when a count proves the templates few (else by a join), and windows are built around what matches;
the others could retrieve nothing.

Defined cases: null and empty texts and texts of fewer than five words match nothing; a template of
fewer than five words has no shingle and is never found; equal template rows count once, one id with
several texts matches by any of them; rows equal in id and text are one document; empty tables give
no matches or no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidegauge.llm.common import alnum_words, ascii_lower, broadcast_if, is_small, table, text_hash
from tidegauge.session import materialize

SHINGLE = 5
BANDS = 64
MIN_CONTAINMENT = 0.8
#: Template shingles up to which documents are searched in place; beyond, places join by shuffle.
LITERAL_SHINGLES = 20_000

#: Notices of public licenses (fixed values); any table of template_id, text can take their place.
TEMPLATES = [
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
                     "that the following conditions are met"),
    ("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("mit", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files, to deal in the Software without restriction"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
]


def _least(shingles: Column, band: int) -> Column:
    """The least value of the band's own hash over the shingles."""
    return F.array_min(F.transform(shingles, lambda h: F.xxhash64(h, F.lit(band))))


def with_shingles(rows: DataFrame, words: str, name: str) -> DataFrame:
    """Hashes of the five words from each place on, A-Z lower-cased; empty for fewer words.

    ``words`` is lower-cased in whole by Spark and the hash of a word with other letters keeps them,
    so words are lower-cased one by one, in a column of their own.
    """
    size = F.size(words)
    starts = F.sequence(F.lit(0), size - SHINGLE)
    hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(F.col(words), i + k) for k in range(SHINGLE)]))
    return rows.withColumn(name, F.when(size >= SHINGLE, hashes).otherwise(F.array().cast("array<bigint>")))


def lower_words(text: Column) -> Column:
    """A-Z lower-cased words: lower() is right for ASCII words, the few others are translated."""
    return F.transform(alnum_words(text), lambda w: F.when(F.octet_length(w) == F.length(w), F.lower(w)).otherwise(ascii_lower(w)))


def template_shingles(templates: DataFrame) -> DataFrame:
    """``template_id, template, shingles, span``: distinct shingles and the window class of each template."""
    rows = templates.select(F.col("template_id").cast("string").alias("template_id"), lower_words(F.col("text")).alias("words"))
    rows = with_shingles(rows, "words", "all").where(F.size("all") > 0)
    rows = rows.select("template_id", F.array_distinct("all").alias("shingles"), F.size("all").alias("n"))
    span = F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n").cast("double")))).cast("int")
    return rows.select("template_id", F.xxhash64("shingles").alias("template"), "shingles", span.alias("span")).distinct()


def _starts(pos: Column, span: Column | int) -> Column:
    """A place lies in the window that starts at the multiple of the span before it, and in the one before that."""
    start = pos - pos % span
    return F.array(start, F.greatest(start - span, F.lit(0)))


def _inside(span: Column, start: Column) -> Column:
    return F.array_distinct(F.slice("shingles", start.cast("int") + 1, 2 * span))


def _windows_in_place(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """``id, hash, span, start, inside`` around the places that hold a template's shingle.

    The dictionary, proven small, is a literal in 256 parts by hash; arrays never leave their row.
    """
    listed = dictionary.collect()
    spans = sorted({row["span"] for row in listed})
    parts: list[list[Column]] = [[] for _ in range(256)]
    for shingle in sorted({row["shingle"] for row in listed}):
        parts[shingle % 256].append(F.lit(shingle))
    known = F.array(*[F.array(*part).cast("array<bigint>") for part in parts])
    part = lambda i: F.get(known, F.pmod(F.get("shingles", i), F.lit(256)).cast("int"))
    at = F.filter(F.sequence(F.lit(0), F.size("shingles") - 1), lambda i: F.array_contains(part(i), F.get("shingles", i)))
    # No filter on these arrays: the optimizer would write them, as expressions, into each other's lambdas.
    places = rows.withColumn("at", F.when(F.size("shingles") > 0, at))

    def held_by(span: int) -> Column:
        starts = F.array_distinct(F.flatten(F.transform("at", lambda i: _starts(i, F.lit(span)))))
        return F.transform(starts, lambda start: F.struct(F.lit(span).alias("span"), start.alias("start")))

    empty = F.array().cast("array<struct<span:int,start:int>>")
    held = places.withColumn("held", F.flatten(F.array(empty, *map(held_by, spans))))
    windows = F.transform("held", lambda w: F.struct(w["span"].alias("span"), w["start"].alias("start"), _inside(w["span"], w["start"]).alias("inside")))
    return held.select("id", "hash", F.explode_outer(windows).alias("w")).where("w IS NOT NULL").select("id", "hash", "w.span", "w.start", "w.inside").dropDuplicates(
        ["id", "hash", "span", "start"])


def _windows_by_join(rows: DataFrame, dictionary: DataFrame) -> DataFrame:
    """The same for a dictionary of any size: places join it by shuffle, and their windows the documents."""
    places = rows.select("id", "hash", F.posexplode_outer("shingles").alias("pos", "shingle")).join(dictionary, "shingle")
    held = places.select("id", "hash", "span", F.explode(_starts(F.col("pos"), F.col("span"))).alias("start")).distinct()
    held = materialize(held, "license-places")
    joined = rows.dropDuplicates(["id", "hash"]).alias("r").join(held.alias("h"), F.col("r.id").eqNullSafe(F.col("h.id")) & (F.col("r.hash") == F.col("h.hash")))
    return joined.select("r.id", "r.hash", "h.span", "h.start", _inside(F.col("h.span"), F.col("h.start")).alias("inside"))


def scan(docs: DataFrame, templates: DataFrame, containment: float = MIN_CONTAINMENT, bands: int = BANDS,
         id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Matches ``id, hash, template_id, first_word, n_words, containment`` and the keyed documents ``id, hash, n_words``."""
    keyed = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("hash", text_hash(F.col("text")))
    known = materialize(template_shingles(templates), "license-templates")
    rows = keyed.select("id", "hash", lower_words(F.col("text")).alias("words"))
    rows = with_shingles(rows, "words", "shingles").select("id", "hash", "shingles")
    dictionary = known.select("span", F.explode("shingles").alias("shingle")).distinct()
    small = is_small(dictionary, LITERAL_SHINGLES)
    windows = materialize(_windows_in_place(rows, dictionary) if small else _windows_by_join(rows, dictionary), "license-windows")
    # The bands: a row per window (or template) and band, joined on band, span and least value.
    signature = lambda column: F.posexplode(F.array(*[_least(F.col(column), k) for k in range(bands)])).alias("band", "least")
    ours = known.select("template_id", "template", "span", "shingles", signature("shingles"))
    theirs = windows.select("id", "hash", "span", "start", "inside", signature("inside"))
    retrieved = theirs.join(broadcast_if(ours, small), ["span", "band", "least"])
    share = F.size(F.array_intersect("inside", "shingles")) / F.size("shingles")
    checked = retrieved.withColumn("containment", share).where(F.col("containment") >= containment)
    found = checked.groupBy("id", "hash", "template_id", "start").agg(
        F.max("containment").alias("containment"), F.max(2 * F.col("span") + (SHINGLE - 1)).alias("n_words"))
    return found.select("id", "hash", "template_id", F.col("start").cast("long").alias("first_word"),
                        F.col("n_words").cast("long"), "containment"), keyed.select("id", "hash")


def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: how many templates it holds, their ids, and the best containment."""
    templates = spark.createDataFrame(TEMPLATES, "template_id string, text string")
    found, keyed = scan(table(spark, sf_dir, "documents").select("doc_id", "text"), templates)
    best = found.groupBy("id", "hash").agg(F.sort_array(F.collect_set("template_id")).alias("ids"), F.max("containment").alias("best"))
    joined = keyed.alias("d").join(best.alias("b"), F.col("d.id").eqNullSafe(F.col("b.id")) & (F.col("d.hash") == F.col("b.hash")), "left")
    ids = F.coalesce("ids", F.array().cast("array<string>"))
    return joined.select(F.col("d.id").alias("doc_id"), F.size(ids).cast("long").alias("n_licenses"),
                         F.array_join(ids, ",").alias("license_ids"), F.coalesce("best", F.lit(0.0)).alias("best_containment"))


def _values() -> str:
    return ", ".join("('{}', '{}')".format(name, text.replace("'", "''")) for name, text in TEMPLATES)


#: The same answer without MinHash: every window of every class, compared with every template of the class.
OP9_SQL = rf"""
WITH templates(template_id, text) AS (VALUES {_values()}),
template_words AS (
    SELECT template_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                          '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
    FROM templates),
template_shingles AS (
    SELECT template_id, pow(2, ceil(log2(len(words) - 4)))::INT AS span,
           list_distinct(list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))) AS shingles
    FROM template_words WHERE len(words) >= 5),
doc_words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS words
    FROM documents),
shingles AS (
    SELECT doc_id, i - 1 AS pos, array_to_string(words[i:i + 4], ' ') AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM doc_words WHERE len(words) >= 5)),
held AS (
    SELECT DISTINCT s.doc_id, t.template_id, t.span, s.pos, s.shingle, len(t.shingles) AS n
    FROM shingles s JOIN (SELECT *, unnest(shingles) AS one FROM template_shingles) t ON s.shingle = t.one),
windows AS (
    SELECT doc_id, template_id, n, shingle, unnest([pos // span * span, pos // span * span - span]) AS start FROM held),
contained AS (
    SELECT doc_id, template_id, start, count(DISTINCT shingle) / any_value(n) AS containment
    FROM windows WHERE start >= 0 GROUP BY doc_id, template_id, start),
best AS (
    SELECT doc_id, count(DISTINCT template_id) AS n_licenses, max(containment) AS best,
           string_agg(DISTINCT template_id, ',' ORDER BY template_id) AS ids
    FROM contained WHERE containment >= 0.8 GROUP BY doc_id)
SELECT doc_id, coalesce(n_licenses, 0)::BIGINT AS n_licenses, coalesce(ids, '') AS license_ids, coalesce(best, 0.0)::DOUBLE AS best_containment
FROM doc_words LEFT JOIN best USING (doc_id)
"""
