"""Operator 9, license scans: a positional index of rare licence words.

DataFrame and SQL functions only. Base phrases are found as places in the word array of each whole text. For the
template labels, words that few templates share are looked up in every document (explode, then filter, without a
shuffle); document frequencies over the whole corpus give their IDF; the positions of all of a file's licence words are
joined with the templates' postings, so every template of which a file has rare words is judged. Words that agree on one relative position (document place
minus template place) support a template; it is labelled if enough of them agree and its mandatory phrases stand in the
text. The score is the IDF weight that agrees over that of all words looked up of the best template.

Null text has no words: no places, empty labels, score 0. Rows are keyed by doc_id and a hash of the text, so repeated
rows get the same result each and texts that share an id stay apart. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.llm.arrays import ascii_lower
from roleweave.session import stage

# Base phrases and their labels.
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# Licence notices as words, and the phrases without which a file doesn't carry the licence.
TEMPLATES = {
    "apache-2.0": ("licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license", ("apache license",)),
    "mit": ("released under the mit license permission is hereby granted free of charge to any person obtaining a copy of this software", ("mit license",)),
    "gpl-3.0": ("this work is licensed under the gnu general public license version 3", ("gnu general public license", "version 3")),
    "lgpl": ("licensed under the gnu lesser general public license version 2 1 or later", ("lesser general public license",)),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", ("redistribution and use",)),
    "mpl-2.0": ("this source code form is subject to the terms of the mozilla public license v 2 0", ("mozilla public license",)),
    "cc-by-nc": ("licensed under cc by nc 4 0 attribution noncommercial international", ("cc by nc",)),
    "cc-by-sa": ("licensed under cc by sa 4 0 attribution sharealike international", ("cc by sa",)),
    "cc0": ("cc0 1 0 universal no copyright public domain dedication", ("cc0",)),
    "proprietary": ("copyright all rights reserved no part may be reproduced without permission", ("all rights reserved", "copyright")),
}
# A word of more templates than this is no rare word.
MOST_TEMPLATES = 3
# Common words that are never looked up, however few templates hold them.
COMMON = frozenset("a and any are be by code conditions following form free in is later made may no not of or part person provided source that the this to use v with without work you 0 1 2 3 4".split())
# Words that have to agree on a relative position, or all that the template has.
LEAST_AGREEING = 2


def rare_words() -> list[str]:
    """Words that at most MOST_TEMPLATES templates hold and that aren't common, sorted."""
    held = Counter(w for text, _ in TEMPLATES.values() for w in set(text.split()))
    return sorted(w for w, n in held.items() if n <= MOST_TEMPLATES and w not in COMMON)


def spaced(text: Column) -> Column:
    """The words of a text, lower-cased, each between single blanks; " " without words."""
    words = F.trim(F.regexp_replace(ascii_lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", " "))
    return F.when(words == "", F.lit(" ")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))


def _places(phrase: str) -> Column:
    """Starts of a phrase in the column `words`, searched only in texts that hold it (`spaced`)."""
    own = phrase.split()
    # Sequence's end is kept at 0 or more, as both branches may be evaluated.
    starts = F.sequence(F.lit(0), F.greatest(F.size("words") - len(own), F.lit(0)))
    found = F.filter(starts, lambda i: _all(F.get("words", i + k) == w for k, w in enumerate(own)))
    return F.when(F.contains("spaced", F.lit(f" {phrase} ")), found).otherwise(F.array().cast("array<int>"))


def _all(conditions) -> Column:
    result = F.lit(True)
    for condition in conditions:
        result = result & condition
    return result


def prepared(docs: DataFrame) -> DataFrame:
    """doc_id, key (hash of the text), spaced and words of each row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("key"), spaced(F.col("text")).alias("spaced"))
    trimmed = F.trim("spaced")
    return rows.withColumn("words", F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, " ")))


def base_rows(rows: DataFrame) -> DataFrame:
    """doc_id, key, n_words, places of the base phrases, base labels, and labels whose mandatory phrases are there."""
    places = {f"_p{i}": _places(phrase) for i, (phrase, _) in enumerate(PHRASES)}
    mandatory = [F.when(_all(F.contains("spaced", F.lit(f" {p} ")) for p in phrases), F.lit(label)) for label, (_, phrases) in TEMPLATES.items()]
    labels = [F.when(F.size(f"_p{i}") > 0, F.lit(label)) for i, (_, label) in enumerate(PHRASES)]
    found = rows.select("doc_id", "key", F.size("words").cast("long").alias("n_words"), F.array_compact(F.array(*mandatory)).alias("allowed"), *[c.alias(n) for n, c in places.items()])
    every = F.concat(*places)
    return found.select(
        "doc_id",
        "key",
        "n_words",
        "allowed",
        F.size(every).cast("long").alias("n_base"),
        F.array_min(every).cast("long").alias("first_word"),
        F.array_max(every).cast("long").alias("last_word"),
        F.array_compact(F.array(*labels)).alias("base"),
    )


def looked_up(rows: DataFrame) -> DataFrame:
    """doc_id, key, word and its positions for every rare licence word of every row."""
    words = rows.select("doc_id", "key", F.posexplode("words").alias("pos", "word"))
    rare = words.where(F.col("word").isin(rare_words())).distinct()
    return rare.groupBy("doc_id", "key", "word").agg(F.sort_array(F.collect_list("pos")).alias("positions"))


def template_matches(hits: DataFrame, n_documents: int) -> DataFrame:
    """doc_id, key, label, agreeing words and score of each template supported at its best relative position."""
    spark = hits.sparkSession
    weight = F.log((F.lit(float(n_documents)) + 1) / (F.col("df") + 1)) + 1
    idf = hits.groupBy("word").agg(F.count("*").alias("df")).select("word", weight.alias("idf"))
    weighted = hits.join(idf, "word")
    rare = set(rare_words())
    postings = spark.createDataFrame(
        [(w, label, i) for label, (text, _) in TEMPLATES.items() for i, w in enumerate(text.split()) if w in rare], "word string, label string, at int"
    )
    # At most one count for each word at a relative position; the fewest words that may agree is what the template has.
    aligned = (
        weighted.select("doc_id", "key", "word", "idf", F.explode("positions").alias("pos"))
        .join(postings, "word")
        .groupBy("doc_id", "key", "label", (F.col("pos") - F.col("at")).alias("offset"))
        .agg(F.count("*").alias("agreeing"), F.sum("idf").alias("weight"))
        .groupBy("doc_id", "key", "label")
        .agg(F.max(F.struct("agreeing", "weight")).alias("best"))
    )
    total = weighted.join(postings.select("word", "label").distinct(), "word").groupBy("doc_id", "key", "label").agg(F.sum("idf").alias("total"))
    least = F.create_map(*[x for label, (text, _) in TEMPLATES.items() for x in (F.lit(label), F.lit(min(LEAST_AGREEING, len(set(text.split()) & rare))))])
    return (
        aligned.join(total, ["doc_id", "key", "label"])
        .where(F.col("best.agreeing") >= F.element_at(least, F.col("label")))
        .select("doc_id", "key", "label", F.least(F.col("best.weight") / F.col("total"), F.lit(1.0)).alias("score"))
    )


def licences(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels and score for every row of `docs`."""
    rows = prepared(docs)
    base = stage(base_rows(rows), "licence_base")
    hits = stage(looked_up(rows), "licence_words")
    matched = template_matches(hits, base.count()).withColumnsRenamed({"doc_id": "_doc_id", "key": "_key"})
    allowed = base.select("doc_id", "key", F.explode("allowed").alias("_label")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("key") == F.col("_key"))
    verified = (
        matched.join(allowed, same & (F.col("label") == F.col("_label")))
        .groupBy("_doc_id", "_key")
        .agg(F.collect_set("label").alias("own"), F.max("score").alias("score"))
    )
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    own = F.coalesce("own", F.array().cast("array<string>"))
    return base.join(verified, same, "left").select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        joined(F.col("base")).alias("base_labels"),
        joined(F.concat("base", own)).alias("labels"),
        F.coalesce("score", F.when(F.size("base") > 0, 1.0).otherwise(0.0)).alias("score"),
    )
