"""Tokens, n-grams and document frequencies."""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Sequence
from string import punctuation

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.session import stage
from roleweave.vocabulary import STOP_WORDS

# The published Treebank rules for lower-case text, in order: what is set apart by blanks. Marks inside
# numbers (100,000 and 10:30) and signs that belong to a name (c++, 5+) stay with their word.
TREEBANK = (
    (r'(^|[\s(\[{<])"', "$1 `` "),  # an opening quotation mark is two grave accents
    (r"([:,])([^\d])", " $1 $2"),
    (r"([:,])$", " $1 "),
    (r"\.\.\.", " ... "),
    (r"([;@#$%&?!])", " $1 "),
    # A full stop ends a sentence behind a word that is longer than a letter, has no dot of its own and is no abbreviation.
    (r"(^|\s)(?![(\[{<]*{abbreviations}\.)([^\s.]{2,})\.([\])}>\"']*)(?=\s|$)", "$1$2 . $3"),
    (r"([\]\[(){}<>])", " $1 "),
    (r"--", " -- "),
    (r"''|\"", " '' "),  # any other quotation mark closes
    (r"([^' ])('s|'m|'d|') ", "$1 $2 "),
    (r"([^' ])('ll|'re|'ve|n't) ", "$1 $2 "),
    (r"\b(can)(not)\b", " $1 $2 "),
    (r"\b(gim|lem)(me)\b", " $1 $2 "),
    (r"\b(gon|wan)(na)\b", " $1 $2 "),
    (r"\b(got)(ta)\b", " $1 $2 "),
    (r" ('t)(is|was)\b", " $1 $2 "),
)


# Words that keep their full stop wherever they stand. `learnt_abbreviations` finds those of a corpus.
ABBREVIATIONS = (
    "approx", "assoc", "ave", "bldg", "co", "corp", "dept", "dr", "ed", "eq", "est", "etc", "fig", "gen", "gov", "inc", "jr", "ltd",
    "max", "min", "mr", "mrs", "ms", "no", "nos", "pp", "prof", "ref", "rep", "resp", "sr", "st", "univ", "viz", "vol", "vs",
)
# Least score of a learnt abbreviation, and the share of its occurrences that would end in a full stop.
LEAST_SCORE, ALWAYS = 0.3, 0.99


def learnt_abbreviations(docs: DataFrame, text: str) -> DataFrame:
    """(word, with_stop, without_stop, score) of the abbreviations of a corpus, by the statistics of its full stops.

    A word is scored by the likelihood that its full stop is part of it, against full stops falling behind words at
    random; shorter words and those with dots inside score higher, and those that also stand without the full stop lower,
    the more so the longer they are (Kiss and Strunk, 2006). Two counts per word are all that is shuffled.
    """
    parts = F.explode(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), r"(?U)\s+")).alias("part")
    bare = F.regexp_replace(F.regexp_replace("part", r"^[(\"'\[{<]+", ""), r"[)\"'\]}>,;:!?]+$", "")
    words = docs.select(parts).select(bare.alias("bare")).where("bare <> ''")
    stop = F.col("bare").endswith(".")
    counted = words.groupBy(F.when(stop, F.expr("left(bare, length(bare) - 1)")).otherwise(F.col("bare")).alias("word")).agg(
        F.count_if(stop).alias("with_stop"), F.count_if(~stop).alias("without_stop")
    )
    counts = stage(counted, "word_stops")
    total = counts.agg(F.sum(F.col("with_stop") + F.col("without_stop")).alias("n"), F.sum("with_stop").alias("stops")).first()
    if not total.n or total.stops in (0, total.n):
        return counts.select("word", "with_stop", "without_stop", F.lit(0.0).alias("score")).limit(0)
    share, k, rest = total.stops / total.n, F.col("with_stop"), F.col("without_stop")
    likelihood = 2.0 * (k * (math.log(ALWAYS) - math.log(share)) + rest * (math.log(1 - ALWAYS) - math.log(1 - share)))
    dots = F.length("word") - F.length(F.replace("word", F.lit("."), F.lit(""))) + 1
    letters = F.length("word") - dots + 1
    score = likelihood * F.exp(-letters) * dots * F.exp(-rest * F.log(letters.cast("double")))
    found = counts.where((k > 0) & F.col("word").rlike(r"\p{L}")).withColumn("score", score)
    return found.where(F.col("score") >= LEAST_SCORE)


# Parts of a piece of text without any of which a rule finds nothing, for each rule; the pairs of letters are those of run-together words.
NEEDED = (
    '"', ":,", ":,", ".", ";@#$%&?!", ".", "][(){}<>", "-", "'\"", "'\"", "'\"", ("nn",), ("mm",), ("nn",), ("tt",), "'",
)
# Pieces between blanks whose tokens a task remembers, their longest length, and tokens it holds as Python strings at once.
REMEMBERED, LONGEST, HELD = 200_000, 64, 1_000_000
# White space of Unicode, at which tokens are cut in the end.
ANY_SPACE = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+"


def _tokenizer(stop_words: Sequence[str], abbreviations: Sequence[str]) -> Callable[[pa.Array], pa.Array]:
    """Function from lower-case texts to their tokens.

    No rule looks beyond the blanks around a piece of text, except that the first piece has none before it. So the rules are
    applied to each different piece once. What the function needs travels with it.
    """
    kept = "(?:" + "|".join(re.escape(a) for a in sorted(abbreviations)) + ")" if abbreviations else "(?!)"
    rules = [
        (tuple(needed), re.compile(pattern.replace("{abbreviations}", kept), re.ASCII), re.sub(r"\$(\d)", r"\\\1", replacement))
        for needed, (pattern, replacement) in zip(NEEDED, TREEBANK, strict=True)
    ]
    doubled = tuple({part for needed in NEEDED if isinstance(needed, tuple) for part in needed})
    space, marks, dropped = re.compile(ANY_SPACE), punctuation, frozenset(stop_words)
    remembered, longest, held = REMEMBERED, LONGEST, HELD
    known: dict[str, tuple[str, ...]] = {}

    def apart(piece: str) -> tuple[str, ...]:
        word = piece.strip(" ")
        if word.isalnum():  # no marks and no other white space
            for part in doubled:
                if part in word:
                    break
            else:
                return () if word in dropped else (word,)
        for needed, pattern, replacement in rules:
            for part in needed:
                if part in piece:
                    piece = pattern.sub(replacement, piece)
                    break
        return tuple([t for t in space.split(piece) if t not in marks and t not in dropped])

    def run(texts: pa.Array) -> pa.Array:
        ends, flat, parts, size = [0], [], [], 0
        for text in texts:
            first, *pieces = (text.as_py() or "").split(" ")
            flat += apart(first + " ")
            for piece in pieces:
                found = known.get(piece)
                if found is None:
                    found = apart(f" {piece} ")
                    if len(piece) <= longest:
                        if len(known) >= remembered:
                            known.clear()
                        known[piece] = found
                flat += found
            ends.append(size + len(flat))
            if len(flat) >= held:
                parts.append(pa.array(flat, pa.string()))
                size, flat = size + len(flat), []
        values = pa.concat_arrays([*parts, pa.array(flat, pa.string())])
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values, mask=texts.is_null())

    return run


def tokens(text: Column, stop_words: Sequence[str] = STOP_WORDS, abbreviations: Sequence[str] = ABBREVIATIONS) -> Column:
    """Lower-case Treebank tokens without stop words and punctuation.

    A full stop is set apart where a sentence ends, and stays with an abbreviation. A token goes as punctuation when it is
    a piece of the punctuation string, so quotation marks (two characters each) and a double dash stay. Words end at ASCII
    letters, digits and underscores, as in the SQL twin.
    """
    # Declared to vary, because the optimizer would copy it into each filter on its result and run it again.
    return F.arrow_udf(_tokenizer(stop_words, abbreviations), "array<string>").asNondeterministic()(F.lower(text))


def ngrams(words: Column, top: int = 1) -> Column:
    """Tokens, followed by word pairs when `top` is 2."""
    if top == 1:
        return words
    pairs = F.zip_with(
        F.slice(words, F.lit(1), F.greatest(F.size(words) - 1, F.lit(0))),
        F.slice(words, F.lit(2), F.greatest(F.size(words) - 1, F.lit(0))),
        lambda a, b: F.concat_ws(" ", a, b),
    )
    return F.concat(words, pairs)


def document_frequency(docs: DataFrame, terms: str) -> DataFrame:
    """(term, df): in how many rows a term occurs. Counts are combined before the shuffle."""
    # Outer, because the optimizer would test a plain explode for emptiness first and tokenize twice.
    exploded = docs.select(F.explode_outer(F.array_distinct(terms)).alias("term")).filter("term is not null")
    return exploded.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def vocabulary(
    docs: DataFrame, terms: str, min_df: int = 1, max_df: float = 1.0, max_features: int | None = None
) -> DataFrame:
    """(term, df, idf): terms between the bounds, the most frequent `max_features` of them.

    idf is smoothed: ln((1 + rows) / (1 + df)) + 1. The cap is the feature; Spark keeps a bounded
    heap per task for it.
    """
    rows = docs.count()
    table = document_frequency(docs, terms).filter(
        (F.col("df") >= min_df) & (F.col("df") <= max_df * float(rows))
    )
    if max_features is not None:
        table = table.orderBy(F.desc("df"), "term").limit(max_features)
    return table.withColumn("idf", F.ln((1.0 + rows) / (1.0 + F.col("df"))) + 1.0)
