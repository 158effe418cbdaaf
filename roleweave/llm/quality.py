"""Operator 7, quality rules: fixed base rules, then fences per language and source from mergeable quantile sketches.

Each document becomes one narrow row of integer measures (one Arrow pass over whole texts). A sketch is a histogram
with bins of bounded relative width: its bins are sums, so partial sketches merge by adding, in any order, with the
same result. At most a few hundred bins stand for a measure and group, however many documents it has; a hot source is
summed before the shuffle. The fences (upper quartile plus a multiple of the spread, and likewise below) come from the
bins and are joined back on language and source.

Null text has no words and fails the base rules; null language or source is a group of its own. Repeated rows count
and are returned as often as they come. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roleweave.llm import arrays
from roleweave.session import stage

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
REPEAT_WINDOW = 8
# Sub-bins of each power of two: a bin is at most 1/32 of its lower bound wide.
SUB_BITS = 5
# Measures with a fence above, and with one below.
HIGH = ("symbols_pm", "dup_lines_pm", "repeat_pm", "word_length_pc")
LOW = ("word_length_pc",)
# Quartile distances beyond the quartile, and the distance taken where a group's own is less, as in groups whose values are tied:
# per mille of characters, lines and words, and hundredths of a character.
SPREADS = 4
LEAST_SPREAD = {"symbols_pm": 50, "dup_lines_pm": 75, "repeat_pm": 50, "word_length_pc": 25}

_SYMBOLS = arrays.byte_class("#*$%&|<>")


def _measures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hasher = arrays.Hasher()
    for batch in arrays.slices(batches, "text"):
        texts = arrays.texts_of(batch.column("text"))
        inside = arrays.NOT_SPACE[texts.data]
        spans = arrays.runs(texts, inside)
        word_chars = texts.per_document(inside & ((texts.data & 0xC0) != 0x80))
        lines = arrays.lines(texts)
        upto = np.concatenate(([0], np.cumsum(inside)))
        with_word = upto[lines.ends] > upto[lines.starts]
        line_doc = lines.document()[with_word]
        line_hash = hasher.spans(texts.data, lines.starts[with_word], lines.ends[with_word])
        n_lines = np.bincount(line_doc, minlength=len(texts))
        distinct = np.bincount(line_doc[_firsts(line_hash, line_doc)], minlength=len(texts))
        names = batch.schema.names
        yield pa.RecordBatch.from_arrays(
            [batch.column(name) for name in names if name != "text"]
            + [
                pa.array(x, pa.int64())
                for x in (
                    spans.counts(),
                    word_chars,
                    texts.per_document(_SYMBOLS[texts.data]),
                    n_lines - distinct,
                    n_lines,
                    repeated_words(hasher.spans(texts.data, spans.starts, spans.ends), spans),
                )
            ],
            [name for name in names if name != "text"]
            + ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_lines", "n_repeat_words"],
        )


def _firsts(hashes: np.ndarray, document: np.ndarray) -> np.ndarray:
    """Indices of one row of each distinct (hash, document)."""
    return np.unique(arrays.mixed(hashes + arrays.mixed(document.astype(np.uint64) + np.uint64(1))), return_index=True)[1]


def repeated_words(hashes: np.ndarray, spans: arrays.Spans) -> np.ndarray:
    """Words of each document in windows found twice or more in it."""
    document = spans.document()
    grams = arrays.grams(hashes, REPEAT_WINDOW)
    places = np.flatnonzero(arrays.whole_grams(spans, REPEAT_WINDOW))
    key = arrays.mixed(grams[places] + arrays.mixed(document[places].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(key), dtype=bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    hit = arrays.covered(len(hashes), places[twice], REPEAT_WINDOW)
    return np.bincount(document[hit], minlength=len(spans.first) - 1)


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the integer measures of each document's whole text."""
    schema = (
        "doc_id long, lang string, source string, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
        "n_lines long, n_repeat_words long"
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "lang", "source", "text").mapInArrow(_measures, schema)
    share = lambda part, whole, scale: F.expr(f"{scale} * {part} div greatest({whole}, 1)")
    return rows.withColumns(
        {
            "symbols_pm": share("n_symbols", "word_chars", 1000),
            "dup_lines_pm": share("n_dup_lines", "n_lines", 1000),
            "repeat_pm": share("n_repeat_words", "n_words", 1000),
            "word_length_pc": share("word_chars", "n_words", 100),
            "base_failed": F.expr(f"n_words < {MIN_WORDS} or 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
        }
    )


def bin_floor(value: Column | str) -> Column:
    """Lower bound of the sketch bin of a value that isn't negative: its SUB_BITS + 1 leading bits."""
    value = F.col(value) if isinstance(value, str) else value
    low_bits = F.greatest(F.length(F.bin(value)) - F.lit(SUB_BITS + 1), F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, low_bits), low_bits)


def sketches(rows: DataFrame, measure_names: tuple[str, ...] = HIGH) -> DataFrame:
    """Mergeable sketch rows: lang, source, measure, floor, n. Union and sum sketches of parts to merge them."""
    long = rows.select("lang", "source", F.explode(F.create_map(*[x for m in measure_names for x in (F.lit(m), F.col(m))])).alias("measure", "value"))
    return long.groupBy("lang", "source", "measure", bin_floor("value").alias("floor")).agg(F.count("*").alias("n"))


def fences(sketch: DataFrame, spreads: int = SPREADS) -> DataFrame:
    """Per language and source one row with low_* and high_* for each measure, from its quartiles.

    A quartile is the floor of the first bin at which the running count reaches that share of the total.
    """
    group = Window.partitionBy("lang", "source", "measure")
    upto = F.sum("n").over(group.orderBy("floor").rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("n").over(group)
    quartiles = (
        sketch.withColumns({"upto": upto, "total": total})
        .groupBy("lang", "source", "measure")
        .agg(
            F.min(F.when(F.col("upto") * 4 >= F.col("total"), F.col("floor"))).alias("q1"),
            F.min(F.when(F.col("upto") * 4 >= F.col("total") * 3, F.col("floor"))).alias("q3"),
        )
    )
    pick = lambda name, value: F.max(F.when(F.col("measure") == name, value))
    room = lambda name: F.greatest(F.col("q3") - F.col("q1"), F.lit(LEAST_SPREAD[name])) * spreads
    return quartiles.groupBy("lang", "source").agg(
        *[pick(m, F.col("q3") + room(m)).alias(f"high_{m}") for m in HIGH],
        *[pick(m, F.col("q1") - room(m)).alias(f"low_{m}") for m in LOW],
    )


def quality(docs: DataFrame) -> DataFrame:
    """Measures, base_failed and kept (neither base rule failed nor any fence crossed) for every row of `docs`.

    The sketches describe the documents that pass the base rules, so that junk doesn't widen the fences.
    """
    rows = stage(measures(docs), "quality")
    limits = fences(sketches(rows.where(~F.col("base_failed")))).withColumnsRenamed({"lang": "_lang", "source": "_source"})
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    over = [F.col(m) > F.col(f"high_{m}") for m in HIGH] + [F.col(m) < F.col(f"low_{m}") for m in LOW]
    crossed = F.coalesce(F.greatest(*[F.coalesce(c, F.lit(False)) for c in over]), F.lit(False))
    return joined.withColumn("kept", ~F.col("base_failed") & ~crossed).drop("_lang", "_source")
