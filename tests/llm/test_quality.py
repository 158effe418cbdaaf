from __future__ import annotations

import re
from collections import Counter

import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import quality


def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    grams = [tuple(w[i : i + 8]) for i in range(len(w) - 7)]
    times = Counter(grams)
    hit = {p for i, g in enumerate(grams) if times[g] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


TEXTS = [
    "a b c d e f g h a b c d e f g h",
    "x " * 40,
    "line one\nline two\nline one\n\n\n \nline one\r\nline one\r",
    "# | <a> $5 & 100% * é☃ # naïve",
    "\n",
    "same words again and again but never eight in a row",
]


def test_measures(docs, edge_rows):
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + edge_rows
    out = quality.quality(docs(rows)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept").collect()
    expected = []
    for doc, text in rows:
        m = measures(text)
        expected.append((doc, *m, m[0] < 20 or 100 * m[4] > 30 * m[0]))
    assert sorted((tuple(r)[:7] for r in out), key=str) == sorted(expected, key=str)
    assert not any(r.kept and r.base_failed for r in out)
    assert quality.quality(docs([])).count() == 0


def test_fences_by_group(docs):
    """A text that is odd in its own group goes; the same text among its like stays."""
    plain = " ".join(f"word{i}" for i in range(60))
    marked = " ".join(f"a{i} | # $ % & b{i} *" for i in range(60))
    rows = [(i, plain + f" end{i}", "en", "a") for i in range(200)] + [(i, marked + f" end{i}", "en", "b") for i in range(1000, 1200)]
    rows += [(5000, marked, "en", "a"), (5001, plain, None, None)]
    kept = {r.doc_id: r.kept for r in quality.quality(docs(rows)).collect()}
    assert [i for i, k in kept.items() if not k] == [5000]


def text_of(lengths):
    """Words of these lengths, none in a repeated window."""
    return " ".join((f"{i}" + "x" * n)[:n] for i, n in enumerate(lengths, start=10))


def test_fences_follow_the_group(docs):
    """The same word lengths are odd where they hardly vary and usual where they vary much."""
    narrow = [(i, text_of([5, 6] * 20 + [4 + i % 5]), "en", "narrow") for i in range(100)]
    wide = [(1000 + i, text_of([4 + i % 9] * 41), "en", "wide") for i in range(100)]
    rows = narrow + wide + [(5000, text_of([12] * 40), "en", "narrow"), (5001, text_of([12] * 40), "en", "wide")]
    kept = {r.doc_id: r.kept for r in quality.quality(docs(rows)).collect()}
    assert [i for i, k in kept.items() if not k] == [5000]


def test_marked_junk_goes(docs):
    """Texts full of marks go although they are a tenth of their group; tables with separators stay."""
    plain = [(i, text_of([4 + i % 4, 6, 4] * 15), "en", "a") for i in range(180)]
    junk = [(1000 + i, " ".join(f"{w}$$$" for w in text_of([5, 6, 4] * 15).split()), "en", "a") for i in range(20)]
    tables = [(2000 + i, text_of([5, 6, 4] * 15).replace(" ", " | "), "en", "a") for i in range(3)]
    kept = {r.doc_id: r.kept for r in quality.quality(docs(plain + junk + tables)).collect()}
    assert {i for i, k in kept.items() if not k} == {i for i, *_ in junk}


@pytest.mark.parametrize("values", [[0], [1, 2, 3], list(range(500)), [7] * 50 + [1_000_000]])
def test_sketch_quartiles_are_close(spark, values):
    from pyspark.sql import functions as F

    table = spark.createDataFrame([(v,) for v in values], "v long").withColumns({"lang": F.lit("x"), "source": F.lit(None).cast("string")})
    for name in quality.HIGH:
        table = table.withColumn(name, F.col("v"))
    # Sketches of parts merge by adding.
    parts = [quality.sketches(table.where(F.col("v") % 2 == k)) for k in (0, 1)]
    merged = parts[0].union(parts[1]).groupBy("lang", "source", "measure", "floor").agg(F.sum("n").alias("n"))
    assert sorted(map(str, merged.collect())) == sorted(map(str, quality.sketches(table).collect()))
    row = quality.fences(merged).first()
    ordered = sorted(values)
    q1, q3 = (ordered[max(0, -(-len(ordered) * k // 4) - 1)] for k in (1, 3))
    spread = max(row.high_word_length_pc - row.low_word_length_pc, 0)
    low, high = q1 - quality.SPREADS * max(q3 - q1, 25), q3 + quality.SPREADS * max(q3 - q1, 25)
    assert spread == pytest.approx(high - low, rel=0.1) and row.high_word_length_pc == pytest.approx(high, rel=0.1)
