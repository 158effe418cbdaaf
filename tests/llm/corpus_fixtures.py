"""Fixtures of the corpus tests; imported by each of them."""

from __future__ import annotations

import pytest

# Columns that operators might use themselves.
CLASHING = ["class", "root", "token", "key", "label", "_dropped", "_row", "toxic_rejected", "gram", "words", "piece_id", "_k", "_own", "_number"]


@pytest.fixture(scope="session")
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, lang, source), with extra columns of clashing names."""
    from pyspark.sql import functions as F

    def build(rows):
        full = [(r + (None, None))[:4] if len(r) == 2 else r for r in rows]
        table = spark.createDataFrame(full, "doc_id long, text string, lang string, source string")
        return table.withColumn("n_chars", F.char_length("text")).withColumns({name: F.lit(name) for name in CLASHING})

    return build


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls, empty and blank texts, repeats, a very long word and a very long text."""
    sentence = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
    return [
        (1, None),
        (2, ""),
        (3, " \n\t "),
        (4, "one"),
        (5, "one two"),
        (6, sentence),
        (6, sentence),
        (7, sentence.upper()),
        (8, sentence + " phi"),
        (9, "x" * 300_000),
        (10, " ".join(f"w{i % 977}é" for i in range(40_000))),
        (None, sentence),
        (11, "Ünïcode ☃ \u2028 line\x0bfeed\x1c sep\x85 nbsp\xa0end"),
    ]
