from __future__ import annotations

import re

import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import licences

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [
    "CC BY cc  by, cc-by; ccby cc by",
    "This work is licensed under the GNU General Public License, version 3. General public\nlicense",
    "All rights reserved. all rights, reserved ALL é rights reserved",
    "Éall rights reserved all rights reserved\x00all rights reserved",
    "Released under the MIT License.",
    "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.",
    "mit of the license and released license under mit",
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided",
    "by cc",
    "general public license",
]


def base(text):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places = [(i, label) for phrase, label in licences.PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    starts = [i for i, _ in places]
    return len(w), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted({label for _, label in places}))


def test_base_and_edges(docs, edge_rows):
    rows = [(100 + i, t) for i, t in enumerate(TEXTS)] + edge_rows + [(101, TEXTS[1]), (101, "other text, same id")]
    out = licences.licences(docs(rows)).collect()
    found = sorted((tuple(r)[:6] for r in out), key=str)
    assert found == sorted(((i, *base(t)) for i, t in rows), key=str)
    for r in out:
        own, every = set(filter(None, r.base_labels.split(","))), set(filter(None, r.labels.split(",")))
        assert own <= every and r.labels == ",".join(sorted(every)) and 0 <= r.score <= 1
    assert licences.licences(docs([])).count() == 0


@pytest.mark.parametrize(
    "text, label",
    [(TEXTS[1], "gpl-3.0"), (TEXTS[4], "mit"), (TEXTS[5], "apache-2.0"), (TEXTS[6], "cc-by-nc"), (TEXTS[8], "bsd")],
)
def test_templates(docs, text, label):
    rows = [(1, text), (2, "nothing to see here"), (3, "some words before. " + text + " And words behind."), (4, TEXTS[7])]
    out = {r.doc_id: r for r in licences.licences(docs(rows)).collect()}
    assert label in out[1].labels.split(",") and label in out[3].labels.split(",")
    assert out[1].score > 0 and out[2].labels == "" and out[2].score == 0
    assert out[4].labels == ""


def test_no_python_in_the_plan(spark):
    from conftest import SMALL, plan_of

    documents = spark.read.parquet(f"{SMALL}/documents.parquet")
    for table in (licences.base_rows(licences.prepared(documents)), licences.looked_up(licences.prepared(documents))):
        assert not any(word in plan_of(table) for word in ("Python", "Arrow", "Pandas"))


def test_a_file_with_all_notices_keeps_all_labels(docs):
    notices = [text for text, _ in licences.TEMPLATES.values()]
    some = [licences.TEMPLATES[label][0] for label in ("mit", "cc-by-nc", "gpl-3.0")]
    rows = [(1, ". ".join(notices)), (2, "\n".join(some)), (3, "nothing to see here"), *((10 + i, t) for i, t in enumerate(notices[:4]))]
    out = {r.doc_id: set(r.labels.split(",")) for r in licences.licences(docs(rows)).collect()}
    assert set(licences.TEMPLATES) <= out[1] and {"mit", "cc-by-nc", "gpl-3.0"} <= out[2] and out[3] == {""}
