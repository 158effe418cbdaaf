from __future__ import annotations

import hashlib
import random
import re

import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items):
    words = lambda t: WORD.findall((t or "").translate(LOWER))
    windows = {}
    for item, text in items:
        w = words(text)
        n = min(13, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i : i + n]), set()).update([str(item)] if item is not None else [])
    out = []
    for doc, text in rows:
        w, hit, found = words(text), set(), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                own = windows.get(tuple(w[i : i + n]))
                if own is not None:
                    hit.update(range(i, i + n))
                    found |= own
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((doc, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(6)
    words = [f"w{i}" for i in range(40)] + ["Éa", "日本", "x9"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.choice([1, 2, 5, 12, 13, 14, 30, 60]))) for i in range(60)]
    items += [(3, items[3][1]), (77, items[5][1].upper()), (None, text(20)), (90, None), (91, ""), (92, "...")]
    rows = []
    for i in range(150):
        parts = [text(rng.randint(0, 80))]
        if i % 2:
            own = WORD.findall(rng.choice(items)[1] or "")
            start = rng.randint(0, max(0, len(own) - 13))
            parts.insert(rng.randint(0, 1), rng.choice([", ", "\n"]).join(own[start : start + rng.randint(1, 40)]))
        rows.append((i, " ".join(parts)))
    return rows + rows[:5], items


@pytest.mark.parametrize("block", [decontaminate.BLOCK_BYTES, 700])
def test_equals_brute_force(spark, docs, edge_rows, cases, block):
    rows, items = cases
    rows = rows + [(1000 + (i or 0), t) for i, t in edge_rows]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs(rows), benchmark, block).drop("items").collect()
    assert sorted((tuple(r) for r in out), key=str) == brute(rows, items)


def test_rows_kept(spark, docs, cases):
    rows, items = cases
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    kept = decontaminate.decontaminated(docs(rows), benchmark)
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(x[0] for x in brute(rows, items) if not x[5])


def test_empty_tables(spark, docs, edge_rows):
    none = spark.createDataFrame([], "item_id long, text string")
    out = decontaminate.contamination(docs(edge_rows), none).collect()
    assert len(out) == len(edge_rows) and not any(r.contaminated for r in out)
    assert decontaminate.contamination(docs([]), none).count() == 0


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark, docs):
    """A clean and a contaminated row under one id, and both without an id."""
    from roleweave.llm.decontaminate import decontaminated

    item = " ".join(f"word{i}" for i in range(15))
    table = docs([(None, item), (None, "clean text"), (4, item), (4, "another clean text"), (5, None)])
    kept = decontaminated(table, spark.createDataFrame([("b1", item)], "item_id string, text string"))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [("4", "another clean text"), ("5", None), ("None", "clean text")]
    assert kept.columns == table.columns
