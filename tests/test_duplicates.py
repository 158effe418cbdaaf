from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from roleweave.operators import duplicates

SCHEMA = "id long, source string, company string, title string, location string"


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def words_of(text):
    return re.sub(r"[\W_]+", " ", (text or "").lower()).strip()


def brute(rows, edits=2):
    keyed = [(i, s or "", words_of(c), words_of(t), words_of(p)) for i, s, c, t, p in rows]
    root = {r[0]: r[0] for r in keyed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keyed):
        for b in keyed[:i]:
            places = a[4] == b[4] or "" in (a[4], b[4])
            if a[1] != b[1] and a[2] == b[2] != "" and a[3] and b[3] and places and edit_distance(a[3], b[3]) <= edits:
                x, y = sorted((find(a[0]), find(b[0])))
                root[y] = x
    groups = {}
    for i, source, *_ in keyed:
        groups.setdefault(find(i), []).append((source.lower().startswith("jobspy"), i))
    return {i: (g, i == min(members)[1]) for g, members in groups.items() for _, i in members}


def found(table, **sizes):
    rows = duplicates.cross_source_groups(table, **sizes).collect()
    out = {r.id: (r.group_id, r.survives) for r in rows}
    assert len(out) == len(rows)
    return out


def random_rows(seed, n):
    rng = random.Random(seed)
    titles = ["Data Engineer", "Senior Data Engineer, Genomics", "ab", "a", "NGS", "Bioinformatics Scientist II"]

    def changed(title):
        letters = list(title)
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(letters))
            letters[at : at + rng.randint(0, 1)] = rng.choice(["", "x", "é", " ", "z"])
        return "".join(letters)

    return [
        (i, rng.choice(["greenhouse", "lever", "jobspy:linkedin", "jobspy:indeed", None]), rng.choice(["Acme", "ACME!", "Other", None]),
         changed(rng.choice(titles)) if rng.random() > 0.03 else None, rng.choice(["", None, "Boston, MA", "boston ma", "Remote"]))
        for i in range(n)
    ]


@pytest.mark.parametrize("seed, edits", [(1, 2), (2, 2), (3, 1), (4, 3)])
def test_equals_brute_force(spark, seed, edits):
    rows = random_rows(seed, 140)
    assert found(spark.createDataFrame(rows, SCHEMA), edits=edits) == brute(rows, edits)


def test_every_near_pair_shares_a_key(spark):
    """Titles of all small lengths over two letters, at distances up to the bound."""
    titles = sorted({format(n, f"0{k}b")[:k] for k in range(1, 6) for n in range(2**k)})
    rows = [(i, "c", t) for i, t in enumerate(titles)]
    pairs = {tuple(sorted((r.a, r.b))) for r in duplicates.similar_titles(spark.createDataFrame(rows, "title_id long, company string, title string")).collect()}
    assert pairs == {(i, j) for i, _, a in rows for j, _, b in rows if i < j and edit_distance(a, b) <= 2}


def test_a_hot_block_is_dealt_out(spark):
    """Thousands of titles share a segment, and a third of all postings one title: groups as without salts, and no quadratic output."""
    rows = [(i, f"s{i % 2}", "c", f"common beginning of a title {i * 7919:08d} and its end", "x") for i in range(600)]
    rows += [(10_000 + i, f"s{i % 3}", "c", "the one title", f"place {i}" if i % 2 else "") for i in range(400)]
    table = spark.createDataFrame(rows, SCHEMA)
    out = found(table, block=50)
    assert out == found(table, block=10**6)
    assert len({g for i, (g, _) in out.items() if i >= 10_000}) == 1
    assert out == brute(rows)


def test_same_source_postings_stay_apart(spark):
    rows = [(1, "lever", "A", "Lead", "x"), (2, "lever", "A", "Lead", "x"), (3, "lever", "A", "Leads", "x")]
    assert found(spark.createDataFrame(rows, SCHEMA)) == {1: (1, True), 2: (2, True), 3: (3, True)}
    rows.append((9, "jobspy:indeed", "a", "lead", None))
    assert found(spark.createDataFrame(rows, SCHEMA)) == {1: (1, True), 2: (1, False), 3: (1, False), 9: (1, False)}


def test_empty(spark):
    assert duplicates.cross_source_groups(spark.createDataFrame([], SCHEMA)).count() == 0


def test_long_chains_are_one_group(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)], "a long, b long")
    assert duplicates.connected(edges).select("root").distinct().collect() == [(0,)]
