from __future__ import annotations

import random
import re

import numpy as np
import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import jaccard
from roleweave.llm.components import components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 3]) for i in range(max(1, len(w) - 2))) if w else frozenset()


def linked(a, b):
    common = len(a & b)
    return bool(common) and 100 * common >= 90 * (len(a) + len(b) - common)


def brute(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if linked(sets[i], sets[j]) or rows[i][0] == rows[j][0]:
                root[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((doc, len(sets[i]), least[find(i)]) for i, (doc, _) in enumerate(rows))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)]
    out, n = [], 0
    for _ in range(14):
        base = [rng.choice(words) for _ in range(rng.choice([4, 12, 40, 90, 200]))]
        for _ in range(rng.choice([1, 2, 4, 30])):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append((n := n + 1, rng.choice([" ", "\n"]).join(copy)))
            if rng.random() < 0.4:
                base = copy
    passage = " ".join(rng.choice(words) for _ in range(30))
    out += [(1000 + i, passage + " " + " ".join(rng.choice(words) for _ in range(rng.randint(0, 20)))) for i in range(60)]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("short, block", [(jaccard.SHORT_LIST, jaccard.BLOCK_SHINGLES), (3, 300)])
def test_equals_brute_force(docs, edge_rows, rows, monkeypatch, short, block):
    monkeypatch.setattr(jaccard, "SHORT_LIST", short)
    monkeypatch.setattr(jaccard, "BLOCK_SHINGLES", block)
    every = rows + [(5000 + i, t) for i, t in edge_rows if i is not None]
    out = jaccard.groups(docs(every)).collect()
    assert sorted(tuple(r) for r in out) == brute(every)


def test_one_of_each_group(docs, rows):
    kept = jaccard.one_of_each_group(docs(rows + [(None, "no id here at all")]))
    assert kept.columns == docs(rows).columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted({c for _, _, c in brute(rows)})
    assert kept.where("doc_id is null").count() == 1


def test_empty(docs):
    assert jaccard.groups(docs([])).count() == 0
    assert [tuple(r) for r in jaccard.groups(docs([(1, None), (2, "")])).orderBy("doc_id").collect()] == [(1, 0, 1), (2, 0, 2)]


def test_prefix_meets_every_link():
    rng = random.Random(9)
    for _ in range(300):
        a = {rng.randrange(10**6) for _ in range(rng.randint(8, 80))}
        b = set(a)
        for _ in range(rng.randint(0, 4)):
            b.add(rng.randrange(10**6)) if rng.random() < 0.5 else b.discard(rng.choice(sorted(b)))
        if linked(frozenset(a), frozenset(b)):
            prefix = lambda s: set(sorted(s)[: len(s) - -(-90 * len(s) // 100) + 1])
            assert prefix(a) & prefix(b)


def test_components(spark):
    rng = random.Random(10)
    edges = [(i, i + 1) for i in range(0, 60)] + [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(200)] + [(7, 7)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in range(400):
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert found == {x: r for x, r in root.items() if any(a != b and x in (a, b) for a, b in edges)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_forest_spans_blocks():
    sets = [np.arange(i, 100 + i, dtype=np.uint64) << np.uint64(50) for i in range(6)]
    links = jaccard.forest(np.arange(6), np.array([0, 0, 0, 1, 1, 1]), sets)
    assert all((a < 3) != (b < 3) for a, b in links)


def test_pipeline_stage_takes_five_words_and_eighty_percent(spark, docs):
    import corpus_pipeline

    words = [f"w{i}" for i in range(100)]
    changed = lambda *places: " ".join("x" if i in places else w for i, w in enumerate(words))
    other = " ".join(f"v{i}" for i in range(60))
    # Similarities of five words: 91 of 101 (0.90, 0.94 of three words), 86 of 106 (0.81, 0.88), 81 of 111 (0.73).
    rows = [(1, changed()), (2, changed(50)), (3, changed(30, 70)), (4, other), (4, other), (5, other), (None, other)]
    rows += [(6, changed(20, 50, 80).upper().replace("W", "u")), (None, "a b c d e f g"), (None, "a b c d e f g"), (7, " "), (7, " "), (None, None)]
    out = sorted((tuple(r) for r in corpus_pipeline.drop_near_duplicates(spark, docs(rows), "").select("doc_id", "text").collect()), key=str)
    assert out == sorted([rows[0], rows[3], rows[7], rows[8], rows[10], rows[11], rows[12]], key=str)


@pytest.mark.parametrize("words, percent", [(5, 80), (2, 60)])
def test_other_lengths_and_thresholds(docs, rows, words, percent):
    def shingled(text):
        w = text.split()
        return {tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))}

    sets = {i: shingled(t) for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and common and 100 * common >= percent * len(sets[a] | sets[b]) and root[a] != root[b]:
                low, high = sorted((root[a], root[b]))
                root = {i: low if r == high else r for i, r in root.items()}
    assert {r.doc_id: r.component_id for r in jaccard.groups(docs(rows), words, percent).collect()} == root


def test_repeated_rows_and_shared_ids_keep_every_link(docs, rows):
    """Many equal rows of one id, and different texts under one id, of which one is a copy of another document's."""
    base = rows[0][1] + " and more words so that it is long enough to be linked with others in any case"
    every = [(10, base), (7, base), (7, rows[5][1] + " x"), (20, rows[5][1] + " x")] + [(30, base + " tail")] * 300
    out = jaccard.groups(docs(every)).collect()
    assert sorted(tuple(r) for r in out) == brute(every)


def test_filter_lets_every_shared_shingle_through(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(jaccard, "CELLS_HELD", 50)
    rng = random.Random(2)
    lists = [[rng.getrandbits(64) - (1 << 63) for _ in range(20)] for _ in range(60)]
    shared = {x for own in lists[:30] for x in own[:3]}
    lists += [[x] for x in shared]
    bits = jaccard.met_filter(spark.createDataFrame([(x,) for x in lists], "prefix array<long>").repartition(5))
    cells = lambda values: np.array(sorted(values), dtype=np.int64).view(np.uint64) >> np.uint64(64 - jaccard.FILTER_BITS)
    on = lambda c: (bits[(c >> np.uint64(3)).astype(np.int64)] >> (c & np.uint64(7)).astype(np.uint8)) & 1 == 1
    assert on(cells(shared)).all()
    assert not on(cells({x for own in lists for x in own} - shared)).any()


def test_helper_columns_may_clash(docs):
    from pyspark.sql import functions as F

    names = ["_k", "_own", "_number", "_of", "_gone", "_copies", "_first", "_key", "_n", "_is_first", "component_id", "_text_key", "_own_id"]
    table = docs([(None, "a b c d e f g"), (2, "a b c d e f g"), (2, "a b c d e f g"), (3, None)]).withColumns({n: F.lit(n) for n in names})
    kept = jaccard.one_of_each_group(table, 5, 80)
    assert kept.columns == table.columns and sorted(r.doc_id for r in kept.collect()) == [2, 3]
    assert all(r[n] == n for r in kept.collect() for n in names)


def test_postings_of_one_class_go_at_any_size():
    """Exactly the lists of two or more stay, wherever batches end, and no filter can fill up."""
    import pyarrow as pa

    rng = random.Random(4)
    lists = np.array(sorted(rng.choice([rng.randrange(10**9), rng.randrange(40), 5, -7]) for _ in range(500)), dtype=np.int64)
    rows = pa.RecordBatch.from_arrays([pa.array(lists), pa.array(np.arange(500)), pa.array(np.arange(500) << 32 | 3)], ["list", "class", "place"])
    n = {x: int((lists == x).sum()) for x in lists}
    expected = [i for i, x in enumerate(lists) if n[x] > 1]
    assert 0 < len(expected) < 500
    for size in (1, 2, 3, 7, 500):
        batches = [rows.slice(at, size) for at in range(0, 500, size)]
        batches.insert(1, rows.slice(0, 0))
        assert [i for b in jaccard._met(iter(batches)) for i in b.column("class").to_pylist()] == expected
    assert list(jaccard._met(iter([]))) == []


def test_prefixes_leave_the_leading_bits_alone():
    """Prefixes crowd in cells of the sketch with low counts, which mustn't be ranges of the hash space."""
    values = np.array([random.Random(5).getrandbits(64) for _ in range(50)], dtype=np.uint64)
    changed = values ^ np.uint64(0xFFFFFFFF << 32)
    assert (jaccard.sketch_cells(values) == jaccard.sketch_cells(changed)).all()
