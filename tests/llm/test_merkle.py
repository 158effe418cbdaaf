from __future__ import annotations

import hashlib
import zlib

import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import merkle


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, more=0):
    chars = None if row[4] is None else row[4] + more
    values = [None if v is None else str(v) for v in (row[0], row[3], row[2], chars, row[1])]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in values))


def levels(nodes, fanout):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([sha("".join(out[-1][i : i + fanout])) for i in range(0, len(out[-1]), fanout)])
    return out


def path(tree, at, fanout):
    """What stands before and after the node at `at`, level by level."""
    for level in tree[:-1]:
        run = at // fanout * fanout
        yield "".join(level[run:at]), "".join(level[at + 1 : run + fanout])
        at //= fanout


def brute(rows, fanout=2):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in order:
        own = sorted(by_lang[lang], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        by_lang[lang] = own
        trees[lang] = levels([leaf(r) for r in own], fanout)
    top = levels([trees[lang][-1][0] for lang in order], fanout)
    out = []
    for at, lang in enumerate(order):
        for i, row in enumerate(by_lang[lang]):
            steps = [*path(trees[lang], i, fanout), *path(top, at, fanout)]
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            folded = leaf(row, 1 if changed else 0)
            for before, after in steps:
                folded = sha(before + folded + after)
            proof = sha("".join(a + b for a, b in steps))
            out.append((row[0], leaf(row), trees[lang][-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def rows_of(table):
    return [tuple(r) for r in table.select("doc_id", "text", "lang", "source", "n_chars").collect()]


def check(table, **sizes):
    found = [tuple(r) for r in merkle.proofs(merkle.manifest(table, **sizes)).collect()]
    expected = brute(rows_of(table), sizes.get("fanout", 2))
    assert sorted(found, key=str) == sorted(expected, key=str)
    return found


@pytest.fixture(scope="module")
def many():
    langs = ["en"] * 41 + ["de", "zz", None, "é", "fr", "fr", ""]
    return [(i * 3, f"text {i}" if i % 9 else None, langs[i % len(langs)], None if i % 5 == 0 else f"s{i % 3}") for i in range(300)]


@pytest.mark.parametrize("fanout, levels", [(2, 8), (2, 2), (3, 2), (2, 1)])
def test_equals_brute_force(docs, many, fanout, levels):
    """Trees of one and several layers of segments, lone last nodes, and a language that holds most rows."""
    found = check(docs(many), fanout=fanout, levels=levels)
    tampered = {r[0] for r in found if not r[6]}
    assert tampered and all(zlib.crc32(str(i).encode()) % 7 == 0 for i in tampered)


def test_edges(docs, edge_rows):
    """Null and shared ids, equal rows, null texts (whose n_chars stays null) and very long ones."""
    check(docs(edge_rows + [(None, "other"), (None, None), (70, None)]), levels=2)


@pytest.mark.parametrize("n", [1, 2, 3, 256, 257])
def test_sizes(docs, n):
    check(docs([(i, "t", "en", "s") for i in range(n)]))


def test_lone_leaf_is_the_root(docs):
    (row,) = check(docs([(1, "t", "en", "s")]))
    assert row[1] == row[2] == row[3] and row[4] == sha("")


def test_large_numbers_and_empty_table(spark, docs):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = spark.createDataFrame([(0, "t", "en", "s", 2**63 - 1), (9, "t", "en", "s", None)], schema)
    check(table)
    empty = merkle.manifest(docs([]))
    assert empty.root() is None and merkle.proofs(empty).count() == 0


def test_other_columns_and_row_order_change_nothing(docs, many):
    assert merkle.manifest(docs(many)).root() == merkle.manifest(docs(many[::-1]).drop("root", "token")).root()


def test_equal_rows_share_segments(docs):
    """Content addresses: segments of equal rows are one record."""
    built = merkle.manifest(docs([(None, "same")] * 16), levels=2)
    layer = built.lower.layers[0]
    assert layer.count() == 4 and layer.select("digest").distinct().count() == 1
    check(docs([(None, "same")] * 17), levels=2)
