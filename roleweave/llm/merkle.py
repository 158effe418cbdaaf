"""Operator 13, Merkle manifest of a dataset: a content-addressed DAG, and proofs by descending it.

1. A row's leaf is the digest of its fields. Leaves of one language, in the order of doc_id, form a tree; its root is the
   language's subroot, and the subroots, in the order of the languages, form a tree above them. FANOUT consecutive
   nodes become the digest of their digests, the last ones of a level also when they are fewer, even one.
2. Trees are built in segments of LEVELS levels: the nodes below one digest meet in one task, which stores what it
   makes as records, digest to children. A layer of segments is one grouped pass over nodes that are fewer each time,
   so no level of a large tree is a shuffle of its own, and no task holds more than SEGMENT nodes.
3. Requests descend from the root by the digits of their rank: the segment of their digest is looked up by content, and
   in each of its levels the digit selects a child; the others are collected. As all requests below a segment share
   the path to its digest, that path is walked once for each segment and handed on; leaves walk the last one only.
4. A leaf's proof is its path from the end: path segments are reversed, and folding them again gives the root.

Null fields are written as `-`; a null language sorts first, and so do rows without an id, which are never tampered
with. Rows that share an id are ordered by their leaf, equal rows next to each other with a place for each. Empty
texts have a length of zero; a lone leaf is its subroot. An empty table gives no rows and has no root. Other columns are
not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.operators.ordering import with_position
from roleweave.session import stage

# Children of a node, and levels of a segment.
FANOUT, LEVELS = 2, 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# One in so many rows is tampered with.
TAMPERED = 7

_RECORDS = "array<struct<digest: binary, children: array<binary>>>"
_PATH = "array<struct<siblings: array<binary>, place: int>>"
_ROW = f"grp long, block long, size long, levels int, digest binary, records {_RECORDS}"


def field(value: Column) -> Column:
    """A value with its length in bytes, `-` if null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    """Digest of a row's fields, some of them changed."""
    return F.unhex(F.sha2(F.concat(*(field(changed.get(name, F.col(name))) for name in FIELDS)).cast("binary"), 256))


def digest_of(children: list[bytes]) -> bytes:
    """Digest of the children's digests, written as hex."""
    return hashlib.sha256("".join(c.hex() for c in children).encode()).digest()


def height(size: int, fanout: int) -> int:
    """Levels above `size` leaves."""
    levels = 0
    while size > 1:
        size, levels = -(-size // fanout), levels + 1
    return levels


def _segment(layer: int, fanout: int, levels: int):
    """One segment: its nodes to its top, and a record for every digest made."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("rank")
        nodes = table.column("digest").to_pylist()
        size, grp, rank = (table.column(c)[0].as_py() for c in ("size", "grp", "rank"))
        own = max(0, min(levels, height(size, fanout) - layer * levels))
        records = {}
        for _ in range(own):
            runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
            nodes = [digest_of(r) for r in runs]
            records.update(zip(nodes, runs))
        out = {
            "grp": [grp],
            "block": [rank // fanout**levels],
            "size": [size],
            "levels": [own],
            "digest": nodes,
            "records": [[{"digest": d, "children": c} for d, c in records.items()]],
        }
        return pa.table(out, schema=_SEGMENT)

    return run


_PATH_TYPE = pa.list_(pa.struct([("siblings", pa.list_(pa.binary())), ("place", pa.int32())]))
_SEGMENT = pa.schema(
    [
        ("grp", pa.int64()),
        ("block", pa.int64()),
        ("size", pa.int64()),
        ("levels", pa.int32()),
        ("digest", pa.binary()),
        ("records", pa.list_(pa.struct([("digest", pa.binary()), ("children", pa.list_(pa.binary()))]))),
    ]
)


@dataclass
class Trees:
    """Trees of several groups: their segments by layer, lowest first."""

    layers: list[DataFrame]
    fanout: int
    levels: int

    def tops(self) -> DataFrame:
        """grp, size and root digest of each group, and its highest layer."""
        found = None
        for i, layer in enumerate(self.layers):
            last = layer.where(F.col("size") <= self.width ** (i + 1)).select("grp", "size", "digest", F.lit(i).alias("top"))
            found = last if found is None else found.union(last)
        return found

    @property
    def width(self) -> int:
        return self.fanout**self.levels


def trees(nodes: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> Trees:
    """Trees over `nodes` (grp, rank from 0, size of the group, digest)."""
    largest = nodes.agg(F.coalesce(F.max("size"), F.lit(0))).first()[0]
    width, layers = fanout**levels, []
    while True:
        i = len(layers)
        # Groups whose tree has ended below take no part.
        held = nodes if not i else layers[-1].where(F.col("size") > width**i).select("grp", F.col("block").alias("rank"), "size", "digest")
        own = held.select("grp", "rank", "size", "digest").groupBy("grp", F.expr(f"rank div {width}"))
        layers.append(stage(own.applyInArrow(_segment(i, fanout, levels), _ROW), "merkle_segments"))
        if largest <= width ** (i + 1):
            return Trees(layers, fanout, levels)


def walked(digest: bytes, local: int, records: dict[bytes, list[bytes]], levels: int, fanout: int) -> tuple[bytes, list[tuple[list[bytes], int]]]:
    """Descend `levels` levels by the digits of `local`: the digest reached, and the unselected children on the way."""
    path = []
    for level in range(levels - 1, -1, -1):
        children = records[digest]
        at = local // fanout**level % fanout
        digest = children[at]
        path.append((children[:at] + children[at + 1 :], at))
    return digest, path


def _descend(fanout: int, width: int, schema: pa.Schema, answer: Callable):
    """Requests of one segment, which comes with its records and the path to it."""

    def run(requests: pa.Table, segment: pa.Table) -> pa.Table:
        if not requests.num_rows:
            return schema.empty_table()
        (own,) = segment.to_pylist()
        records = {r["digest"]: r["children"] for r in own["records"]}
        upper = [(p["siblings"], p["place"]) for p in own["path"]]
        found = []
        for rank in requests.column("rank").to_pylist():
            found.append(walked(own["digest"], rank % width, records, own["levels"], fanout))
        return pa.table(answer(requests, own, upper, found), schema=schema)

    return run


_FOUND = pa.schema([("grp", pa.int64()), ("rank", pa.int64()), ("digest", pa.binary()), ("origin", pa.binary()), ("path", _PATH_TYPE)])


def _handed_on(requests: pa.Table, own: dict, upper: list, found: list) -> dict:
    """Paths of requests as they are, for the segments or trees below."""
    origin = own["origin"]
    return {
        "grp": requests.column("grp"),
        "rank": requests.column("rank"),
        "digest": [d for d, _ in found],
        "origin": [origin] * len(found),
        "path": [[{"siblings": s, "place": p} for s, p in upper + path] for _, path in found],
    }


def descend(built: Trees, starts: DataFrame, requests: DataFrame, schema: str, answer: Callable, found: pa.Schema) -> DataFrame:
    """Answers to all `requests` (grp, rank, ...) from the roots of their groups.

    `starts` has grp, origin (the root digest there) and the path to it. In each layer the segments on the way are looked
    up by digest; those of the layer below are the requests of the one above.
    """
    width, above = built.width, None
    begin = built.tops().join(starts, "grp").select("grp", F.lit(0).cast("long").alias("rank"), "digest", "origin", "path", "top")
    begin = stage(begin, "merkle_starts")
    for i in range(len(built.layers) - 1, -1, -1):
        at = begin.where(F.col("top") == i).drop("top")
        at = at if above is None else above.unionByName(at)
        # Equal segments are one record, wherever they stand.
        records = built.layers[i].select("digest", "levels", "records").dropDuplicates(["digest", "levels"])
        named = at.select("grp", F.col("rank").alias("block"), "digest", "origin", "path").join(records, "digest")
        asked = requests if i == 0 else built.layers[i - 1].where(F.col("size") > width**i).select("grp", F.col("block").alias("rank"))
        left = asked.groupBy("grp", F.expr(f"rank div {width}"))
        both = left.cogroup(named.groupBy("grp", "block"))
        if i == 0:
            return both.applyInArrow(_descend(built.fanout, width, found, answer), schema)
        above = stage(both.applyInArrow(_descend(built.fanout, width, _FOUND, _handed_on), f"grp long, rank long, digest binary, origin binary, path {_PATH}"), "merkle_paths")
    raise AssertionError


@dataclass
class Manifest:
    """Leaves with their place, the trees of the languages and the one above them, and the languages."""

    leaves: DataFrame
    languages: DataFrame
    lower: Trees
    upper: Trees

    def root(self) -> bytes | None:
        """Digest of the whole dataset."""
        row = self.upper.tops().first()
        return None if row is None else row["digest"]


def manifest(docs: DataFrame, fanout: int = FANOUT, levels: int = LEVELS) -> Manifest:
    """The DAG over all rows of `docs`."""
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0, leaf(n_chars=F.col("n_chars").cast("decimal(20,0)") + 1))
    rows = docs.select(*FIELDS).select("lang", F.col("doc_id").cast("long").alias("doc_id"), leaf().alias("leaf"), tampered.alias("tampered"))
    placed = with_position(rows, [F.col(c) for c in ("lang", "doc_id", "leaf")])
    languages = with_position(placed.groupBy("lang").agg(F.min("position").alias("first"), F.count("*").alias("size")), [F.col("lang")], "grp")
    named = languages.withColumnRenamed("lang", "_lang")
    joined = placed.join(named, F.col("lang").eqNullSafe(F.col("_lang")))
    leaves = stage(joined.select("grp", (F.col("position") - F.col("first")).alias("rank"), "size", "doc_id", "leaf", "tampered"), "merkle_leaves")
    lower = trees(leaves.withColumnRenamed("leaf", "digest"), fanout, levels)
    count = languages.count()
    subroots = lower.tops().select(F.lit(0).cast("long").alias("grp"), (F.col("grp") - 1).alias("rank"), F.lit(count).cast("long").alias("size"), "digest")
    return Manifest(leaves, languages, lower, trees(subroots, fanout, levels))


def fold(own: str, path: list[tuple[str, str]]) -> str:
    """Digest of the root from a leaf's and, level by level, what stands before and after it."""
    for before, after in path:
        own = hashlib.sha256((before + own + after).encode()).hexdigest()
    return own


_PROOF = pa.schema(
    [
        ("doc_id", pa.int64()),
        *((name, pa.string()) for name in ("leaf", "subroot", "root", "proof_sha256", "folded_root")),
        ("verified", pa.bool_()),
    ]
)


def _checked(root: str):
    """Proofs of the leaves of a segment: its reversed path, folded over the leaf or what it was changed to."""

    def answer(requests: pa.Table, own: dict, upper: list, found: list) -> dict:
        sides = lambda s, at: ("".join(x.hex() for x in s[:at]), "".join(x.hex() for x in s[at:]))
        shared = [sides(*step) for step in reversed(upper)]
        tail = "".join(a + b for a, b in shared)
        out = {name: [] for name in _PROOF.names}
        columns = (requests.column(c).to_pylist() for c in ("doc_id", "leaf", "tampered"))
        for doc, leaf_digest, changed, (_, path) in zip(*columns, found):
            steps = [sides(*step) for step in reversed(path)]
            folded = fold((changed or leaf_digest).hex(), steps + shared)
            proof = hashlib.sha256(("".join(a + b for a, b in steps) + tail).encode()).hexdigest()
            for name, value in zip(out, (doc, leaf_digest.hex(), own["origin"].hex(), root, proof, folded, folded == root)):
                out[name].append(value)
        return out

    return answer


def proofs(of: Manifest) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root and verified of every row."""
    root = of.root()
    empty = F.array().cast(_PATH)
    top = of.upper.tops().select("grp", F.col("digest").alias("origin"), empty.alias("path"))
    asked = of.languages.select(F.lit(0).cast("long").alias("grp"), (F.col("grp") - 1).alias("rank"))
    schema = f"grp long, rank long, digest binary, origin binary, path {_PATH}"
    subroots = stage(descend(of.upper, top, asked, schema, _handed_on, _FOUND), "merkle_subroots")
    starts = subroots.select((F.col("rank") + 1).alias("grp"), F.col("digest").alias("origin"), "path")
    out = "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
    return descend(of.lower, starts, of.leaves.select("grp", "rank", "doc_id", "leaf", "tampered"), out, _checked(root.hex() if root else ""), _PROOF)
