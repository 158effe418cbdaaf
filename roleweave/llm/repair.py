"""Operator 11, conversation repair: the cheapest edits that give a conversation its structure, with an audit of them.

Rows are kept, given another role, deleted, or preceded by inserted ones, so that the role initials read
`(s?(ua)+)?`. One pass over a conversation's rows holds, for each state of the roles (none yet, s, u, a), the least
cost and the least audit among those of that cost. Audits share their prefixes: each is a node linked to the one before,
with ancestors at distances of powers of two and a rolling hash of all its marks. Ties are decided at the first mark
that differs, which a search over the ancestors finds by hashes; equal hashes are verified mark by mark.
Neither of two audits of one cost is ever a prefix of the other: they mark the same rows, and each insertion costs.

A conversation may be of any length. Rows are range-partitioned in their order; a task writes, for every run of a
conversation that it holds, either the result, or, for the first and the last run, which may go on elsewhere, a
table of the cheapest edits from each state to each (`Part`). Parts of a conversation are put together, one for each
task that met it, and its repaired text is hashed in one pass over its rows, which holds one row at a time.

Nulls count as one space. Rows of one conversation are taken by turn (nulls first), then by role, then by a digest of
the text; equal rows stand next to each other, and all but the first are duplicates. A null conv_id is a conversation
like any other. Conversations of which no row is left have zeros, an empty audit and the hash of the empty text. An
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.session import stage

SPACES = " \t\n\v\f\r"
KEEP, REROLE, DELETE, INSERT = "KRDI"
COST = {REROLE: 1, DELETE: 2, INSERT: 5}
TRUNCATED = 5
# States of the role initials so far; a conversation may end in the first and in the last.
NONE, SYSTEM, USER, ASSISTANT = range(4)
STATES = (NONE, SYSTEM, USER, ASSISTANT)
# Which states a row of this initial may follow, and to which it leads.
FOLLOWS = {"s": ((NONE,), SYSTEM), "u": ((NONE, SYSTEM, ASSISTANT), USER), "a": ((USER,), ASSISTANT)}
ROLES = {USER: "user", ASSISTANT: "assistant"}
NEXT = {NONE: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
LEGAL = {"su", "ua", "au"}
_BASE, _PRIME = 0x1F3D5B79, (1 << 61) - 1


class Audits:
    """Marks as linked nodes. Node 0 is the empty audit."""

    def __init__(self) -> None:
        self.mark, self.parent, self.depth, self.code = [""], [0], [0], [0]
        # Ancestors at distances 1, 2, 4, ... of each node.
        self.ups: list[tuple[int, ...]] = [()]
        self.equal: set[tuple[int, int]] = set()

    def add(self, parent: int, mark: str) -> int:
        own, ups, k = len(self.mark), [parent], 0
        while k < len(self.ups[ups[k]]):
            ups.append(self.ups[ups[k]][k])
            k += 1
        self.mark.append(mark)
        self.parent.append(parent)
        self.depth.append(self.depth[parent] + 1)
        self.code.append((self.code[parent] * _BASE + ord(mark)) % _PRIME)
        self.ups.append(tuple(ups))
        return own

    def text(self, node: int) -> str:
        marks = []
        while node:
            marks.append(self.mark[node])
            node = self.parent[node]
        return "".join(reversed(marks))

    def at_depth(self, node: int, depth: int) -> int:
        more = self.depth[node] - depth
        while more:
            k = more.bit_length() - 1
            node, more = self.ups[node][k], more - (1 << k)
        return node

    def same(self, a: int, b: int) -> bool:
        """Whether two audits of one depth have the same marks, compared as far as they don't share their nodes."""
        walked = []
        while a != b and (a, b) not in self.equal:
            if self.mark[a] != self.mark[b]:
                return False
            walked.append((a, b))
            a, b = self.parent[a], self.parent[b]
        self.equal.update(walked)
        return True

    def fork(self, a: int, b: int) -> tuple[int, int]:
        """The first nodes that differ of two audits of one depth; the roots if there is none."""
        if self.code[a] == self.code[b] and self.same(a, b):
            return 0, 0
        x, y = a, b
        for k in range(len(self.ups[a]) - 1, -1, -1):
            if k < len(self.ups[x]) and self.code[self.ups[x][k]] != self.code[self.ups[y][k]]:
                x, y = self.ups[x][k], self.ups[y][k]
        if self.code[x] != self.code[y] and self.same(self.parent[x], self.parent[y]):
            return x, y
        # Hashes that collide: the marks decide.
        x, y = 0, 0
        while a:
            if self.mark[a] != self.mark[b]:
                x, y = a, b
            a, b = self.parent[a], self.parent[b]
        return x, y

    def less(self, a: int, b: int) -> bool:
        """Whether audit `a` comes before `b` in ASCII order."""
        depth = min(self.depth[a], self.depth[b])
        x, y = self.fork(self.at_depth(a, depth), self.at_depth(b, depth))
        return self.mark[x] < self.mark[y] if x or y else self.depth[a] < self.depth[b]


Ways = list[tuple[int, int] | None]


def _better(audits: Audits, ways: Ways, state: int, cost: int, parent: int, mark: str) -> None:
    """Let the state be reached by one more mark, if that costs less, or as much with a lesser audit."""
    held = ways[state]
    if held is None or cost < held[0]:
        ways[state] = (cost, audits.add(parent, mark))
    elif cost == held[0]:
        node = audits.add(parent, mark)
        if audits.less(node, held[1]):
            ways[state] = (cost, node)


def inserted(audits: Audits, ways: Ways) -> Ways:
    """Insertions behind a row. Two of them lead from u or a back to it, so no longer chain is cheapest."""
    for state in (NONE, SYSTEM, ASSISTANT, USER):
        if ways[state] is not None:
            cost, node = ways[state]
            _better(audits, ways, NEXT[state], cost + COST[INSERT], node, INSERT)
    return ways


def step(audits: Audits, ways: Ways, initial: str, fault: str) -> Ways:
    """Ways after one more row."""
    out: Ways = [None] * len(STATES)
    more = TRUNCATED if fault == "truncated" else 0
    for state, held in enumerate(ways):
        if held is None:
            continue
        _better(audits, out, state, held[0] + COST[DELETE], held[1], DELETE)
        if fault in ("blank", "duplicate"):
            continue
        for role, (before, after) in FOLLOWS.items():
            if state not in before:
                continue
            if role == initial:
                _better(audits, out, after, held[0] + more, held[1], KEEP)
            elif after in ROLES:
                _better(audits, out, after, held[0] + more + COST[REROLE], held[1], REROLE)
    return inserted(audits, out)


class Run:
    """Rows of one conversation in their order: counts, and the cheapest edits from each of the states asked for."""

    def __init__(self, states: Iterable[int]) -> None:
        self.audits = Audits()
        self.ways: dict[int, Ways] = {}
        for s in states:
            own: Ways = [None] * len(STATES)
            own[s] = (0, 0)
            self.ways[s] = inserted(self.audits, own)
        self.rows: list[tuple[str, str]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.first_turn = self.last_turn = None
        self.first_initial = self.last_initial = None
        self.before = None

    def add(self, turn: int | None, role: str, text: str, digest: bytes, seen: bool) -> None:
        own = (turn, role, digest)
        kept = text.rstrip(SPACES)
        if not kept:
            fault = "blank"
            self.blank += 1
        elif seen or own == self.before:
            fault = "duplicate"
            self.duplicate += 1
        elif kept[-1] not in ".!?":
            fault = "truncated"
            self.truncated += 1
        else:
            fault = ""
        if turn is not None:
            self.turns += turn != self.last_turn
            self.first_turn = turn if self.first_turn is None else self.first_turn
            self.last_turn = turn
        initial = role[:1]
        if self.first_initial is None:
            self.first_initial = initial
        else:
            self.illegal += self.last_initial + initial not in LEGAL
        self.last_initial, self.before = initial, own
        self.ways = {s: step(self.audits, w, initial, fault) for s, w in self.ways.items()}
        self.rows.append((role, text))

    def part(self) -> dict:
        """Everything that putting runs together needs."""
        ways = [
            {"source": s, "target": t, "cost": held[0], "audit": self.audits.text(held[1])}
            for s, own in self.ways.items()
            for t, held in enumerate(own)
            if held is not None
        ]
        return {name: getattr(self, name) for name in COUNTS + EDGES} | {"ways": ways}


COUNTS = ("blank", "duplicate", "truncated", "illegal", "turns")
EDGES = ("first_turn", "last_turn", "first_initial", "last_initial")


def together(parts: list[dict]) -> dict:
    """Counts, cost and audit of a conversation from those of its runs, in their order."""
    total = {name: sum(p[name] for p in parts) for name in COUNTS}
    total["illegal"] += sum(a["last_initial"] + b["first_initial"] not in LEGAL for a, b in zip(parts, parts[1:]))
    turned = [p for p in parts if p["first_turn"] is not None]
    turns = total.pop("turns") - sum(a["last_turn"] == b["first_turn"] for a, b in zip(turned, turned[1:]))
    total["gaps"] = min(turned[-1]["last_turn"] - turned[0]["first_turn"] + 1 - turns, (1 << 63) - 1) if turned else 0
    # Audits so far, as linked pieces, from no role to each state.
    held: dict[int, tuple[int, tuple]] = {NONE: (0, ())}
    for part in parts:
        after: dict[int, tuple[int, tuple]] = {}
        for way in part["ways"]:
            if way["source"] not in held:
                continue
            cost, pieces = held[way["source"]]
            cost, pieces = cost + way["cost"], (pieces, way["audit"])
            old = after.get(way["target"])
            if old is None or cost < old[0] or (cost == old[0] and _joined(pieces) < _joined(old[1])):
                after[way["target"]] = (cost, pieces)
        held = after
    cost, audit = min((held[s][0], _joined(held[s][1])) for s in (NONE, ASSISTANT) if s in held)
    return total | {"cost": cost, "audit": audit}


def _joined(pieces: tuple) -> str:
    out = []
    while pieces:
        pieces, last = pieces
        out.append(last)
    return "".join(reversed(out))


class Repaired:
    """Applies an audit to rows as they come, and hashes what it gives."""

    def __init__(self, audit: str) -> None:
        self.audit, self.at, self.state = audit, 0, NONE
        self.hash, self.empty = hashlib.sha256(), True

    def write(self, role: str, text: str) -> None:
        self.hash.update(("" if self.empty else "\n").encode() + f"{role}:{text}".encode("utf-8", "surrogatepass"))
        self.empty = False

    def insertions(self) -> None:
        while self.audit[self.at : self.at + 1] == INSERT:
            self.state = NEXT[self.state]
            self.write(ROLES[self.state], "")
            self.at += 1

    def row(self, role: str, text: str) -> None:
        self.insertions()
        mark = self.audit[self.at]
        self.at += 1
        if mark == DELETE:
            return
        if mark == KEEP:
            self.state = FOLLOWS[role[0]][1]
        else:
            self.state = NEXT[self.state]
            role = ROLES[self.state]
        self.write(role, text)

    def digest(self) -> str:
        self.insertions()
        return self.hash.hexdigest()


_NUMBERS = ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_RESULT = ", ".join(f"{n} long" for n in _NUMBERS) + ", audit string, repaired_sha256 string"
_PART_NUMBERS = (*COUNTS, "first_turn", "last_turn")
_PART_TEXTS = ("first_initial", "last_initial")
_RUN = (
    f"done struct<{', '.join(f'{n}: long' for n in _NUMBERS)}, audit: string, repaired_sha256: string>, "
    f"part struct<conv_id: long, slice: int, {', '.join(f'{n}: long' for n in _PART_NUMBERS)}, {', '.join(f'{n}: string' for n in _PART_TEXTS)}, "
    "ways: array<struct<source: int, target: int, cost: long, audit: string>>>"
)
_RESULT_TYPE = pa.struct([*((n, pa.int64()) for n in _NUMBERS), ("audit", pa.string()), ("repaired_sha256", pa.string())])
_WAYS = pa.list_(pa.struct([("source", pa.int32()), ("target", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_PART_TYPE = pa.struct(
    [
        ("conv_id", pa.int64()),
        ("slice", pa.int32()),
        *((n, pa.int64()) for n in _PART_NUMBERS),
        *((n, pa.string()) for n in _PART_TEXTS),
        ("ways", _WAYS),
    ]
)
_COLUMNS = ("conv_id", "turn", "role", "text", "digest", "seen")


def _rows(batches: Iterator[pa.RecordBatch], columns: tuple[str, ...]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            piece = batch.slice(at, 256)
            yield from zip(*(piece.column(c).to_pylist() for c in columns))


def _finished(run: Run, conversation: int | None) -> dict:
    found = together([run.part()])
    text = Repaired(found["audit"])
    for role, body in run.rows:
        text.row(role, body)
    return found | {"conv_id": conversation, "repaired_sha256": text.digest()}


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the conversations that lie wholly inside this slice, and parts of those at its ends."""
    done: list[dict | None] = []
    parts: list[dict | None] = []
    where = TaskContext.get().partitionId()
    run, own, first = None, None, True

    def close(at_end: bool) -> None:
        edge = first or at_end
        done.append(None if edge else _finished(run, own))
        parts.append(run.part() | {"conv_id": own, "slice": where} if edge else None)

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(done, _RESULT_TYPE), pa.array(parts, _PART_TYPE)], ["done", "part"])
        done.clear()
        parts.clear()
        return out

    rows = _rows(batches, _COLUMNS)
    ahead = next(rows, None)
    while ahead is not None:
        own = ahead[0]
        held = []
        # Rows are taken in before it is known whether the run ends the slice, which all states then matter for.
        while ahead is not None and ahead[0] == own:
            held.append(ahead[1:])
            ahead = next(rows, None)
        run = Run(STATES if first or ahead is None else (NONE,))
        for row in held:
            run.add(*row)
        close(ahead is None)
        first = False
        if len(done) >= 500:
            yield flush()
    yield flush()


def _merged(table: pa.Table) -> pa.Table:
    """Runs of one conversation, at most one from each slice."""
    parts = sorted(table.to_pylist(), key=lambda p: p["slice"])
    found = together(parts)
    columns = (*_NUMBERS, "audit")
    return pa.table({c: pa.array([parts[0]["conv_id"] if c == "conv_id" else found[c]], _RESULT_TYPE.field(c).type) for c in columns})


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of each conversation's repaired text, whose audit comes before its rows."""
    own, text = None, None
    ids: list[int | None] = []
    hashes: list[str] = []

    def close() -> None:
        if text is not None:
            ids.append(own)
            hashes.append(text.digest())

    for conversation, is_row, role, body in _rows(batches, ("conv_id", "is_row", "role", "text")):
        if is_row:
            text.row(role, body)
            continue
        close()
        own, text = conversation, Repaired(body)
    close()
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role and text after the faults that the checksum of a row's place brings into it."""
    space = F.lit(" ")
    place = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kinds = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(place.cast("binary")) % 20).alias("_kind"),
    ).where("_kind <> 0")
    kind = F.col("_kind")
    text = F.when(kind == 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    once, twice = F.array(F.lit(1)), F.array(F.lit(1), F.lit(2))
    made = kinds.withColumns({"text": text, "role": F.when(kind == 4, "user").otherwise(F.col("role")), "_times": F.explode(F.when(kind == 3, twice).otherwise(once))})
    return made.select("conv_id", "turn", "role", "text")


def _slices(rows: DataFrame) -> DataFrame:
    """Rows in their order, those seen at an earlier turn of their conversation marked."""
    keyed = stage(rows.select("conv_id", "turn", "role", "text", F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")), "repair_rows")
    order = F.struct(F.col("turn").isNotNull().alias("named"), "turn")
    several = keyed.groupBy("conv_id", "role", "digest").agg(F.count("*").alias("_n"), F.min(order).alias("_first")).where("_n > 1")
    several = stage(several.select(F.col("conv_id").alias("_conv"), F.col("role").alias("_role"), F.col("digest").alias("_digest"), "_first"), "repair_repeats")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("role") == F.col("_role")) & (F.col("digest") == F.col("_digest"))
    seen = F.coalesce(order > F.col("_first"), F.lit(False))
    return keyed.join(several, same, "left").select(*_COLUMNS[:-1], seen.alias("seen"))


def repaired(rows: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of the conversations of `rows`.

    `rows` has conv_id, turn, role and text, without nulls in the last two.
    """
    keys = ["conv_id", "turn", "role", "digest"]
    marked = stage(_slices(rows), "repair_marked")
    ordered = marked.repartitionByRange(*keys).sortWithinPartitions(*keys).select(*_COLUMNS)
    runs = stage(ordered.mapInArrow(_runs, _RUN), "repair_runs")
    whole = runs.where("done is not null").select("done.*")
    # At most two rows of each slice are parts, so their conversations are few.
    parts = runs.where("part is not null").select("part.*")
    merged = stage(parts.groupBy("conv_id").applyInArrow(_merged, _RESULT.rsplit(",", 1)[0]), "repair_merged")
    named = merged.select(F.col("conv_id").alias("_conv"))
    again = marked.join(named, F.col("conv_id").eqNullSafe(F.col("_conv")), "left_semi")
    null = F.lit(None)
    heads = merged.select("conv_id", null.cast("long").alias("turn"), null.cast("string").alias("role"), null.cast("binary").alias("digest"), F.lit(False).alias("is_row"), F.col("audit").alias("text"))
    lines = heads.unionByName(again.select(*keys, F.lit(True).alias("is_row"), "text"))
    sorted_lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "is_row", *keys[1:]).select("conv_id", "is_row", "role", "text")
    hashes = sorted_lines.mapInArrow(_hashed, "conv_id long, repaired_sha256 string").withColumnRenamed("conv_id", "_conv")
    return whole.unionByName(merged.join(hashes, F.col("conv_id").eqNullSafe(F.col("_conv"))).drop("_conv"))


def audits(conversations: DataFrame) -> DataFrame:
    """The same for every conversation before damage, also those of which nothing is left."""
    every = conversations.select(F.col("conv_id").cast("long").alias("_every")).distinct()
    found = repaired(damaged(conversations))
    numbers = [F.coalesce(c, F.lit(0)).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    out = every.join(found, F.col("_every").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("_every").alias("conv_id"), *numbers, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))
