from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib

import pytest

from roleweave.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string"
NOT_SPACE = re.compile(r"[^\x20\x09-\x0D]")


@pytest.fixture(scope="module")
def table(spark):
    from pyspark.sql import functions as F

    def build(rows):
        return spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(c) for c in ("done", "part", "slice", "digest", "seen", "_kind", "_conv", "is_row")})

    return build


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        key = ":".join(" " if v is None else str(v) for v in (conv, turn))
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def faults_of(rows):
    out, seen = [], set()
    for _, _, role, text in rows:
        kept = NOT_SPACE.findall(text)
        out.append("blank" if not kept else "duplicate" if (role, text) in seen else "" if kept[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, faults):
    """Edits in the order of their cost and then of their marks; nothing is pruned."""
    heap = [(0, "", 0, "")]
    while True:
        cost, audit, i, roles = heapq.heappop(heap)
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            return cost, audit
        ways = [(5, "I", i, "u"), (5, "I", i, "a")]
        if i < len(rows):
            ways.append((2, "D", i + 1, ""))
            if faults[i] not in ("blank", "duplicate"):
                more = 5 if faults[i] == "truncated" else 0
                ways += [(more, "K", i + 1, rows[i][2][:1] or "-"), (1 + more, "R", i + 1, "u"), (1 + more, "R", i + 1, "a")]
        for price, mark, at, role in ways:
            if re.fullmatch("s?(ua)*u?", roles + role):
                heapq.heappush(heap, (cost + price, audit + mark, at, roles + role))


def repaired_text(rows, audit):
    out, i, roles = [], 0, ""
    for mark in audit:
        if mark == "D":
            i += 1
            continue
        role, text = ("user", "assistant")[roles.endswith("u")], ""
        if mark != "I":
            role, text, i = rows[i][2] if mark == "K" else role, rows[i][3], i + 1
        out.append(f"{role}:{text}")
        roles += role[:1]
    assert re.fullmatch("(s?(ua)+)?", roles)
    return "\n".join(out)


def brute(rows, audit=None, damage=damage):
    out = {}
    for conv in {r[0] for r in rows}:
        own = damage([r for r in rows if r[0] == conv])
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), hashlib.sha256(r[3].encode()).digest()))
        faults = faults_of(own)
        cost, marks = (audit or cheapest)(own, faults)
        turns = [r[1] for r in own if r[1] is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        initials = [r[2][:1] for r in own]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
        counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
        out[conv] = (gaps, *counts, illegal, cost, marks, hashlib.sha256(repaired_text(own, marks).encode()).hexdigest())
    return out


def found(df):
    rows = [tuple(r) for r in df.collect()]
    assert len({r[0] for r in rows}) == len(rows)
    return {r[0]: r[1:] for r in rows}


def random_rows(seed, conversations, longest):
    rng = random.Random(seed)
    roles = ["user", "assistant", "system", "tool", "user", "assistant", None, ""]
    texts = ["Yes.", "No", "Why?", "", " \n", None, "Go on!  ", "x.y", "end…"]
    return [
        (c if c else None, rng.choice([t, t, t, t - 1, t + 2, None]), rng.choice(roles), rng.choice(texts) if rng.random() < 0.6 else f"t{rng.randint(0, 9)}.")
        for c in range(conversations)
        for t in range(rng.randint(1, longest))
    ]


def test_equals_brute_force(table):
    rows = random_rows(3, 120, 5)
    assert found(repair.audits(table(rows))) == brute(rows)


@pytest.mark.parametrize("partitions", [1, 13])
def test_conversations_that_cross_slices(spark, table, partitions):
    """Long conversations are put together from the parts of many tasks."""
    rows = random_rows(5, 3, 4) + [(50, i // 2, random.Random(i).choice(["user", "assistant"]), f"t{i % 37}{'.' if i % 5 else ''}") for i in range(400)]
    rows += [(51, i, "user", "same.") for i in range(60)] + [(52, 1, "user", "equal.")] * 40
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = found(repair.audits(table(rows)))
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert out == brute(rows, by_states)


def by_states(rows, faults):
    """Plain dynamic program over (cost, audit) pairs."""
    ways = closed({0: (0, "")})
    for row, fault in zip(rows, faults):
        after = {}
        for state, (cost, audit) in ways.items():
            options = [(state, 2, "D")]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                initial = row[2][:1]
                for role, (before, target) in {"s": ({0}, 1), "u": ({0, 1, 3}, 2), "a": ({2}, 3)}.items():
                    if state in before and (initial == role or role != "s"):
                        options.append((target, more + (initial != role), "K" if initial == role else "R"))
            for target, price, mark in options:
                after[target] = min(after.get(target, (10**9, "")), (cost + price, audit + mark))
        ways = closed(after)
    return min(ways[s] for s in (0, 3) if s in ways)


def closed(ways):
    for state, target in ((0, 2), (1, 2), (3, 2), (2, 3)):
        if state in ways:
            ways[target] = min(ways.get(target, (10**9, "")), (ways[state][0] + 5, ways[state][1] + "I"))
    return ways


def test_states_equal_unpruned_search():
    for seed in range(4):
        for conv in range(30):
            rows = damage([r for r in random_rows(seed, 30, 5) if r[0] == conv])
            assert by_states(rows, faults_of(rows)) == cheapest(rows, faults_of(rows))


def test_edges(table):
    dropped = next(t for t in range(1000) if zlib.crc32(f"8:{t}".encode()) % 20 == 0)
    rows = [
        (8, dropped, "user", "gone."),
        (9, None, None, None),
        (None, None, "assistant", "a."),
        (None, 3, "system", "s."),
        (10, -5, "user", "x" * 300_000 + "?"),
        (10, 5, "assistant", "é☃.\x85"),
        (10, 5, "assistant", "é☃.\x85"),
        (11, -(2**62), "user", "a."),
        (11, 2**62 - 1, "assistant", "b."),
    ]
    out = found(repair.audits(table(rows)))
    assert out == brute(rows)
    assert out[8] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.audits(table([])).count() == 0


def test_audits_compare_by_their_first_difference():
    """Also where all hashes collide."""
    rng = random.Random(8)
    for base in (repair._BASE, 0):
        old, repair._BASE = repair._BASE, base
        try:
            audits, nodes = repair.Audits(), [0]
            for _ in range(300):
                nodes.append(audits.add(rng.choice(nodes[-20:]), rng.choice("KD")))
            for _ in range(3000):
                a, b = rng.choice(nodes), rng.choice(nodes)
                assert audits.less(a, b) == (audits.text(a) < audits.text(b))
        finally:
            repair._BASE = old


def test_deep_ties_are_shared():
    """A long conversation of ties costs nodes in proportion to its rows."""
    run = repair.Run([repair.NONE])
    for i in range(3000):
        run.add(i, "user", f"t{i}.", str(i).encode(), False)
    assert len(run.audits.mark) < 20 * 3000
    rows = [(1, i, "user", f"t{i}.") for i in range(3000)]
    found = repair.together([run.part()])
    assert (found["cost"], found["audit"]) == by_states(rows, [""] * 3000)
