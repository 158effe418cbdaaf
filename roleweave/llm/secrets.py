"""Operator 1, secret scans: three fixed patterns, and values in credential context by their guess cost.

The guess cost of a value is the least product of guesses over all ways to cut it into words, dates, repeats, keyboard
walks and brute-force spans, found by dynamic programming over its places (costs are kept as log10). A value that
stands behind a credential word and costs GUESS_LOG10 or more is a span of kind `guess`. Documents are scanned on their
own, whole, in one Arrow pass without a shuffle.

Null text is empty text. Very long values cost time in proportion to their length: every part of a cut is at most
LONGEST characters, and runs and walks are jumped as a whole. Repeated rows are returned as often as they come.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.llm import arrays

ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
KINDS = ("assign", "access", "hex", "guess")
# Words that announce a credential, and the value behind them.
CONTEXT = r"""(?:pass(?:word|wd|phrase|code)?|pwd|pin|secret|token|api[_-]?key|auth|credentials?|login)\b["']?\x20*(?:[:=]|\bis\b)\x20*["']?([^\s"'<>,;]{6,})"""
# log10 of the guesses from which a value counts as secret.
GUESS_LOG10 = 8.0
LONGEST = 64
# Bytes of text looked at together.
SLICE_BYTES = 1 << 20

# Public vocabulary whose whole words, frequent ones first, follow the common ones in the guesser's dictionary.
VOCABULARY = "word_bpe_49k.json"
SHORTEST_WORD = 4

# Common words by how early a guesser tries them.
COMMON = (
    "password admin welcome login master secret dragon monkey letmein football baseball princess sunshine shadow "
    "superman michael jordan hello freedom whatever trustno qazwsx access flower summer winter spring autumn love "
    "test user guest root pass word token key example changeme default the and you that was for are with his they "
    "this have from one had but what all were when your can said there use each which she how their will other about "
    "out many then them these some her would make like him into time has look two more write see number way could "
    "people my than first water been call who oil its now find long down day did get come made may part"
).split()
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
LEET = str.maketrans("4301$@57!", "aeoisasti")
DATES = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d|(?:19|20)\d\d")


class Words:
    """The guesser's dictionary: each word's rank, counted from 1."""

    def __init__(self, words: Iterable[str]) -> None:
        self.rank: dict[str, int] = {}
        for word in words:
            self.rank.setdefault(word, len(self.rank) + 1)
        self.longest = max(map(len, self.rank), default=0)


def load(path: str | None = None) -> Words:
    """Common words, then the whole words of a vocabulary file: letters a to z, SHORTEST_WORD of them or more."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(VOCABULARY)
    with open(path, encoding="utf-8") as file:
        ids = json.load(file)["model"]["vocab"]
    whole = (piece.removesuffix("</w>") for piece in sorted(ids, key=ids.get) if piece.endswith("</w>"))
    return Words([*COMMON, *(w for w in whole if len(w) >= SHORTEST_WORD and w.isascii() and w.isalpha())])


_BASIC = Words(COMMON)
_PLACE = {c: (row, i) for row, keys in enumerate(KEY_ROWS) for i, c in enumerate(keys)}


def _alphabet(c: str) -> int:
    return 10 if c.isascii() and c.isdigit() else 26 if c.isascii() and c.isalpha() else 33 if c.isascii() else 100


def _near(a: str, b: str) -> bool:
    """Neighbouring keys of one row, or of the next row."""
    x, y = _PLACE.get(a.lower()), _PLACE.get(b.lower())
    return bool(x and y and x != y and abs(x[0] - y[0]) <= 1 and abs(x[1] - y[1]) <= 1)


def _reach(value: str, same) -> list[int]:
    """For each place the end of the longest run from it in which each pair of neighbours satisfies `same`."""
    out = [len(value)] * len(value)
    for i in range(len(value) - 2, -1, -1):
        out[i] = out[i + 1] if same(value[i], value[i + 1]) else i + 1
    return out


def parts(value: str, words: Words = _BASIC) -> Iterator[tuple[int, int, str, float]]:
    """All parts a cut may use, by start: (start, end, kind, log10 guesses)."""
    lower = value.lower()
    plain = lower.translate(LEET) if len(lower) == len(value) else value
    lower = lower if len(lower) == len(value) else value
    repeat = _reach(value, lambda a, b: a == b)
    walk = _reach(value, _near)
    step = _reach(value, lambda a, b: ord(b) - ord(a) == 1)
    for i, c in enumerate(value):
        yield i, i + 1, "brute", math.log10(_alphabet(c))
        for end in range(i + 2, min(len(value), i + words.longest) + 1):
            for spelled, extra in ((lower[i:end], 0.0), (plain[i:end], math.log10(2))):
                if spelled in words.rank:
                    capital = math.log10(2) if value[i:end] != lower[i:end] else 0.0
                    yield i, end, "word", math.log10(words.rank[spelled]) + capital + extra
        if match := DATES.match(value, i):
            yield i, match.end(), "date", math.log10(365 * (1 if len(match[0]) == 4 else 100)) - (math.log10(3) if len(match[0]) == 4 else 0)
        for kind, reach, each in (("repeat", repeat, _alphabet(c)), ("walk", walk, 47), ("walk", step, 30)):
            for end in {min(reach[i], i + LONGEST), reach[i]}:
                if end - i >= 3:
                    yield i, end, kind, math.log10(each * (end - i))


def segmentation(value: str, words: Words = _BASIC) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the least guesses for `value`, and the parts of that cut. Ties go to the part found first.

    Each part beyond a first costs a factor of two, for the place where it is joined; neighbouring brute-force
    characters are one span and pay it once.
    """
    best: list[list[float]] = [[math.inf, math.inf] for _ in range(len(value) + 1)]
    best[0] = [0.0, math.inf]
    back: list[list[tuple[int, int, str] | None]] = [[None, None] for _ in range(len(value) + 1)]
    join = math.log10(2)
    for start, end, kind, cost in parts(value, words):
        brute = int(kind == "brute")
        for before in (0, 1):
            total = best[start][before] + cost + (join if start and not (brute and before) else 0.0)
            if total < best[end][brute]:
                best[end][brute], back[end][brute] = total, (start, before, kind)
    state = int(best[-1][1] < best[-1][0])
    cut, place, cost = [], len(value), best[-1][state]
    while place:
        start, before, kind = back[place][state]
        if cut and kind == "brute" == cut[-1][2] and cut[-1][0] == place:
            cut[-1] = (start, cut[-1][1], kind)
        else:
            cut.append((start, place, kind))
        place, state = start, before
    return cost, cut[::-1]


def guess_cost(value: str, words: Words = _BASIC) -> float:
    return segmentation(value, words)[0]


def spans(text: str, words: Words = _BASIC) -> list[tuple[str, int, int, float]]:
    """(kind, start, end, log10 guesses) by start, then kind as listed; places in code points."""
    found, lower = [], text.lower()
    if any(word in lower for word in _ASSIGN_WORDS):
        for match in _ASSIGN.finditer(text):
            if len(match[2]) >= 6:
                found.append(("assign", match.start(), match.end(), guess_cost(match[2], words)))
    for kind, pattern in (("access", _ACCESS), ("hex", _HEX)):
        found += [(kind, m.start(), m.end(), guess_cost(m[0], words)) for m in pattern.finditer(text)]
    if any(word in lower for word in _CONTEXT_WORDS) and (":" in text or "=" in text or " is " in lower):
        for match in _CONTEXT.finditer(text):
            cost = guess_cost(match[1], words)
            if cost >= GUESS_LOG10:
                found.append(("guess", match.start(1), match.end(1), cost))
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


_ASSIGN = re.compile(ASSIGN, re.ASCII | re.IGNORECASE)
# A maximal run shorter than the bound fails, and no part of it is longer: the bound may stand in the pattern.
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_CONTEXT = re.compile(CONTEXT, re.ASCII | re.IGNORECASE)
# A text without any of these, lower-cased, can't match; looking for them is far cheaper than the patterns.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_CONTEXT_WORDS = ("pass", "pwd", "pin", "secret", "token", "api", "auth", "credential", "login")


def _scan(dictionary: Callable[[], Words]):
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("guess_log10", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary()
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            found = [[dict(zip(("kind", "start", "end", "guess_log10"), x)) for x in spans(t or "", words)] for t in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(found, kind)], ["doc_id", "found"])

    return run


def secret_spans(docs: DataFrame, words: Words | None = None) -> DataFrame:
    """doc_id and the array of (kind, start, end, guess_log10) found in each row's whole text."""
    scan = _scan(arrays.shared(docs.sparkSession, words or load()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text")).mapInArrow(
        scan, "doc_id long, found array<struct<kind: string, start: long, end: long, guess_log10: double>>"
    )


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the hash of the base spans and all spans as text."""
    base = F.filter("found", lambda x: x["kind"] != "guess")
    of = lambda kind: F.size(F.filter("found", lambda x: x["kind"] == kind)).cast("long")
    joined = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id",
        *[of(kind).alias(f"n_{kind}") for kind in KINDS],
        F.sha2(joined(base), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
        F.array_max(F.transform("found", lambda x: x["guess_log10"])).alias("most_guess_log10"),
    )


def _masked(dictionary: Callable[[], Words]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = dictionary()
        for part in arrays.slices(batches, "text", SLICE_BYTES):
            place = part.schema.get_field_index("text")
            texts = [None if t is None else mask(t, words) for t in part.column(place).to_pylist()]
            yield part.set_column(place, part.schema.field(place), pa.array(texts, part.schema.field(place).type))

    return run


def mask(text: str, words: Words = _BASIC) -> str:
    """The text with every span found replaced by its kind in angle brackets; overlapping spans become one."""
    out, done, at = [], 0, 0
    merged: list[list] = []
    for kind, start, end, _ in spans(text, words):
        if merged and start < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], end)
        else:
            merged.append([kind, start, end])
    for kind, start, end in merged:
        out += [text[at:start], f"<{kind}>"]
        at = end
    return "".join([*out, text[at:]])


def masked(docs: DataFrame, words: Words | None = None) -> DataFrame:
    """All rows and columns of `docs`, with the secrets in `text` masked."""
    return docs.mapInArrow(_masked(arrays.shared(docs.sparkSession, words or load())), docs.schema)
