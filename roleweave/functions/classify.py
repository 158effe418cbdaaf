"""Relevance and remote-work classification as Column expressions."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from pathlib import Path

from pyspark.sql import Column
from pyspark.sql import functions as F

from roleweave.functions.text import is_blank
from roleweave.vocabulary import EXCLUDE, INCLUDE, OFF_TOPIC_TITLES

FIELDS = ("title", "description")


@dataclass(frozen=True)
class RelevanceRules:
    """Regex fragments that decide relevance; each matches whole words only."""

    include: Sequence[str] = INCLUDE
    exclude: Sequence[str] = EXCLUDE
    off_topic_titles: Sequence[str] = OFF_TOPIC_TITLES
    match_fields: Sequence[str] = FIELDS
    case_sensitive: bool = False

    def __post_init__(self) -> None:
        unknown = [f for f in self.match_fields if f not in FIELDS]
        if unknown:
            raise ValueError(f"unknown match field(s): {', '.join(unknown)}")

    @classmethod
    def from_yaml(cls, path: str | Path) -> RelevanceRules:
        import yaml

        raw = yaml.safe_load(Path(path).read_text()) or {}
        return cls(
            include=tuple(raw.get("include") or ()),
            exclude=tuple(raw.get("exclude") or ()),
            off_topic_titles=tuple(raw.get("off_topic_titles") or ()),
            match_fields=tuple(raw.get("match_fields", FIELDS)),
            case_sensitive=bool(raw.get("case_sensitive", False)),
        )


def _java_fragment(fragment: str, number: int) -> str:
    """Named groups in Java's writing. Every fragment has names of its own, as all of them become one pattern.

    Java's names have no underscores, so a group is called by the numbers of its fragment and of its name there.
    """
    names = list(dict.fromkeys(re.findall(r"\(\?P<(\w+)>", fragment)))
    called = {name: f"f{number}g{i}" for i, name in enumerate(names)}
    opened = re.sub(r"\(\?P<(\w+)>", lambda m: f"(?<{called[m[1]]}>", fragment)
    return re.sub(r"\(\?P=(\w+)\)", lambda m: f"\\k<{called.get(m[1], m[1])}>", opened)


def _groups(fragment: str) -> int:
    """How many capturing groups a fragment opens."""
    bare = re.sub(r"\\.|\[\^?\]?(?:\\.|[^\]\\])*\]", "", fragment)
    return len(re.findall(r"\((?!\?)|\(\?P?<(?![=!])", bare))


def _renumbered(fragments: Sequence[str]) -> list[str]:
    """Numbered back-references shifted by the groups of the fragments before, as all become one pattern."""
    out, before = [], 0
    for fragment in fragments:
        shift = before
        # A character class and an escaped character stay as they are.
        pieces = re.findall(r"\[\^?\]?(?:\\.|[^\]\\])*\]|\\[1-9]\d?|\\.|[^\\\[]+|\[", fragment, re.S)
        shifted = (f"\\{int(p[1:]) + shift}(?:)" if re.fullmatch(r"\\[1-9]\d?", p) else p for p in pieces)
        out.append("".join(shifted) if shift else fragment)
        before += _groups(fragment)
    return out


def _first_letters(fragments: Sequence[str]) -> str:
    """Look-ahead for the first letters of the fragments; empty when one may start otherwise.

    Most word starts fail this one test, where they would fail every fragment in turn.
    """
    plain = [f for f in fragments if re.match(r"[A-Za-z](?![?*{|])", f) and "|" not in re.sub(r"\([^()]*\)", "", f)]
    return f"(?=[{''.join(sorted({f[0].lower() for f in plain}))}])" if len(plain) == len(fragments) else ""


def any_word(text: Column, fragments: Sequence[str], case_sensitive: bool = False) -> Column:
    """True when any fragment occurs in the text as whole words; one scan for the whole list."""
    if not fragments:
        return F.lit(False)
    flags, start = ("(?U)", "") if case_sensitive else ("(?iU)", _first_letters(fragments))
    return text.rlike(rf"{flags}\b{start}(?:{'|'.join(_java_fragment(f, i) for i, f in enumerate(_renumbered(fragments)))})\b")


def relevance(rules: RelevanceRules, title: Column, description: Column) -> Column:
    """Relevance flag: exclusions first, then the title, then the description as fallback."""
    filled = {"title": F.coalesce(title, F.lit("")), "description": F.coalesce(description, F.lit(""))}
    # Exclusions see the fields joined, so a phrase may cross from title to description.
    joined = F.concat_ws(" ", *[filled[f] for f in rules.match_fields])
    heading = filled["title"] if "title" in rules.match_fields else F.lit("")

    def hit(text: Column, fragments: Sequence[str]) -> Column:
        return any_word(text, fragments, rules.case_sensitive)

    fallback = hit(filled["description"], rules.include) if "description" in rules.match_fields else F.lit(False)
    return (
        F.when(hit(joined, rules.exclude), F.lit(False))
        .when(hit(heading, rules.include), F.lit(True))
        .when(hit(heading, rules.off_topic_titles), F.lit(False))
        .otherwise(fallback)
    )


def remote_flag(location: Column, extra_json: Column) -> Column:
    """1 remote, 0 on site, null no signal.

    An explicit flag from the feed wins, by its truth value; otherwise the location text decides and
    hybrid counts as on site.
    """
    # As VARIANT, so that the text "false" and the value false stay apart.
    stated = F.to_json(F.try_variant_get(F.try_parse_json(extra_json), "$.is_remote", "variant"))
    falsy = stated.isin("false", "0", "0.0", '""', "[]", "{}")
    place = F.coalesce(location, F.lit(""))
    return (
        F.when(stated != "null", F.when(falsy, 0).otherwise(1))
        .when(is_blank(place), F.lit(None))
        .when(place.rlike(r"(?iU)\bhybrid\b"), 0)
        .when(place.rlike(r"(?iU)\bremote\b"), 1)
        .otherwise(0)
        .cast("int")
    )
