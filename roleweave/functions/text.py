"""Text, date and URL functions over Columns."""

from __future__ import annotations

import json
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace as Python's str.strip()/str.split() see it: Unicode spaces plus the four separators
# U+001C..U+001F, which Java's Unicode \s leaves out.
SPACE = r"[\s\x1c-\x1f]"

SPACES = "".join(c for c in map(chr, range(0x3001)) if c.isspace())

# A Unicode noncharacter marks the places where markup was cut out.
CUT = "\ufdd0"


def strip(col: Column) -> Column:
    """Remove leading and trailing Unicode whitespace."""
    return F.btrim(col, F.lit(SPACES))


def is_blank(col: Column) -> Column:
    """Null, empty or Unicode whitespace only."""
    return strip(F.coalesce(col, F.lit(""))) == ""


def is_empty_description(col: Column) -> Column:
    """Null or nothing but space, tab, LF and CR; narrower than `is_blank` on purpose."""
    return F.btrim(F.coalesce(col, F.lit("")), F.lit(" \t\n\r")) == ""


def lower_ascii(col: Column) -> Column:
    """Fold A-Z only, the case rule of the store's LIKE."""
    return F.translate(col, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def text_or(col: Column, default: str = "") -> Column:
    """Any scalar as text, null as the default."""
    return F.coalesce(col.cast("string"), F.lit(default))


def first_filled(*cols: Column) -> Column:
    """First value that is neither null nor empty; the last one is returned as it is."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols[:-1]], cols[-1])


def joined_or_null(sep: str, *cols: Column) -> Column:
    """Join the non-null parts; nothing left gives null."""
    return F.nullif(F.concat_ws(sep, *cols), F.lit(""))


def name_key(col: Column) -> Column:
    """Key under which two company names count as the same."""
    return F.lower(strip(col))


# ---------------------------------------------------------------- HTML


@lru_cache(maxsize=1)
def _entity_json() -> str:
    return json.dumps({name.rstrip(";"): text for name, text in html5.items()})


@lru_cache(maxsize=1)
def _single_byte_json() -> str:
    # Character references below 256 mean Windows-1252 bytes on the web.
    table = {}
    for code in range(0x80, 0xA0):
        try:
            table[str(code)] = bytes([code]).decode("cp1252")
        except UnicodeDecodeError:
            pass
    return json.dumps(table)


def _code_point(code: Column) -> Column:
    legal = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
    single_byte = F.from_json(F.lit(_single_byte_json()), "map<string,string>")
    from_code = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (
        F.when(code.between(0x80, 0x9F), F.coalesce(F.try_element_at(single_byte, code.cast("string")), from_code))
        .when(legal, from_code)
        .otherwise(F.lit("\ufffd"))
    )


def _decode_piece(piece: Column) -> Column:
    """Decode the reference a piece starts with; pieces begin at an ampersand or hold none."""
    names = F.from_json(F.lit(_entity_json()), "map<string,string>")
    hexa = F.regexp_extract(piece, r"^&#[xX]([0-9a-fA-F]+)", 1)
    digits = F.regexp_extract(piece, r"^&#([0-9]+)", 1)
    name = F.regexp_extract(piece, r"^&([a-zA-Z][-.a-zA-Z0-9]*)", 1)
    rest = F.regexp_replace(piece, r"^&(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][-.a-zA-Z0-9]*);?", "")
    hexa, digits = F.ltrim(hexa, F.lit("0")), F.ltrim(digits, F.lit("0"))
    # Eight or more significant digits lie beyond the last code point in either base.
    from_hex = _code_point(F.when(F.length(hexa) < 8, F.conv(hexa, 16, 10).try_cast("int")).otherwise(F.lit(-1)))
    from_digits = _code_point(F.when(F.length(digits) < 8, digits.try_cast("int")).otherwise(F.lit(-1)))
    known = (
        F.when(name == "lt", F.lit("<"))
        .when(name == "gt", F.lit(">"))
        .when(name == "quot", F.lit('"'))
        .when(name == "nbsp", F.lit("\u00a0"))
        .otherwise(F.try_element_at(names, name))
    )
    return (
        F.when(piece.startswith("&amp;"), F.concat(F.lit("&"), F.substr(piece, F.lit(6))))
        .when(piece.rlike(r"^&#[xX][0-9a-fA-F]"), F.concat(from_hex, rest))
        .when(piece.rlike(r"^&#[0-9]"), F.concat(from_digits, rest))
        .when(piece.rlike(r"^&[a-zA-Z]"), F.concat(F.coalesce(known, F.concat(F.lit("&"), name)), rest))
        .otherwise(piece)
    )


def decode_entities(col: Column) -> Column:
    """Decode named and numeric character references once; `&amp;lt;` becomes `&lt;`."""
    pieces = F.split(col, "(?=&)")
    return F.when(col.contains("&"), F.array_join(F.transform(pieces, _decode_piece), "")).otherwise(col)


def html_to_text(col: Column) -> Column:
    """Visible text of an HTML fragment.

    Comments, declarations and the contents of script, style, template and ruby helper elements go;
    every text run is decoded once and stripped; the runs left are joined by one space. Null and
    empty input give an empty string.
    """
    html = F.coalesce(col, F.lit(""))
    no_comments = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|$)", CUT)
    no_hidden = F.regexp_replace(
        no_comments, r"(?is)<(script|style|template|rt|rp)\b[^>]*>.*?(?:</\1\s*>|$)", CUT
    )
    no_tags = F.regexp_replace(no_hidden, r"""(?s)<[a-zA-Z/!?](?:[^>"']++|"[^"]*+"|'[^']*+'|["'])*+>""", CUT)
    # Decoding run by run binds each run to a variable, so the replacements above happen once.
    runs = F.transform(F.split(no_tags, CUT), lambda run: strip(decode_entities(run)))
    return F.array_join(F.filter(runs, lambda run: run != ""), " ")


# ---------------------------------------------------------------- dates

_CLOCK = r"(?:[01]\d|2[0-3])(?::[0-5]\d(?::[0-5]\d(?:[.,]\d+)?)?)?"
_COMPACT_CLOCK = r"(?:[01]\d|2[0-3])(?:[0-5]\d(?:[0-5]\d(?:[.,]\d+)?)?)?"
_OFFSET = r"(?:Z|[+-](?:[01]\d|2[0-3])(?::?[0-5]\d(?::?[0-5]\d(?:\.\d+)?)?)?)?"


def iso_date(col: Column) -> Column:
    """Calendar date of an ISO-8601 date or timestamp in its own offset; anything else is null."""
    tail = rf"(?:.(?:{_CLOCK}|{_COMPACT_CLOCK}){_OFFSET})?$"
    dashed = F.try_to_date(F.substring(col, 1, 10), "yyyy-MM-dd")
    compact = F.try_to_date(F.substring(col, 1, 8), "yyyyMMdd")
    return F.when(col.rlike(rf"^\d{{4}}-\d\d-\d\d{tail}"), dashed).when(col.rlike(rf"^\d{{8}}{tail}"), compact)


def plain_iso_date(col: Column) -> Column:
    """Date of a string that holds an ISO date and nothing else."""
    return F.when(F.length(col).isin(8, 10), iso_date(col))


def millis_date(col: Column) -> Column:
    """UTC date of epoch milliseconds; null and 0 are null. Counts days, so no session zone matters."""
    days = F.floor(F.nullif(col.try_cast("double"), F.lit(0.0)) / 86_400_000.0)
    in_range = days.between(-719_162, 2_932_896)
    return F.when(in_range, F.date_add(F.lit("1970-01-01").cast("date"), days.try_cast("int")))


# ---------------------------------------------------------------- documents and names


def url_last_segment(col: Column) -> Column:
    """Last path segment of a URL; query, fragment, parameters and trailing slashes are ignored."""
    path = F.regexp_extract(col, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    path = F.regexp_replace(path, r";[^/]*$", "")
    return F.regexp_extract(F.rtrim(path, F.lit("/")), r"([^/]*)$", 1)


def split_sections(col: Column, min_chars: int = 40) -> Column:
    """Markdown sections: cut before H2/H3 header lines, strip, keep those longer than `min_chars`."""
    parts = F.transform(F.split(col, r"(?dmU)^(?=#{2,3}\s)"), strip)
    return F.filter(parts, lambda part: F.char_length(part) > min_chars)


def strip_front_matter(col: Column) -> Column:
    """Drop every `---` block of `key: value` lines that starts a line."""
    return F.regexp_replace(col, r"(?dmU)^---\n(?:\w+: [^\n]+\n)+---\n+", "")


# Fixed value: legal-form words that are not part of a board name.
LEGAL_WORDS = r"inc|incorporated|llc|l\.l\.c|corp|corporation|co|ltd|plc|group|holdings"


def slug_candidates(col: Column) -> Column:
    """Likely board slugs of a company name, sorted and distinct."""
    base = F.regexp_replace(strip(col), "[.,]", "")
    base = strip(F.regexp_replace(base, rf"(?iU)\b(?:{LEGAL_WORDS})\b\.?", ""))
    base = F.regexp_replace(F.regexp_replace(base, "&", "and"), "[^A-Za-z0-9 -]", "")
    words = F.filter(F.split(base, " +"), lambda word: word != "")
    raw = F.lower(F.regexp_replace(col, rf"(?U){SPACE}+", ""))
    slugs = F.array(F.lower(F.array_join(words, "")), F.lower(F.array_join(words, "-")), raw)
    return F.array_sort(F.array_distinct(F.filter(slugs, lambda slug: slug != "")))


def labelled_paragraphs(col: Column, labels: str) -> Column:
    """Keep the paragraphs whose first line matches the label pattern, joined by a blank line.

    A paragraph runs to the next blank line; one that is only a heading also claims the paragraph
    after it. Works on an array in the row, so nothing is exploded or regrouped.
    """
    parts = F.split(col, r"\n{2,}")
    heading = rf"(?iU)^{SPACE}*(?:[#*]+\s*)?(?:{labels})\b"
    lone = rf"(?iU)^{SPACE}*(?:[#*]+\s*)?(?:{labels})[\s:*]*$"

    def keep(part: Column, i: Column) -> Column:
        before = F.try_element_at(parts, i)  # one-based, so i names the part before
        return part.rlike(heading) | ((i > 0) & F.coalesce(before.rlike(lone), F.lit(False)))

    return F.array_join(F.filter(parts, keep), "\n\n")
