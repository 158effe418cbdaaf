from __future__ import annotations

import re
from datetime import date
from html.parser import HTMLParser

import pytest
from conftest import SMALL
from pyspark.sql import functions as F

from roleweave.functions import text


@pytest.mark.parametrize(
    "html, expected",
    [
        (None, ""),
        ("", ""),
        ("<p>We need <b>NGS</b> skills.</p>", "We need NGS skills."),
        ("a<!-- hidden <b>x</b> -->b", "a b"),
        ("<style>p{}</style><script>var t='</p>';</script>x", "x"),
        ("<p>&lt;b&gt;kept&lt;/b&gt;</p>", "<b>kept</b>"),
        ("&amp;lt;p&amp;gt;", "&lt;p&gt;"),
        ("<p>&nbsp; spaced </p>", "spaced"),
        ("&#8217;&#x1F600;&#150;&#0;", "’\U0001f600–�"),
        ("&eacute;t&eacute; &copy 2024 &notaname; a&b", "été © 2024 &notaname a&b"),
        ('<a title="1 > 0" href=x>link</a>', "link"),
        ("1 < 2 and 3 > 2", "1 < 2 and 3 > 2"),
        ("<!DOCTYPE html><template>no</template><p> </p>yes", "yes"),
    ],
)
def test_html_to_text(one, html, expected):
    assert one(text.html_to_text, "x string", html) == expected


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.runs, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")
        self.runs.append(None)

    def handle_endtag(self, tag):
        self.hidden -= tag in ("script", "style")
        self.runs.append(None)

    def handle_data(self, data):
        if not self.hidden:
            self.runs.append(data)


def test_html_matches_a_parser_on_all_pages(spark):
    pages = spark.read.parquet(f"{SMALL}/pages.parquet").select("html", text.html_to_text(F.col("html")).alias("t"))
    for row in pages.collect():
        reader = _Reader()
        reader.feed(row.html)
        reader.close()
        merged = [""]
        for run in reader.runs:
            if run is None:
                merged.append("")
            else:
                merged[-1] += run
        assert row.t == " ".join(r.strip() for r in merged if r.strip())


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2026-06-20T23:30:00-05:00", date(2026, 6, 20)),
        ("2026-06-20T10:00:00Z", date(2026, 6, 20)),
        ("2026-06-20T10:00:00.123Z", date(2026, 6, 20)),
        ("2026-06-20", date(2026, 6, 20)),
        ("20260620T1000", date(2026, 6, 20)),
        ("2026-02-30", None),
        ("2026-06-20T25:00:00", None),
        ("yesterday", None),
        ("", None),
        (None, None),
    ],
)
def test_iso_date(one, value, expected):
    assert one(text.iso_date, "x string", value) == expected


def test_plain_iso_date(one):
    assert one(text.plain_iso_date, "x string", "2026-06-20") == date(2026, 6, 20)
    assert one(text.plain_iso_date, "x string", "2026-06-20T00:00:00") is None


@pytest.mark.parametrize(
    "value, expected",
    [(1718841600000, date(2024, 6, 20)), (1718927999999, date(2024, 6, 20)), (-1, date(1969, 12, 31)), (0, None), (None, None), (10**18, None)],
)
def test_millis_date(one, value, expected):
    assert one(text.millis_date, "x bigint", value) == expected


@pytest.mark.parametrize(
    "url, expected",
    [
        ("https://linkedin.com/jobs/view/123/?trk=a#x", "123"),
        ("https://linkedin.com/jobs/view/123;v=1", "123"),
        ("https://linkedin.com", ""),
        ("/a/b//", "b"),
    ],
)
def test_url_last_segment(one, url, expected):
    assert one(text.url_last_segment, "x string", url) == expected


def test_split_sections_keeps_headers_and_drops_short_ones(one):
    long = "padding text that is clearly longer than forty characters"
    md = f"Preamble {long}\n## Kept\n{long}\n## Tiny\nshort\n### Nested\n{long}\n#### Not a cut {long}"
    parts = one(text.split_sections, "x string", md)
    assert [p.split("\n")[0].split(" padding")[0] for p in parts] == ["Preamble", "## Kept", "### Nested"]
    expected = [p.strip() for p in re.split(r"^(?=#{2,3}\s)", md, flags=re.MULTILINE) if len(p.strip()) > 40]
    assert parts == expected


def test_strip_front_matter(one):
    assert one(text.strip_front_matter, "x string", "---\ntitle: A b\nurl: c\n---\n\nBody\n---\nnot a header\n---\n") == (
        "Body\n---\nnot a header\n---\n"
    )


@pytest.mark.parametrize(
    "name, expected",
    [
        ("10x Genomics, Inc.", ["10x-genomics", "10xgenomics", "10xgenomics,inc."]),
        ("Smith & Sons Co", ["smith&sonsco", "smith-and-sons", "smithandsons"]),
        ("Míco Labs", ["mco-labs", "mcolabs", "mícolabs"]),
        ("Inc.", ["inc."]),
        ("  ", []),
    ],
)
def test_slug_candidates(one, name, expected):
    assert one(text.slug_candidates, "x string", name) == sorted(expected)


def test_blank_and_empty_differ(one):
    assert one(text.is_empty_description, "x string", " \t\r\n") is True
    assert one(text.is_empty_description, "x string", " ") is False
    assert one(text.is_blank, "x string", "  \x1c") is True
    assert one(text.is_blank, "x string", None) is True


def test_joined_or_null_and_first_filled(spark):
    df = spark.createDataFrame([("Boston", "MA"), ("Boston", None), (None, None), ("", "MA")], "a string, b string")
    rows = df.select(
        text.joined_or_null(", ", F.col("a"), F.col("b")).alias("j"), text.first_filled(F.col("a"), F.col("b")).alias("f")
    ).collect()
    assert [r.j for r in rows] == ["Boston, MA", "Boston", None, ", MA"]
    assert [r.f for r in rows] == ["Boston", "Boston", None, "MA"]


def test_labelled_paragraphs(one):
    body = "About us\n\nWe are nice.\n\nRequirements:\n\nPython, SQL\n\nBenefits\n\nResponsibilities include pipelines"
    kept = one(lambda c: text.labelled_paragraphs(c, "requirements|responsibilities"), "x string", body)
    assert kept == "Requirements:\n\nPython, SQL\n\nResponsibilities include pipelines"
