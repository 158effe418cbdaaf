from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from roleweave.functions.classify import RelevanceRules, any_word, relevance, remote_flag

RULES = RelevanceRules(include=("geology", "GIS"), exclude=("truck driving",), off_topic_titles=("retail",))


def flag(spark, rules, title, description=None):
    df = spark.createDataFrame([(title, description)], "t string, d string")
    return df.select(relevance(rules, F.col("t"), F.col("d")).alias("r")).first().r


@pytest.mark.parametrize(
    "title, description, expected",
    [
        ("Head of Geology", "", True),
        ("Baker", "bread and cake", False),
        ("Truck driving in Geology", "", False),
        ("Analyst", "You draw GIS maps all day", True),
        ("Retail helper", "GIS is a plus", False),
        ("Geology teacher", "Retail and other shops nearby", True),
        ("Started savings", "savings only", False),
        ("Analyst", "truck\ndriving of GIS", True),
        ("Clerk, truck", "driving level GIS", False),  # the exclusion spans both fields
        (None, "GIS", True),
        (None, None, False),
    ],
)
def test_relevance(spark, title, description, expected):
    assert flag(spark, RULES, title, description) is expected


def test_match_fields(spark):
    title_only = RelevanceRules(include=("GIS",), exclude=(), off_topic_titles=(), match_fields=("title",))
    assert flag(spark, title_only, "Scientist", "GIS") is False
    text_only = RelevanceRules(include=("GIS",), exclude=(), off_topic_titles=("retail",), match_fields=("description",))
    assert flag(spark, text_only, "GIS Retail", "nothing") is False
    assert flag(spark, text_only, "Retail", "GIS") is True
    with pytest.raises(ValueError):
        RelevanceRules(match_fields=("company",))


def test_case_and_unicode(spark):
    df = spark.createDataFrame([("ÉTAT de l'art",), ("Salesforce",), ("Sales Manager",)], "t string")
    hits = df.select(any_word(F.col("t"), ("état", "sales")).alias("h")).collect()
    assert [r.h for r in hits] == [True, False, True]
    strict = df.select(any_word(F.col("t"), ("sales",), case_sensitive=True).alias("h")).collect()
    assert not any(r.h for r in strict)
    assert df.select(any_word(F.col("t"), ()).alias("h")).first().h is False


def test_default_rules_cover_plurals(spark):
    rules = RelevanceRules()
    assert flag(spark, rules, "Computational Biologists") is True
    assert flag(spark, rules, "Bioinformatician") is True
    assert flag(spark, rules, "Data Engineer", "fusion-detection with Nextflow") is True


def test_rules_from_yaml(tmp_path):
    path = tmp_path / "keywords.yaml"
    path.write_text("include: [GIS]\ncase_sensitive: true\n")
    rules = RelevanceRules.from_yaml(path)
    assert rules.include == ("GIS",) and rules.exclude == () and rules.case_sensitive
    assert rules.match_fields == ("title", "description")


@pytest.mark.parametrize(
    "location, extra, expected",
    [
        ("Remote", "{}", 1),
        ("Remote, anywhere", None, 1),
        ("Lyon", "{}", 0),
        ("Remoteville", "{}", 0),
        ("Hybrid, Lyon", "{}", 0),
        ("Hybrid with remote days", "{}", 0),
        (None, "{}", None),
        ("", "{}", None),
        ("    ", "{}", None),
        ("Lyon", '{"is_remote": true}', 1),
        ("Remote", '{"is_remote": false}', 0),
        ("Remote", '{"is_remote": null}', 1),
        (None, '{"is_remote": 1}', 1),
        (None, '{"is_remote": 0}', 0),
        (None, '{"is_remote": "no"}', 1),
        (None, '{"is_remote": "false"}', 1),
        (None, '{"is_remote": ""}', 0),
        ("Remote", '{"other": true}', 1),
    ],
)
def test_remote_flag(spark, location, extra, expected):
    df = spark.createDataFrame([(location, extra)], "l string, e string")
    assert df.select(remote_flag(F.col("l"), F.col("e")).alias("r")).first().r == expected


def test_numbered_groups_stay_with_their_fragment(one):
    from roleweave.functions.classify import any_word

    match = lambda *fragments: lambda text: any_word(text, fragments)
    assert one(match("(b)ar", r"(foo) \1"), "x string", "so foo foo it is")
    assert not one(match("(b)ar", r"(foo) \1"), "x string", "foo bat")
    assert one(match(r"(?:x)[(]?(y)", r"(?P<n>z)(?P=n)", r"(a|b)\1c"), "x string", "bbc")


def test_named_groups_stay_with_their_fragment(one):
    """A name may be used in several fragments, and may have an underscore."""
    fragments = [r"(?P<n>a)(?P=n)", r"(?P<n>b)(?P=n)", r"(?P<my_name>c+)-(?P=my_name)"]
    for text, expected in (("aa", True), ("bb", True), ("ab", False), ("cc-cc", True), ("cc-c", False)):
        assert one(lambda x: any_word(x, fragments), "x string", text) is expected, text
