from __future__ import annotations

import math

import pytest
from corpus_fixtures import docs, edge_rows  # noqa: F401

from roleweave.llm import urls

URLS = [
    ("https://Blog.Example.NET/en/x?q=/de/", "blog.example.net", "/en/x", "example.net/en/", "allow"),
    ("https://example.net/fr/x", "example.net", "/fr/x", "net/", "block"),
    ("http://example.net", "example.net", "", None, None),
    ("ftp://a.example.com/de/1#t", "a.example.com", "/de/1", "example.com/de/", "block"),
    ("x://xexample.com/de/", "xexample.com", "/de/", None, None),
    ("https://example.org?x=/fr/", "example.org", "", None, None),
    ("https://a.org/fr/b://c", "a.org", "/fr/b://c", "org/fr/", "allow"),
    ("no scheme.net/", "", "", None, None),
    ("É://ÀB.Net/a\nb?c", "Àb.net", "/a\nb", "net/", "block"),
    ("http://net/", "net", "/", "net/", "block"),
    (None, "", "", None, None),
    ("", "", "", None, None),
]


@pytest.fixture(scope="module")
def model(spark):
    return urls.fit(urls.labelled_urls(spark))


def pages(spark, rows):
    from pyspark.sql import functions as F

    table = spark.createDataFrame(rows, "page_id long, url string, html string")
    return table.withColumns({name: F.lit("x") for name in ("host", "path", "rule", "_vector", "_grams", "probability")})


def test_parts_and_rules(spark, model):
    table = pages(spark, [(i, u[0], None) for i, u in enumerate(URLS)])
    out = {r.page_id: r for r in urls.judge(table, model).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(URLS):
        assert (out[i].host, out[i].path, out[i].rule) == (host, path, rule)
        assert out[i].verdict == (verdict or ("block" if out[i].junk_probability >= urls.BLOCK_FROM else "allow"))


def test_probability_is_the_models_sum(spark, model):
    from pyspark.sql import functions as F

    row = urls.features(spark.createDataFrame([("cheap-pills.example.com", "/en/1")], "host string, path string")).select("_grams", "_vector").first()
    grams = {f"{m}:{t[i:i + n]}" for m, t in (("h", "^cheap-pills.example.com$"), ("p", "^/en/1$")) for n in urls.GRAMS for i in range(len(t) - n + 1)}
    assert set(row._grams) == grams
    logit = model.intercept + sum(model.coefficients[int(i)] for i in row._vector.indices)
    table = pages(spark, [(1, "http://cheap-pills.example.com/en/1", "")]).withColumn("page_id", F.lit(1))
    assert urls.judge(table, model).first().junk_probability == pytest.approx(1 / (1 + math.exp(-logit)))


def test_held_out_names(spark, model):
    junk = ["cheap-loans", "casino-pills", "free-casino", "spam-links", "poker-bets"]
    fair = ["weather-station", "theatre-news", "riverbank", "mathschool", "nation"]
    rows = [(i, f"https://www.{h}.example.com/en/{i}", "") for i, h in enumerate(junk + fair)]
    verdicts = [r.verdict for r in urls.judge(pages(spark, rows), model).orderBy("page_id").collect()]
    assert verdicts.count("block") >= 4 and verdicts[: len(junk)].count("block") >= 4 and "block" not in verdicts[len(junk) :]


def test_no_python_in_the_plan(spark, model):
    from conftest import SMALL, plan_of

    assert urls.judge(pages(spark, []), model).count() == 0
    plan = plan_of(urls.judge(spark.read.parquet(f"{SMALL}/pages.parquet"), model))
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "Exchange"))


def test_path_only_junk(spark, model):
    """Held-out ordinary hosts: junk paths are blocked, ordinary ones aren't."""
    hosts = ["riverbank.example.com", "www.mathschool.example.org", "weather-station.example.com", "astronomy.example.org"]
    junk = ["/casino-welcome/1", "/cheap-pills/en/12.html", "/poker-bets/77", "/de/free-casino/3"]
    fair = ["/en/51", "/archive/2020/river.html", "/de/77.html", "/articles/gardens/3"]
    rows = [(i, f"https://{h}{p}", "") for i, (h, p) in enumerate((h, p) for h in hosts for p in junk + fair)]
    verdicts = {p: set() for p in junk + fair}
    for r in urls.judge(pages(spark, rows), model, rules=()).collect():
        verdicts[r.path].add(r.verdict)
    assert all(verdicts[p] == {"block"} for p in junk) and all(verdicts[p] == {"allow"} for p in fair)


def test_junk_hosts_that_the_table_does_not_hold(spark, model):
    junk = ["casino-win", "cheap-pills", "bets-live", "poker-casino", "loans-fast-cash"]
    fair = ["lighthouse", "botany", "orchestra", "townhall", "geology"]
    assert not set(junk + fair) & {*urls.JUNK_HOSTS, *urls.FAIR_HOSTS}
    rows = [(i, f"https://{h}.example.org/en/{i}", "") for i, h in enumerate(junk + fair)]
    found = [r.verdict for r in urls.judge(pages(spark, rows), model, rules=()).orderBy("page_id").collect()]
    assert found == ["block"] * len(junk) + ["allow"] * len(fair)
