from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from roleweave.operators.correlation import column_stats, comparison, residuals, spearman
from roleweave.operators.ordering import SLICE, _sliced, with_average_rank, with_next, with_position


def average_ranks(values):
    order = sorted(values)
    return [(order.index(v) + 1 + len(order) - order[::-1].index(v)) / 2 for v in values]


def pearson(a, b):
    return float(np.corrcoef(a, b)[0, 1])


@pytest.fixture(scope="module", autouse=True)
def many_slices(spark):
    """Small inputs would be merged into one slice."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one value, which must span several slices."""
    rng = random.Random(1)
    rows = [(i, 5.0 if i % 3 == 0 else float(rng.randint(0, 40)), float(rng.randint(0, 9))) for i in range(900)]
    return rows, spark.createDataFrame(rows, "id bigint, v double, w double")


def test_hot_value_is_spread(skewed):
    _, df = skewed
    sizes = [r["count"] for r in _sliced(df, [F.col("v"), F.col("id")]).groupBy(SLICE).count().collect()]
    assert len(sizes) == 4 and max(sizes) < 300  # the hot value alone has 300 rows or more


def test_positions(skewed):
    rows, df = skewed
    found = {r.id: r.position for r in with_position(df, [F.col("v"), F.col("id")]).collect()}
    expected = {r[0]: i + 1 for i, r in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert found == expected


def test_next(skewed):
    rows, df = skewed
    found = {r.id: r.n for r in with_next(df, [-F.col("v"), F.col("id")], "id", "n").collect()}
    order = [r[0] for r in sorted(rows, key=lambda r: (-r[1], r[0]))]
    assert found == dict(zip(order, order[1:] + [None]))


def test_average_rank_with_ties_across_slices(skewed):
    rows, df = skewed
    found = {r.id: r.rank for r in with_average_rank(df, "v", "id", "rank").collect()}
    assert found == dict(zip((r[0] for r in rows), average_ranks([r[1] for r in rows])))


def test_empty_input(spark):
    none = spark.createDataFrame([], "id bigint, v double")
    assert with_position(none, [F.col("v"), F.col("id")]).count() == 0
    assert with_next(none, [F.col("v"), F.col("id")], "id", "n").count() == 0
    assert with_average_rank(none, "v", "id", "rank").count() == 0


def test_spearman_matches_ranks(skewed):
    rows, df = skewed
    expected = pearson(average_ranks([r[1] for r in rows]), average_ranks([r[2] for r in rows]))
    assert spearman(df, "v", "w", "id").first().spearman == pytest.approx(expected, abs=1e-12)


def test_spearman_by_group(skewed):
    rows, df = skewed
    found = {r.g: r.spearman for r in spearman(df.withColumn("g", F.col("id") % 4), "v", "w", "id", ("g",)).collect()}
    for g in range(4):
        part = [r for r in rows if r[0] % 4 == g]
        expected = pearson(average_ranks([r[1] for r in part]), average_ranks([r[2] for r in part]))
        assert found[g] == pytest.approx(expected, abs=1e-9)


@pytest.mark.parametrize(
    "pairs",
    [
        [],
        [(1.0, 3.0), (2.0, 3.0), (3.0, 3.0)],
        [(55.3, 1.0), (55.3, 2.0)],
        [(1.0, float("nan")), (2.0, 1.0)],
        [(float("nan"), float("nan")), (float("nan"), float("nan"))],
        [(1.0, 1.0)],
    ],
)
def test_no_rank_signal_is_zero(spark, pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "id bigint, a double, b double")
    assert spearman(df, "a", "b", "id").first().spearman == 0.0


def test_column_stats_use_population_deviation(spark):
    df = spark.createDataFrame([([1.0, 7.0],), ([3.0, 7.0],)], "v array<double>")
    rows = column_stats(df, "v").orderBy("dim").collect()
    assert [(r.mean, r.scale) for r in rows] == [(2.0, 1.0), (7.0, 1.0)]


def test_comparison_and_residuals(spark):
    results = spark.createDataFrame(
        [("ridge", "bow", 0.5), ("ridge", "emb", 0.6), ("gbt", "bow", 0.4)], "model string, family string, spearman double"
    )
    table = {r.model: (r.bow, r.emb) for r in comparison(results, ("bow", "emb")).collect()}
    assert table["ridge"] == (0.5, 0.6)
    assert table["gbt"][0] == 0.4 and table["gbt"][1] != table["gbt"][1]
    assert residuals(spark.createDataFrame([(80.0, 75.0)], "score double, prediction double")).first().pred_vs_score == -5.0


def test_positions_need_one_shuffle(spark):
    from conftest import plan_of
    from roleweave.operators.ordering import numbered_in_order

    plan = plan_of(numbered_in_order(spark.range(1000), [F.col("id")]))
    assert plan.count("Exchange\n") + plan.count("Exchange (") <= 3 and "Window" not in plan
    assert len({line for line in plan.split("\n") if "Exchange" in line and line.startswith("(")}) == 1


def test_slices_follow_the_data(spark, monkeypatch):
    """Inputs beyond what the session's partitions should hold get more slices, and the same positions."""
    from roleweave.operators import ordering
    from roleweave.session import stage

    rows = stage(spark.range(20_000).withColumn("k", F.pmod(F.xxhash64("id"), F.lit(7))), "rows")
    expected = {r.id: r.position for r in ordering.with_position(rows, [F.col("k"), F.col("id")], staged=True).collect()}
    monkeypatch.setattr(ordering, "SLICE_ROWS", 500)
    assert ordering._ranged(rows, [F.col("k"), F.col("id")]).rdd.getNumPartitions() > 20
    assert {r.id: r.position for r in ordering.with_position(rows, [F.col("k"), F.col("id")], staged=True).collect()} == expected
