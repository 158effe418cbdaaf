"""Rank correlation and column statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roleweave.operators.ordering import with_average_rank


def spearman(df: DataFrame, actual: str, predicted: str, unique: str, groups: Sequence[str] = ()) -> DataFrame:
    """Spearman correlation, per group if asked: (groups..., spearman).

    0 when there is no rank signal: no rows, a null or NaN on either side, or a side that holds one
    value only (compared exactly, not by its deviation).
    """
    pairs = df.select(
        *groups, unique, F.col(actual).cast("double").alias("_a"), F.col(predicted).cast("double").alias("_p")
    )
    ranked = with_average_rank(pairs, "_a", unique, "_ra", groups)
    ranked = with_average_rank(ranked, "_p", unique, "_rp", groups, staged=True)
    missing = F.col("_a").isNull() | F.col("_p").isNull() | F.isnan("_a") | F.isnan("_p")
    flat = (F.min("_a") == F.max("_a")) | (F.min("_p") == F.max("_p"))
    stats = ranked.groupBy(*groups).agg(
        # Spelled out, because the built-in raises on a side without spread.
        F.try_divide(F.covar_pop("_ra", "_rp"), F.stddev_pop("_ra") * F.stddev_pop("_rp")).alias("_r"),
        (F.coalesce(F.bool_or(missing), F.lit(True)) | F.coalesce(flat, F.lit(True))).alias("_silent"),
    )
    value = F.when(F.col("_silent") | F.isnan("_r"), 0.0).otherwise(F.coalesce("_r", F.lit(0.0)))
    return stats.select(*groups, value.alias("spearman"))


def zero_shot(df: DataFrame, actual: str, unique: str, columns: Sequence[str]) -> DataFrame:
    """(feature, spearman): rank correlation of each column alone with the score, ranked in one pass."""
    pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("value")) for c in columns])
    long = df.select(unique, actual, F.explode(pairs).alias("p")).select(unique, actual, "p.*")
    return spearman(long, actual, "value", unique, ("feature",))


def column_stats(df: DataFrame, vector: str) -> DataFrame:
    """(dim, mean, scale) of every element of an array column; population deviation, constant ones 1."""
    metrics = Summarizer.metrics("mean", "variance", "min", "max", "count")
    s = df.filter(F.col(vector).isNotNull()).agg(metrics.summary(array_to_vector(vector)).alias("s"))
    wide = s.select(
        F.posexplode(
            F.arrays_zip(*[vector_to_array(f"s.{m}").alias(m) for m in ("mean", "variance", "min", "max")])
        ).alias("dim", "m"),
        F.col("s.count").alias("n"),
    )
    # Sample variance to population deviation.
    deviation = F.sqrt(F.col("m.variance") * (F.col("n") - 1) / F.col("n"))
    return wide.select(
        "dim", F.col("m.mean").alias("mean"), F.when(F.col("m.min") == F.col("m.max"), 1.0).otherwise(deviation).alias("scale")
    )


def residuals(df: DataFrame, actual: str = "score", predicted: str = "prediction") -> DataFrame:
    """Add prediction minus score."""
    return df.withColumn("pred_vs_score", F.col(predicted) - F.col(actual))


def comparison(results: DataFrame, families: Sequence[str]) -> DataFrame:
    """(model, family, spearman) rows as one row per model and one column per family; gaps are NaN."""
    table = results.groupBy("model").pivot("family", list(families)).agg(F.first("spearman"))
    return table.select("model", *[F.coalesce(F.col(f"`{f}`"), F.lit(float("nan"))).alias(f) for f in families])
