"""Similarity of postings to a reference profile, and the feature layout built from it."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roleweave.session import stage

TOP = 3
SIMS = "array<struct<sim: double, section: bigint>>"
# Section vectors shipped to the workers in one go.
BLOCK_BYTES = 64 << 20
# Similarities held at once in a task.
SCORE_BYTES = 32 << 20


# The functions below are shipped to the workers by value and refer to nothing of this package, so
# the workers need not have it installed.


def _top_sections(block: np.ndarray, ids: np.ndarray) -> Callable[[Column], Column]:
    """UDF: the best sections of one block, best first, as (sim, section)."""
    k = min(TOP, len(block))
    step = max(1, SCORE_BYTES // 8 // max(1, len(block)))

    def best_of(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        scores = rows @ block.T
        # All that reach the k-th best value are candidates; the block is in order of section ids,
        # so a stable sort of these few settles ties by id.
        least = np.partition(scores, -k, axis=1)[:, -k]
        sims, sections = np.empty((len(rows), k)), np.empty((len(rows), k), dtype=np.int64)
        for i in range(len(rows)):
            reach = np.flatnonzero(scores[i] >= least[i])
            best = reach[np.argsort(-scores[i][reach], kind="stable")[:k]]
            sims[i], sections[i] = scores[i][best], ids[best]
        return sims, sections

    @F.arrow_udf(SIMS)
    def top(vectors: pa.Array) -> pa.Array:
        filled = vectors.is_valid().to_numpy(zero_copy_only=False)
        n = int(filled.sum())
        sims, sections = np.empty((0, k)), np.empty((0, k), dtype=np.int64)
        if n:
            flat = vectors.drop_null().flatten().to_numpy(zero_copy_only=False)
            rows = flat.astype(np.float64).reshape(n, -1)
            parts = [best_of(rows[i : i + step]) for i in range(0, n, step)]
            sims, sections = (np.concatenate(x) for x in zip(*parts))
        values = pa.StructArray.from_arrays(
            [pa.array(sims.ravel()), pa.array(sections.ravel())], names=["sim", "section"]
        )
        offsets = np.concatenate([[0], np.cumsum(filled * k)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), values, mask=pa.array(~filled))

    return top


def _dot(vector: np.ndarray) -> Callable[[Column], Column]:
    """UDF: dot product with one vector."""

    @F.arrow_udf("double")
    def dot(vectors: pa.Array) -> pa.Array:
        filled = vectors.is_valid().to_numpy(zero_copy_only=False)
        out = np.zeros(len(vectors))
        if filled.any():
            flat = vectors.drop_null().flatten().to_numpy(zero_copy_only=False)
            out[filled] = flat.astype(np.float64).reshape(int(filled.sum()), -1) @ vector
        return pa.array(out, mask=~filled)

    return dot


def _best_first(x: Column, y: Column) -> Column:
    return (
        F.when(x["sim"] > y["sim"], -1)
        .when(x["sim"] < y["sim"], 1)
        .when(x["section"] < y["section"], -1)
        .when(x["section"] > y["section"], 1)
        .otherwise(0)
    )


def top_section_sims(postings: DataFrame, sections: DataFrame, vector: str = "embedding") -> DataFrame:
    """Add `top_sims`: the three most similar sections of every row, best first.

    `sections` (section_id, vector) is a profile document, small by nature; its size is still
    measured. Up to `BLOCK_BYTES` it travels to the workers once and the postings are not moved at
    all. A larger profile is cut by hash into blocks of that size, one pass per block, and the best
    three of all blocks are exact.
    """
    size = sections.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("vector")), F.lit(1)).alias("dims")
    ).first()
    blocks = max(1, -(-size.n * size.dims * 8 // BLOCK_BYTES))
    none = F.expr(f"cast(array() as {SIMS})")
    out = postings.withColumn("top_sims", none)
    keyed = sections.withColumn("_block", F.pmod(F.xxhash64("section_id"), F.lit(blocks)))
    for b in range(blocks):
        rows = keyed.filter(F.col("_block") == b).select("section_id", "vector").orderBy("section_id").collect()
        if not rows:
            continue
        block = np.array([r.vector for r in rows], dtype=np.float64)
        found = _top_sections(block, np.array([r.section_id for r in rows], dtype=np.int64))(F.col(vector))
        if blocks == 1:
            return postings.withColumn("top_sims", found)
        both = F.array_sort(F.concat("top_sims", F.coalesce(found, none)), _best_first)
        out = stage(out.withColumn("top_sims", F.slice(both, 1, TOP)), "sims")
    return out


def fit_features(
    postings: DataFrame, sections: DataFrame, resume: DataFrame, vector: str = "embedding"
) -> DataFrame:
    """Add fit_max, fit_top3 (mean of what exists of the best three) and resume_cos.

    Vectors are L2-normalized, so a dot product is the cosine.
    """
    whole = resume.select("vector").first()
    if whole is None or sections.isEmpty():
        raise ValueError("the profile needs a resume and at least one section")
    resume_vector = np.array(whole.vector, dtype=np.float64)
    sims = F.transform("top_sims", lambda s: s["sim"])
    mean = F.aggregate(sims, F.lit(0.0), lambda a, s: a + s) / F.size(sims)
    return (
        top_section_sims(postings, sections, vector)
        .withColumn("fit_max", F.try_element_at("top_sims", F.lit(1))["sim"])
        .withColumn("fit_top3", F.when(F.size("top_sims") > 0, mean))
        .withColumn("resume_cos", _dot(resume_vector)(F.col(vector)))
    )


def feature_vector(vector: str = "embedding") -> Column:
    """The model input; the order is a contract: dimensions, fit_max, fit_top3, resume_cos."""
    fits = F.array("fit_max", "fit_top3", "resume_cos")
    return F.when(F.col(vector).isNotNull(), array_to_vector(F.concat(F.col(vector).cast("array<double>"), fits)))


def unit(vector: Column) -> Column:
    """L2-normalized array of doubles; a zero vector stays as it is."""
    norm = F.sqrt(F.aggregate(vector, F.lit(0.0), lambda a, x: a + x * x))
    return F.transform(vector, lambda x: F.when(norm > 0, x / norm).otherwise(x))


def mean_vectors(df: DataFrame, vector: str, *keys: str) -> DataFrame:
    """(keys..., vector): normalized mean vector per key, of all rows without keys.

    The state per key is one running mean, so a key with a third of all rows is reduced to one row
    per task before the shuffle.
    """
    mean = Summarizer.mean(array_to_vector(F.col(vector)))
    means = df.filter(F.col(vector).isNotNull()).groupBy(*keys).agg(mean.alias("_mean"))
    return means.select(*keys, unit(vector_to_array("_mean")).alias("vector"))
