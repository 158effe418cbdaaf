"""Text encoders. An encoder turns a text column into normalized vectors and can name itself."""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.feature import HashingTF, Normalizer
from pyspark.ml.functions import predict_batch_udf, vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roleweave.functions.text import SPACE
from roleweave.operators.similarity import unit
from roleweave.vocabulary import EMBEDDING_BATCH, EMBEDDING_PREFIX


class Encoder(Protocol):
    """What scoring and training need from an encoder."""

    def encode(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame: ...

    def fingerprint(self) -> dict[str, str]:
        """What identifies the vector space; scoring refuses a model from another one."""
        ...


class HashingEncoder:
    """Hashed term counts, normalized. Needs no model file and stays in the JVM."""

    def __init__(self, dims: int = 768) -> None:
        self.dims = dims

    def encode(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        prefixed = F.concat(F.lit(EMBEDDING_PREFIX), F.coalesce(text, F.lit("")))
        words = F.filter(F.split(F.lower(prefixed), rf"(?U)[^\w]+|{SPACE}+"), lambda w: w != "")
        counted = HashingTF(numFeatures=self.dims, inputCol="_words", outputCol="_counts").transform(
            df.withColumn("_words", words)
        )
        scaled = Normalizer(p=2.0, inputCol="_counts", outputCol="_scaled").transform(counted)
        return scaled.withColumn(out, vector_to_array("_scaled", "float32")).drop("_words", "_counts", "_scaled")

    def fingerprint(self) -> dict[str, str]:
        return {"encoder": "hashing", "dims": str(self.dims), "prefix": EMBEDDING_PREFIX}


class ModelEncoder:
    """Any batch model: `make_predict` runs once per worker and returns texts -> 2-D array.

    The batch size bounds memory and does not change the vectors.
    """

    def __init__(
        self,
        make_predict: Callable[[], Callable[[np.ndarray], np.ndarray]],
        name: str,
        revision: str | None = None,
        batch_size: int = EMBEDDING_BATCH,
    ) -> None:
        self.make_predict = make_predict
        self.name = name
        self.revision = revision
        self.batch_size = batch_size

    def encode(self, df: DataFrame, text: str, out: str = "embedding") -> DataFrame:
        predict = predict_batch_udf(
            self.make_predict, return_type=T.ArrayType(T.FloatType()), batch_size=self.batch_size
        )
        prefixed = F.concat(F.lit(EMBEDDING_PREFIX), F.coalesce(text, F.lit("")))
        raw = df.withColumn(out, predict(prefixed).cast("array<double>"))
        return raw.withColumn(out, unit(F.col(out)).cast("array<float>"))

    def fingerprint(self) -> dict[str, str]:
        return {"encoder": self.name, "revision": str(self.revision), "prefix": EMBEDDING_PREFIX}


def reference_vectors(profile: DataFrame, encoder: Encoder, cache_path: str) -> DataFrame:
    """Vectors of profile texts (kind, position, text), cached by content.

    Only texts whose hash is not stored for this encoder are encoded; stored hashes the profile no
    longer has are ignored. Returns (kind, position, vector).
    """
    spark: SparkSession = profile.sparkSession
    space = "|".join(f"{k}={v}" for k, v in sorted(encoder.fingerprint().items()))
    wanted = profile.withColumn("key", F.sha2(F.concat(F.lit(space + "\x00"), "text"), 256))
    schema = "key string, vector array<float>"
    try:
        stored = spark.read.schema(schema).parquet(cache_path)
        missing = wanted.join(stored, "key", "left_anti")
    except AnalysisException:  # first use
        missing = wanted
    missing = missing.select("key", "text").dropDuplicates(["key"])
    if not missing.isEmpty():
        encoder.encode(missing, "text", "vector").select("key", "vector").write.mode("append").parquet(cache_path)
    stored = spark.read.schema(schema).parquet(cache_path).dropDuplicates(["key"])
    return wanted.join(stored, "key").select("kind", "position", "vector")
