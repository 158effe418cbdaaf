"""The company list."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roleweave.schemas import COMPANY, conform

OPTIONAL = ("tenant", "site", "wd_subdomain")


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Companies from CSV; optional columns may be absent, and empty ones become null."""
    raw = conform(spark.read.option("header", "true").option("multiLine", "true").csv(path), COMPANY)
    return raw.select(
        *[
            (F.nullif(c, F.lit("")) if c in OPTIONAL else F.coalesce(c, F.lit(""))).alias(c)
            for c in COMPANY.fieldNames()
        ]
    )
