from __future__ import annotations

import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from roleweave.schemas import POSTING  # noqa: E402
from roleweave.session import build_session, scratch_path  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        spark__sql__shuffle__partitions="4",
        spark__ui__enabled="false",
        spark__driver__memory="6g",
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def root(spark):
    """A fresh folder in the shared scratch area."""
    return scratch_path(spark, "test")


@pytest.fixture
def one(spark):
    """Evaluate column expressions on one row of named values."""
    from pyspark.sql import functions as F

    def evaluate(column, schema: str = "x string", *values):
        row = spark.createDataFrame([values], schema).select(column(F.col("x")).alias("v")).first()
        return row.v

    return evaluate


@pytest.fixture
def batch(spark):
    """Normalized postings from short dicts; the list order is the arrival order."""
    from pyspark.sql import functions as F
    from pyspark.sql import types as T

    defaults = dict(
        source="greenhouse",
        company="Acme",
        title="Bioinformatics Scientist",
        location=None,
        description="text",
        url="https://example.com/1",
        posted_date=None,
        raw_id=None,
        extra_json="{}",
    )

    def build(*rows: dict):
        schema = T.StructType(POSTING.fields + [T.StructField("arrival", T.IntegerType())])
        data = [tuple({**defaults, **row}[f] for f in POSTING.fieldNames()) + (i,) for i, row in enumerate(rows)]
        return spark.createDataFrame(data, schema).withColumn("arrival", F.col("arrival"))

    return build


def day(text: str) -> date:
    return date.fromisoformat(text)


def plan_of(df) -> str:
    """Formatted physical plan."""
    import contextlib
    import io

    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()
