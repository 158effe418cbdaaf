"""Table schemas and conforming of older tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

S, I, L, D, B = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.BooleanType()

# One normalized posting, as every feed reader returns it. `arrival` orders a batch.
POSTING = T.StructType(
    [
        T.StructField("source", S),
        T.StructField("company", S),
        T.StructField("title", S),
        T.StructField("location", S),
        T.StructField("description", S),
        T.StructField("url", S),
        T.StructField("posted_date", T.DateType()),
        T.StructField("raw_id", S),
        T.StructField("extra_json", S),
    ]
)
POSTING_COLUMNS = POSTING.fieldNames()
REQUIRED = ("url", "source", "company", "title")

# The postings table.
SNAPSHOT = T.StructType(
    [
        T.StructField("id", L),
        T.StructField("url", S),
        T.StructField("raw_id", S),
        T.StructField("source", S),
        T.StructField("company", S),
        T.StructField("title", S),
        T.StructField("location", S),
        T.StructField("description", S),
        T.StructField("posted_date", T.DateType()),
        T.StructField("first_seen_at", T.TimestampType()),
        T.StructField("last_seen_at", T.TimestampType()),
        T.StructField("is_relevant", B),
        T.StructField("extra_json", S),
        T.StructField("score", D),
        T.StructField("application_status", S),
        T.StructField("application_status_updated_at", T.TimestampType()),
        T.StructField("is_remote", I),
    ]
)
SNAPSHOT_COLUMNS = SNAPSHOT.fieldNames()

# One row per run of a source; the counts are null when the run failed.
RUN = T.StructType(
    [
        T.StructField("id", L),
        T.StructField("started_at", T.TimestampType()),
        T.StructField("finished_at", T.TimestampType()),
        T.StructField("source", S),
        T.StructField("fetched_count", L),
        T.StructField("new_count", L),
        T.StructField("updated_count", L),
        T.StructField("error", S),
    ]
)

# Raw aggregator rows; readers fill columns a file lacks with nulls.
AGGREGATOR = T.StructType(
    [T.StructField(name, S) for name in "site company title city state description job_url date_posted".split()]
    + [
        T.StructField("is_remote", B),
        T.StructField("job_type", S),
        T.StructField("min_amount", D),
        T.StructField("max_amount", D),
        T.StructField("currency", S),
        T.StructField("company_industry", S),
    ]
)

COMPANY = T.StructType(
    [
        T.StructField(name, S)
        for name in "company_name ats_type board_identifier tenant careers_url notes site wd_subdomain".split()
    ]
)


def conform(df: DataFrame, schema: T.StructType = SNAPSHOT) -> DataFrame:
    """Bring an older table to `schema`: add missing columns as nulls, default the status to new."""
    present = set(df.columns)
    out = df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )
    if "application_status" in schema.fieldNames():
        out = out.withColumn("application_status", F.coalesce("application_status", F.lit("new")))
    return out
