"""Hand-scored descriptions and profile documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roleweave.functions.text import split_sections, strip_front_matter

# Fixed value: cell texts that count as "no score".
NOT_A_SCORE = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    """(name, score) of the scored rows of a CSV with Name and Score columns."""
    raw = spark.read.option("header", "true").option("multiLine", "true").csv(path)
    text = F.coalesce(F.col("Score"), F.lit(""))
    return raw.filter(~text.isin(*NOT_A_SCORE)).select(
        F.col("Name").alias("name"), F.col("Score").cast("double").alias("score")
    )


def read_text_files(spark: SparkSession, path: str) -> DataFrame:
    """(name, text): whole files, named by the folder they lie in, with Unix line ends."""
    raw = spark.read.text(path, wholetext=True)
    file = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    return raw.select(
        F.try_element_at(F.split(file, "/"), F.lit(-2)).alias("name"),
        F.regexp_replace("value", "\r\n?", "\n").alias("text"),
    )


def read_descriptions(spark: SparkSession, folder: str) -> DataFrame:
    """(name, description) of `<folder>/<name>/jd.md`, without front matter."""
    files = read_text_files(spark, f"{folder.rstrip('/')}/*/jd.md")
    return files.select("name", strip_front_matter(F.col("text")).alias("description"))


def training_rows(scores: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Scored rows with a description."""
    return scores.join(descriptions, "name")


def skipped_rows(scores: DataFrame, descriptions: DataFrame) -> DataFrame:
    """Scored rows without a description: a missing file or a misspelled name."""
    return scores.join(descriptions.select("name"), "name", "left_anti")


def read_profile(spark: SparkSession, history_path: str, resume_path: str) -> DataFrame:
    """(kind, position, text): the sections of the career history, and the resume as one text."""
    history = read_text_files(spark, history_path).select(
        F.lit("section").alias("kind"), F.posexplode(split_sections(F.col("text"))).alias("position", "text")
    )
    resume = read_text_files(spark, resume_path).select(
        F.lit("resume").alias("kind"), F.lit(0).alias("position"), "text"
    )
    return history.unionByName(resume)
