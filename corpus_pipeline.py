"""Corpus pipeline: toxicity, near duplicates, benchmark decontamination, secrets, and a pass through the tokenizer.

Each stage takes (spark, docs, sf_dir) and returns the rows it keeps; `run` writes each result as Parquet to the shared
folder and reads it again as the next stage's documents. All but the last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from roleweave.llm import arrays, decontaminate, jaccard, pieces, secrets, toxicity
from roleweave.llm.queries import table
from roleweave.session import stage

# Near duplicates: words of a shingle, and least similarity in percent.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain doesn't reject. It is fitted on the labelled rows among `docs`.

    Null and empty texts, repeated rows and rows without an id are judged like all others; other columns stay.
    """
    return toxicity.clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that links of the n-gram Jaccard join connect.

    Rows go by their text, so repeated rows, those that share an id and those without one (which come last) are members like
    others. Null, empty and blank texts link with nothing and all stay.
    """
    return jaccard.one_of_each_group(docs, NEAR_WORDS, NEAR_PERCENT)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't share enough windows with benchmark items, each row judged by its own text; null and empty texts stay."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets in the text replaced by their kind; n_chars stays that of the text as it came.

    Null texts stay null; repeated rows are masked each.
    """
    return secrets.masked(docs)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with `piece_ids`, `n_pieces` and `round_trip`, whether decoding the ids gives the text back.

    Null texts have no ids, empty ones an empty list. Repeated rows are encoded each. Columns of these names that came with the
    documents stay as they are; the new ones then end in underscores.
    """
    names = tuple(arrays.unused(docs.columns, c) for c in ("piece_ids", "n_pieces", "round_trip"))
    return pieces.tokenized(docs, pieces.load(), names)


STAGES = [
    ("toxicity", drop_toxic),
    ("near duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secrets", mask_secrets),
    ("sentencepiece", tokenize),
]

# The first stage is a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline_{name.replace(' ', '_')}")
    return docs
