"""A training-corpus pipeline: quality, language, near-duplicates, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet
in the shared work folder and read again as the next one's docs. Every stage but the last
keeps the columns of documents, and an empty table passes through all of them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candleworks.llm import langid, packing, pii, quality, simhash
from candleworks.llm.text import spare_name, table
from candleworks.session import staged

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and score at least the threshold. Null and empty texts
    fail the base rules; a score equal to the threshold stays; repeated rows are judged alike."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality.keeper(spark, model)("text"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is named with enough certainty. Null texts and texts without a
    letter are rejected; repeated rows are judged alike."""
    name = spare_name(docs, "language")
    named = docs.withColumn(name, langid.predictor(spark, langid.fit(docs))("text"))
    return named.where(~F.col(f"{name}.rejected")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose SimHash fingerprints (three-word shingles) are linked by
    two or fewer differing bits: the one with the smallest id. Rows without an id come last, and
    of rows that repeat an id the one with the smallest hash of its text stays. Null and empty
    texts have fingerprint zero and are one group."""
    return simhash.deduplicated(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with pseudonyms for personal data; null and empty texts stay as they are."""
    return pii.pseudonymised(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, with their ids and places. A null or empty text is one end
    token; repeated rows are packed one by one."""
    return packing.packed(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality_rules),
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("personal_data", personal_data),
    ("packing", pack),
]

#: Fingerprints, trained models and tokenizers are outside SQL; the tests compare each
#: stage with a plain version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
