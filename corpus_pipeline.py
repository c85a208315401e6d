"""The corpus pipeline: language, near duplicates, mixing, packing.

Each stage takes (spark, docs, sf_dir) and works on every row its predecessor
kept; its result is written as Parquet and read again as the next one's docs.
All stages but the last return the columns of documents; extra columns pass
through. Null texts and texts without letters go in the first stage. Repeated
rows become one in the second; the third repeats documents on purpose. Empty
documents give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.language_id import UNKNOWN, fitted, identify
from tidemark.llm.mixing import mixed_documents
from tidemark.llm.ngram_join import Threshold, one_of_each
from tidemark.llm.packing import packed_documents
from tidemark.plans.scratch import written
from tidemark.sources.tables import table

LEAST_SCORE = 0.35
NEAR = Threshold(shingle=5, num=80, den=100)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject what no language fits: no letters, or no language at `LEAST_SCORE`. The model is fitted on these docs' own labels."""
    found = identify(docs, fitted(docs), ("_lang_pred", "_score"))
    return found.where((F.col("_lang_pred") != UNKNOWN) & (F.col("_score") >= LEAST_SCORE)).select(*docs.columns)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates: five-word shingles, Jaccard of 0.8 or more."""
    return one_of_each(docs, NEAR)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources at their target weights: a document once for each epoch it is in, or not at all."""
    return mixed_documents(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length bucket, batch and slot of every document of the mix."""
    return packed_documents(docs)


STAGES = [
    ("language_id", language_id),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("packing", packing),
]

#: The first stage is a trained network, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
