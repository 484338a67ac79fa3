"""A training-corpus pipeline over `documents`: each stage is one of the operators of fieldmart.llm, written as Parquet and read again.

Stages take (spark, docs, sf_dir) and return a DataFrame; all but the last return the columns of documents. Every stage
judges rows by their own text, so rows of one doc_id, repeated rows and rows without a doc_id stand alone (near_duplicates:
rows of one doc_id and text are one document, rows without a doc_id stay). Empty tables pass through all stages.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fieldmart.llm.bpe import round_trip
from fieldmart.llm.common import kept, made_since, remove, table
from fieldmart.llm.gru import with_language
from fieldmart.llm.minhash import first_of_each
from fieldmart.llm.semicrf import redacted
from fieldmart.llm.wumanber import uncontaminated

MOST_HIT = 0.0
"""Share of a document's words in benchmark windows above which it goes: any occurrence is contamination."""


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told (no text, or no letter in it) go; those without a language get the predicted one."""
    return with_language(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose sets of five-word shingles are linked at a similarity of 0.8, directly or through others, the smallest doc_id stays."""
    return first_of_each(docs, words_per_shingle=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a window of ten words of a benchmark item occurs go."""
    return uncontaminated(docs, table(spark, sf_dir, "benchmark"), MOST_HIT)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets; no document goes."""
    return redacted(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers and digests of each document's token ids and of the text decoded from them."""
    return round_trip(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("token_ids", token_ids)]

ORACLE_SQL = None  # the models of the first and fourth stages can't be written in SQL; tests hold run() against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over documents. What a stage has written is removed when the next one's rows are written."""
    docs, began = table(spark, sf_dir, "documents"), len(made_since())
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = kept(docs, name)
            remove(spark, made_since(began)[:-1])
            began = len(made_since()) - 1
    return docs
