"""From raw documents to token ids: five stages, each over all that the one before kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptorium.llm import bpe, exact_dedup, language_id, mixing, near_dedup
from scriptorium.llm.common import staged, table

VOCABULARY = "word_bpe_49k.json"


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the character models recognise; the rejected go.

    Models learn from the same documents that have a label and a text. Null, empty and letterless texts go; null ids, labels and
    sources, ties and repeated rows are judged by their text alone; an empty table gives none. All columns stay.
    """
    return language_id.keep_identified(docs, docs, "lang")


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (A-Z lower-cased), the document with the largest id, with all columns.

    Null texts count as empty. Rows without an id go where an equal text has one; rows that repeat id and text stay together.
    """
    return exact_dedup.drop_exact_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, similarity 0.8), that with the smallest id, with all columns.

    Null, empty and wordless texts and rows without an id are near copies of nothing and stay; repeated rows stay together.
    """
    return near_dedup.drop_near_copies(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, with all columns; a null source is a source of its own.

    Wordless texts stay once; rows without an id go, as no mix can name them. Reruns agree.
    """
    return mixing.take_mix(docs, F.array("source"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of the mix, once for each time it is taken; null texts are empty."""
    return bpe.round_trip_digests(docs, public_tokenizers.path(VOCABULARY))


STAGES = [("language_id", identify_language), ("exact_dedup", exact_copies), ("near_dedup", near_copies), ("mix_sources", mix), ("bpe_encode", encode)]

#: Language models and vocabularies have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other over the table documents, each written and read again; rows as the last one gives them."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{name}")
    return docs
