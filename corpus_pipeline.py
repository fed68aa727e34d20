"""A training corpus from raw documents: five stages, each on the written result of the one before.

Toxic documents go, then those in no learned language, then all but one of each group of near
duplicates; passages that repeat are cut out of what is left, and the rest is packed into sequences
of token ids. Every stage but the last returns the columns it was given, whatever their names, and
takes nulls in any of them, empty and very long texts (read whole), repeated rows and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daygrain.llm import language_id, near_duplicates, packing, suffix_dedup, toxicity
from daygrain.llm.queries import tokenizer
from daygrain.llm.tables import ship, table, written


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a lexicon learned from ``labels`` does not reject.

    Null and empty texts have no term and stay; rows with equal texts share their fate; without labels
    of both kinds all rows stay.
    """
    labels = toxicity.training_labels(table(spark, sf_dir, "labels"))
    return toxicity.harmless(docs, toxicity.learn_from(toxicity.chosen_texts(docs, labels)))


def in_a_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a network learned from their ``lang`` gives a language.

    Null texts and texts without a letter go; rows with equal texts share their fate; of equally likely
    languages the first by name counts; without any ``lang`` all rows stay.
    """
    ship(spark)
    return language_id.in_languages(docs, language_id.train(language_id.training_sample(docs)))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8.

    The smallest id of a group stays, with all rows that have it; rows without id and rows without
    words are alone and stay.
    """
    ship(spark)
    return near_duplicates.first_of_each(docs, size=5, threshold=80)


def without_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages of 100 bytes and more that also start earlier.

    Earlier is a smaller id, a null id first, or an earlier place; rows of one id are ordered by a checksum
    of their text, and repeats of a row are one document. All rows stay, null texts as they are.
    """
    ship(spark)
    return suffix_dedup.without_repeats(docs, length=100)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 4096 token ids.

    A null or empty text is one end id; repeated rows are packed each; a null id stays null.
    """
    ship(spark)
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"), size=4096)


STAGES = [
    ("toxicity", without_toxic),
    ("language_id", in_a_language),
    ("near_duplicates", one_of_each),
    ("suffix_dedup", without_repeats),
    ("packing", packed),
]

#: Learned models, sketches and tokenizers are not for SQL; tests compare each stage with plain code:
#: scores by the same model for the first two, brute force for the next two, rebuilt ids for the last.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order, from ``documents`` to packed sequences."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
