"""A corpus pipeline of five stages, each written and read again: language ID, exact and near deduplication, mixing, encoding."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stationflow.llm import cross_parse, exact_dedup, ngram_join, sentencepiece_trie, temperature_mix
from stationflow.llm.names import free_names
from stationflow.llm.queries import ENTROPY_SHARE, REPETITION, sentencepiece_model
from stationflow.session import materialise


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told. Learns from the rows that are not held out.

    Those without a letter go, and those that even the best language tells no better than byte by byte
    (LITERAL_BITS a byte): strings of letters that are no words of a language learned.
    """
    models = cross_parse.learn(docs.filter(~cross_parse.held_out()))
    pred, score = free_names(docs, "pred", "score")
    told = cross_parse.identify(docs, models, pred=pred, score=score, most_bits=cross_parse.LITERAL_BITS)
    return told.filter(F.col(pred) != cross_parse.UNDECIDED).select(*[f"`{c}`" for c in docs.columns])


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts, the one with the largest doc_id."""
    return exact_dedup.drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies (five words, 0.8), the one with the smallest doc_id; a document in no class stays."""
    return ngram_join.drop_near_copies(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's weight gives, within the tokens there are."""
    return temperature_mix.mix_documents(docs, ENTROPY_SHARE, REPETITION)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every text."""
    return sentencepiece_trie.encode(docs.select("doc_id", "lang", "source", "text"), sentencepiece_model()).drop("text")


STAGES = [("language_id", language), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mix), ("sentencepiece", pieces)]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each one's result written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
