"""A corpus pipeline: from raw documents to token ids, in stages that are each written and read again.

Each stage takes the documents its predecessor kept, with all their columns,
and handles nulls, repeats and empty tables as its operator does.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from periodlens.llm import byte_bpe, language_id, mixing, near_dedup, toxicity
from periodlens.llm.common import held_out, read_table
from periodlens.session import pin

#: No stage but the fourth can be said in SQL.
ORACLE_SQL = None


def _aside(docs: DataFrame, names: list[str]) -> DataFrame:
    """``docs`` with the columns renamed that an operator would replace."""
    return docs.withColumnsRenamed({name: f"_aside_{name}" for name in names})


def _columns_of(df: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` only, under their names."""
    aside = {name: f"_aside_{name}" for name in docs.columns}
    return df.select(*[F.col(aside[name] if aside[name] in df.columns else name).alias(name) for name in docs.columns])


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that ``lang`` of the others teaches; those without letters, and those no
    model of a language codes better than raw bytes, go."""
    model = language_id.fit(docs.where(~held_out(4, 2)))
    found = language_id.identify(_aside(docs, language_id.ADDED.names), model)
    return _columns_of(found.where(language_id.accepted()), docs)


def not_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not find toxic; it learns from labelled documents of this stage's input."""
    grammar = toxicity.fit(docs, read_table(spark, sf_dir, "labels").where(~held_out(5, 0)))
    scored = toxicity.score(_aside(docs, toxicity.ADDED.names), grammar)
    return _columns_of(scored.where("predicted = 0"), docs)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near duplicates."""
    return near_dedup.keep_one(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, repeated or left out as the target weights of their sources call for."""
    return mixing.repeat_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document: doc_id, lang, source, n_tokens, tokens, and whether decoding gives the text back."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = byte_bpe.read_vocabulary(path, public_tokenizers.PATTERN)
    # One pass: a second one would double the Python workers and pass all ids through Arrow again.
    encoded = byte_bpe.encode(docs.select("doc_id", "lang", "source", "text"), vocabulary, check=True)
    return encoded.select("doc_id", "lang", "source", "n_tokens", "tokens", "whole")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("known_language", known_language),
    ("not_toxic", not_toxic),
    ("one_of_each_group", one_of_each_group),
    ("mixed", mixed),
    ("tokens", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written to the shared folder and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = pin(stage(spark, docs, sf_dir), name)
    return docs
