"""Registered queries of this subpackage and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from periodlens.llm import byte_bpe, code_search, embedding_dedup, language_id, licenses, mixing, near_dedup, neural_lm, phrases, secret_scan, spelling, toxicity, url_filter
from periodlens.llm.common import held_out, read_table
from periodlens.session import pin


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document; learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").withColumn("held_out", held_out(4, 2))
    model = language_id.fit(docs.where("NOT held_out"))
    found = language_id.identify(docs.select("doc_id", "text", "held_out"), model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "bits_per_byte")


def op2_code_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest sign codes of every vector whose id is divisible by 50, among all vectors."""
    vectors = read_table(spark, sf_dir, "embeddings")
    codes = pin(vectors.select("vec_id", code_search.binary_code(F.col("embedding")).alias("code")), "codes")
    return code_search.nearest(codes, codes.where("vec_id % 50 = 0"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels are learned from the rows that are not held out."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").where(~held_out(5, 0))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select("doc_id", held_out(5, 0).alias("held_out"), "score", "predicted")


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of every document: its canonical digest, the licence that has it, and notices among its lines."""
    return licenses.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the multilingual byte-level vocabulary."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    vocabulary = byte_bpe.read_vocabulary(path, public_tokenizers.PATTERN)
    return byte_bpe.round_trip(read_table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mixture to target weights takes of every document."""
    mixture = mixing.mix(read_table(spark, sf_dir, "documents"))
    return mixing.taken_words(mixture).select("doc_id", "size", "source_size", "target", "taken")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the URL of every page: the longest rule that fits, else the words of host and path."""
    return url_filter.judge(read_table(spark, sf_dir, "pages"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all vectors of a label: cosine 0.93 or more."""
    return embedding_dedup.near_duplicates(read_table(spark, sf_dir, "embeddings"))


def op9_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents: five-word shingles, similarity 0.75 or more."""
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op10_neural_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log probability of every document under a log-bilinear model and under counted words."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", held_out(7, 2).alias("held_out"))
    return neural_lm.score_texts(docs, docs.where("NOT held_out"))


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: counts and digest of the base kinds, spans of all kinds."""
    return secret_scan.digest(secret_scan.scan(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of each language, over all documents."""
    return phrases.collocations(read_table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among the words of all documents."""
    return spelling.variants(spelling.count_words(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_code_search": op2_code_search,
        "op3_toxicity": op3_toxicity,
        "op4_licenses": op4_licenses,
        "op5_byte_bpe": op5_byte_bpe,
        "op6_mixing": op6_mixing,
        "op7_url_filter": op7_url_filter,
        "op8_embedding_dedup": op8_embedding_dedup,
        "op9_near_dedup": op9_near_dedup,
        "op10_neural_lm": op10_neural_lm,
        "op11_secret_scan": op11_secret_scan,
        "op12_phrases": op12_phrases,
        "op13_spelling": op13_spelling,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_code_search": code_search.oracle_sql(),
        "op4_licenses": licenses.oracle_sql(),
        "op6_mixing": mixing.oracle_sql(),
        "op11_secret_scan": secret_scan.oracle_sql(),
        "op12_phrases": phrases.oracle_sql(),
        "op13_spelling": spelling.oracle_sql(),
        **({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {}),
    }
