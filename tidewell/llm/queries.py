"""Registered queries of the operators over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewell.llm import (
    alignment,
    chat,
    decontaminate,
    divergence,
    language,
    neardup,
    neighbours,
    packing,
    pii,
    quality,
    substrings,
    tokens,
    warc,
)
from tidewell.llm.workers import ship
from tidewell.session import configure

VOCABULARY = "byte_bpe_50k.json"
PIECES = "piece_bpe_32k.model"
# A key of one's own goes here in production; the queries need a stated one.
PSEUDONYM_KEY = "tidewell"


def vocabulary(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file on any machine that has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def prepare(spark: SparkSession) -> SparkSession:
    """Make the session and its executors ready for the operators."""
    ship(configure(spark))
    # texts may be long, so an Arrow batch has few rows
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "512")
    # and a row group of them is large: read by ranges at once, every reading thread would
    # keep a buffer of that size outside the heap
    spark.conf.set("parquet.hadoop.vectored.io.enabled", "false")
    return spark


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def op1_role_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every turn of every conversation, repaired and rendered."""
    return chat.repaired(table(spark, sf_dir, "conversations"))


def op2_subword_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op3_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that overlaps a benchmark item, with the item."""
    return decontaminate.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 2048 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), vocabulary())


def op5_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the windows of 50 words that repeat under smaller ids."""
    return substrings.without_repeats(table(spark, sf_dir, "documents"))


def op6_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's text with pseudonyms, and how many values were replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, PSEUDONYM_KEY, count="n_replaced")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return tokens.count_tokens(table(spark, sf_dir, "documents"), vocabulary())


def op8_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near-duplicates of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_collision_counting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth vector."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_kneser_ney_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.fit(docs))


def op11_pair_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How two tokenizers' tokens of every document align, scored over the corpus."""
    return alignment.align(table(spark, sf_dir, "documents"), vocabulary(), vocabulary(PIECES))


def op12_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its record comes back from the archives."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distances of the sources of every language and the terms that mark them."""
    return divergence.audit(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_role_repair,
        op2_subword_quality,
        op3_spaced_seeds,
        op4_best_fit_packing,
        op5_fm_index,
        op6_feistel_pseudonyms,
        op7_token_counts,
        op8_lsh_forest,
        op9_collision_counting,
        op10_kneser_ney_language,
        op11_pair_bitmaps,
        op12_warc_salvage,
        op13_source_divergence,
    )
}

ORACLE_SQL: dict[str, str] = {
    "op3_spaced_seeds": decontaminate.ORACLE_SQL.strip(),
    "op12_warc_salvage": warc.ORACLE_SQL.strip(),
    "op13_source_divergence": divergence.ORACLE_SQL.strip(),
}
