"""The corpus pipeline: each stage works on all that the one before it kept.

language ID -> SimHash near-duplicates -> secret scan -> mixing -> packing
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakecare.llm import langid, mixing, packing, secret_scan, simhash
from lakecare.llm.common import remainder, table
from lakecare.llm.queries import LANGUAGE_FOLDS, LANGUAGE_HELD
from lakecare.session import delete_path, owned_scratch, scratch_path


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that is told clearly; ``lang`` becomes the language found.

    Without any labelled row nothing can be told, and all documents with a letter stay.
    """
    held = remainder("doc_id", LANGUAGE_FOLDS) == LANGUAGE_HELD
    model = langid.train(docs.where(~held).select("doc_id", "text", "lang"))
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = langid.identify(docs.select(F.struct("*").alias("doc"), "text"), model)
    kept = found.where((F.col("lang_pred") != langid.UNKNOWN) & ~F.col("ambiguous"))
    return kept.select(F.col("doc").withField("lang", F.col("lang_pred")).alias("doc")).select("doc.*")


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates."""
    return simhash.keep_first(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a placeholder."""
    return secret_scan.redact(docs, scratch_path(spark, "secret-ledger"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.emit(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", known_language),
    ("simhash_near_dedup", one_of_each),
    ("secret_scan", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: A trained classifier and a tokenizer have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage has staged, and its input, are deleted once its result is written."""
    docs, last = table(spark, sf_dir, "documents"), None
    for name, step in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        with owned_scratch(spark):
            out = step(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if last is not None:
            delete_path(spark, last)
        last = path
    return docs
