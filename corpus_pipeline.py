"""From raw documents to compressed token ids: the training-data operators in order, each on all that the one before it kept.

Defined results: a null text counts as an empty one in every stage; an empty text is scored like any other and stays if its score does.
Rows are documents: rows that share their id are judged by their own texts, and of equal rows one stays. Rows without an id, and rows
without words, are never near duplicates. A null source is a source of its own. A document that the mix takes n times is n
rows from there on, with n ranges of token ids. Columns beyond those of documents are carried through all stages but the last. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from registrylake.llm import indexing, mixing, probminhash, repair, spacedseeds
from registrylake.llm.queries import END_ID, MIX_LIMIT, MIX_WEIGHTS, table, tokenizer_path
from registrylake.session import materialise, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject (score of at least 0.5)."""
    return indexing.keep_good(docs, table(spark, sf_dir, "labels"))


def near_deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each class of near duplicates."""
    return probminhash.keep_one(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return spacedseeds.clean(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: a row for each time."""
    return mixing.take(docs, MIX_WEIGHTS, 1.0, MIX_LIMIT)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each document's ids are in the compressed output, read back from its files."""
    path = scratch_path(spark, "corpus-token-ids")
    repair.write_shards(docs, path, tokenizer_path("byte_bpe_50k.json"), END_ID)
    return repair.read_documents(spark, path).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", good_quality),
    ("minhash_near_dedup", near_deduplicated),
    ("benchmark_decontamination", decontaminated),
    ("source_mixing", mixed),
    ("token_ids", token_ids),
]

#: a classifier's network and a tokenizer are no SQL; tests/llm compare the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each one's rows are written and read again as the next one's documents."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs
