"""The corpus pipeline: documents to packed token sequences, in stages that keep what they can.

Each stage takes (spark, docs, sf_dir) and returns a frame; between stages the rows are written
as Parquet and read again.  ``run`` applies all stages to ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ticksmith.llm import decontam, langid, packing, secrets, simhash
from ticksmith.llm.common import table
from ticksmith.session import ensure_checkpoint_dir, ship_package, staged

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that fit no language; others keep their rows.

    Those are null, without a letter, or far harder to code than the labelled documents of the
    language that suits them best (garble, scripts and languages without labels).  Without any
    label all documents stay.
    """
    found = langid.judge(docs, langid.fit_halves(docs), result_col="__language")
    return found.filter(found["__language.fits"]).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates stays, that with the smallest doc_id."""
    return simhash.keep_one(docs.select(*COLUMNS), shingle=3, max_bits=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops every document that holds a ten-word window of a benchmark item."""
    return decontam.drop_contaminated(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document stays; each secret found in it is replaced by its kind in brackets, and n_chars follows."""
    found = secrets.scan(docs.select(*COLUMNS), result_col="__secrets")
    text = secrets.redact(F.col("text"), F.col("__secrets.spans"))
    any_found = F.size("__secrets.spans") > 0
    return found.select(
        "doc_id", text.alias("text"), "lang", "source",
        F.when(any_found, F.length(text).cast("bigint")).otherwise(F.col("n_chars")).alias("n_chars"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of sequences of at most 4096 tokens, with their token ids.

    Workers that have served the stages before hold their tables too, so fewer words are remembered.
    """
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), memo_words=1 << 16)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scan", secret_scan),
    ("packing", packed),
]

#: No SQL: language identification, fingerprints and tokenisation are beyond it; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each reading what the one before it wrote."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = staged(docs, "pipeline", name)
    return docs
