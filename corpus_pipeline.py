"""Corpus pipeline over ``documents``: clean, deduplicate, decontaminate, mask, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is
written as Parquet to the shared scratch folder and read again as the next
stage's ``docs``. All stages but the last return the columns of ``docs``.

* ``toxicity``: fits the classifier on the labelled documents of ``sf_dir`` (never
  on held-out ones) and drops the documents it rejects.
* ``near_duplicates``: keeps, of each group linked at 0.8 over five-word
  shingles, the document with the least id; rows without an id stay.
* ``decontaminate``: drops documents that hold a benchmark item.
* ``secrets``: masks every found secret in the text and refreshes
  ``n_chars``; no document is dropped.
* ``pack``: lays the tokens of the kept documents into sequences.

Documents that no stage objects to pass through unchanged. Null texts count
as empty where text is needed and stay null; ids may be null or repeated.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsewatch.llm import decontam, packing, secretscan, setsketch, toxicity
from pulsewatch.llm.common import saved, table
from pulsewatch.llm.queries import tokenizer_path
from pulsewatch.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    model = toxicity.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return toxicity.accepted(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return setsketch.representatives(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets masked."""
    ledger = secretscan.Ledger(spark, scratch_path(spark, "secret-ledger"))
    masked = secretscan.redacted(docs, ledger)
    if "n_chars" not in docs.columns:
        return masked
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.coalesce(length, "n_chars"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence of at most 1024 tokens."""
    return packing.pack(docs, packing.Settings(tokenizer_path()))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontaminate", decontaminate),
    ("secrets", mask_secrets),
    ("pack", pack_sequences),
]

#: SQL can express neither the classifier nor the tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; the result of the last."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
