"""From raw documents to packed training sequences, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all its predecessor kept; ``run``
writes what a stage returns as Parquet in the shared folder and reads it for the next.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lexipress.llm import common, decontaminate, packing, pii, quality, simhash

#: Words of a shingle, and least similarity, of the near-duplicate stage.
SHINGLE = 5
SIMILARITY = 0.8


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the classifier rejects (score under the threshold)."""
    return quality.keep(docs, quality.fit(docs, common.read_table(spark, sf_dir, "labels")))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep, of each group of near duplicates, the document with the smallest doc_id.

    Near duplicates have SimHash fingerprints of five-word shingles at most two bits apart, or
    sets of such shingles of a Jaccard similarity of four fifths or more; documents without
    words are near duplicates of each other.
    """
    return simhash.keep_one(docs, shingle=SHINGLE, similarity=SIMILARITY)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap with a benchmark item."""
    return decontaminate.decontaminate(docs, common.read_table(spark, sf_dir, "benchmark"))


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by its kind in brackets; n_chars is the new length."""
    return pii.redact_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the documents' tokens into sequences: one row a piece."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", keep_quality),
    ("simhash_near_dedup", keep_one_of_each_group),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", redact_personal_data),
    ("best_fit_packing", pack_sequences),
]

#: Nearest neighbours in a latent space, trained fields and tokenizers are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
