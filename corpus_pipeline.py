"""Corpus pipeline: raw documents to packed training sequences.

Stages: drop what the quality classifier rejects, drop exact copies, keep one document
of each near-duplicate class, mix the sources to their target weights, pack token
sequences. Each works on all rows that its predecessor kept, and each result is
written as Parquet and read again for the next. All but the last return the columns of
``documents``; the last returns one row per packed piece.

Nulls: a null text is an empty one (scored as such; all of them are one exact group;
without words the mix takes nothing of them), a null id is carried along, a null source
is a source of its own. An empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docspark.llm import mixture, neardup, packing, quality, radix
from docspark.llm.common import read, stored

THRESHOLD = 0.3  # documents with a lower score are rejected


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    network = quality.fit(docs, read(spark, sf_dir, "labels"))
    return docs.where(quality.probability_of(network) >= THRESHOLD)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts that are equal but for white space."""
    return radix.exact_groups(docs, carry=True).where("kept").select("doc.*")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: five words, similarity 0.8."""
    return neardup.representatives(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: rows taken twice occur twice, rows that are not taken go."""
    mixed = mixture.mixed_rows(docs)
    return mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else mixed


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece with its sequence and place."""
    pieces = packing.pieces(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return packing.pack(stored(pieces))


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("source mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A network's scores and byte-pair ids are beyond SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
