"""From raw documents to token digests in five stages, each written as a table and read again."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from stockpond.llm import bpe, decontaminate, gray_index, line_templates, quality
from stockpond.llm.queries import digests
from stockpond.session import materialize
from stockpond.sources.tables import read_table


def rank_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the preference ranking accepts; it learns from the labels of the documents at hand."""
    return quality.accepted(docs, quality.learn(docs, read_table(spark, sf_dir, "labels")))


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines whose template recurs across documents, short lines and lines without spaces included."""
    return line_templates.without_recurring(docs, short=True, fields_count=False)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash fingerprints link: four-word shingles, four bits, as in the operator's own query."""
    return gray_index.one_of_each(docs, radius=gray_index.RADIUS)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return decontaminate.clean(docs, read_table(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token count and digests of the ids and of the text decoded from them."""
    return digests(bpe.encode_decode(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality classifier", rank_quality),
    ("line dedup", drop_lines),
    ("SimHash near-dedup", drop_near_copies),
    ("benchmark decontamination", drop_leaks),
    ("BPE encoding and decoding", encode),
]

# SQL can express neither the learned ranking nor the tokenizer; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{number}")
    return docs
