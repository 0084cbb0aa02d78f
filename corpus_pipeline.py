"""Training-data pipeline over ``documents``: five stages, each written as
Parquet and read again as the next one's input.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the
last return the columns of ``documents``:

1. documents the quality classifier rejects go;
2. one document of each class of near duplicates stays;
3. bytes of 200-byte strings that stand elsewhere too are cut from the texts;
4. sources are mixed to their target weights: a row for each document and
   epoch that takes words of it, with these words;
5. what is left is packed into sequences: a row for each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cityair.llm import mixing, near_dup, packing, quality, suffix_dedup
from cityair.llm.common import landed, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_rows(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return near_dup.one_of_each(docs)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return suffix_dedup.dedup_texts(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix_texts(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs)


STAGES = [
    ("quality_classifier", keep_good),
    ("near_duplicates", drop_near_duplicates),
    ("suffix_dedup", cut_repeated_passages),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_sequences),
]

# Trained models, samples by hash and tokenizers are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
