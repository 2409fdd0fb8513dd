"""The corpus pipeline: stages over documents, each written as Parquet and read again as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablemend.llm import lines, mixing, packing, simhash, toxicity
from tablemend.llm.names import free_name
from tablemend.session import materialize

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

VOCABULARY = "word_bpe_49k.json"
TOXIC = 0.3


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold, by a model fitted to the labels of the folder."""
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(toxicity.score(model, "text") < TOXIC)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without runs of lines seen before; those of which nothing is left go."""
    cleaned = lines.dedupe_lines(docs)
    found = free_name(docs.columns, "found")
    emptied = (F.col(f"{found}.removed_lines") > 0) & (F.trim(F.translate("text", "\n\r\t", "   ")) == "")
    kept = cleaned.where(emptied.isNull() | ~emptied)
    n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return kept.withColumn("n_chars", n_chars).select(*docs.columns)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by fingerprints of three-word shingles within three bits."""
    return simhash.one_of_each(docs, words=3, bits=3)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources brought closer together, none repeated more than twice."""
    return mixing.mix(docs, most=2.0).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in pieces with their place in sequences of 2048."""
    # Workers also hold what the stages before left behind, so less text at a time.
    return packing.pack(docs, public_tokenizers.path(VOCABULARY), part_bytes=2 << 20)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", reject_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_dedup", keep_one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# SQL cannot say a fitted model, XXH64 shingles or a tokenizer: tests/llm holds `run` against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages applied to the documents of a folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
