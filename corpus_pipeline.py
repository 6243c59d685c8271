"""A training corpus from ``documents``, stage by stage.

Each stage takes (spark, docs, sf_dir) and returns the documents it leaves;
:func:`run` writes every stage's result as Parquet in the shared folder and
reads it back as the next one's input.

Every stage takes any documents table (doc_id, text, lang, source and whatever
else): nulls, empty and very long texts, repeated rows and empty tables have
the results that the operators state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorwatch.llm.block_dedup import drop_duplicates
from sensorwatch.llm.common import materialize, read_table, text_column
from sensorwatch.llm.mixing import mix_documents
from sensorwatch.llm.near_dedup import drop_near_duplicates
from sensorwatch.llm.quality_rules import filter_documents
from sensorwatch.llm.sentencepiece_bpe import decode, encode


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the adaptive quality rules."""
    return filter_documents(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_duplicates(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return drop_near_duplicates(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mix_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and whether they decode to its text."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    source = docs.select("doc_id", "source", text_column().alias("text"))
    # written between, else a task holds a Python worker of each kind at once, both with the memory of encoding
    both = decode(materialize(encode(source, model), "pipeline-ids"), model)
    # the space mark is how the model writes a space
    same = F.col("decoded") == F.replace("text", F.lit("▁"), F.lit(" "))
    n = F.size("ids").cast("long")
    return both.select("doc_id", "source", n.alias("n_tokens"), same.alias("round_trip"), "ids")


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("mix", mix), ("tokens", tokens)]

#: The stages' methods (sketches, balancing, merges) have no SQL; the tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
