"""The corpus pipeline over ``documents``: each stage is written and reread as the next one's input."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from playlake.llm.common import documents
from playlake.llm.decontamination import drop_contaminated
from playlake.llm.exact_dedup import drop_exact_copies
from playlake.llm.packing import pack
from playlake.llm.quality import keep_quality, train
from playlake.llm.simhash import drop_near_copies
from playlake.session import clear_scratch, scratch_mark, scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents the classifier, trained on the labelled ones, does not reject."""
    return keep_quality(docs, train(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies."""
    return drop_near_copies(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, packed into training sequences."""
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A trained classifier, connected components and packing have no SQL form; see tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage in order over the whole ``documents`` table."""
    docs, start = documents(spark, sf_dir), scratch_mark()
    for _, stage in STAGES[:-1]:
        result, path = stage(spark, docs, sf_dir), scratch_path(spark, "pipeline")
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        clear_scratch(spark, start, keep=(path,))  # the stage's own tables and its predecessor's
    return STAGES[-1][1](spark, docs, sf_dir)
