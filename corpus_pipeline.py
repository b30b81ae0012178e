"""From raw documents to packed sequences: five stages, each written and read again.

quality rules -> line dedup -> n-gram Jaccard join -> mixing -> packing
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessera.llm import line_dedup, mixing, ngram_join, packing, quality
from tessera.llm.common import WORD, documents, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a fertility band go."""
    return quality.kept_documents(docs)


def drop_boilerplate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Boilerplate lines go from all documents but the first that has them. A document that had
    words and has none left goes too; n_chars follows the text."""
    out = line_dedup.rewritten(docs)
    out = out.where((F.col("n_removed") == 0) | F.rlike(F.col("text"), F.lit(WORD)))
    new = {c: F.col("row")[c] for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("n_removed") > 0, changed).otherwise(new["n_chars"])
    return out.select(*[v.alias(c) for c, v in new.items()])


def drop_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of similar ones stays, the smallest id: five words, 0.8."""
    return ngram_join.one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per document and repeat, in the order of the schedule."""
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sequences of token ids."""
    return packing.packed_sequences(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("line_dedup", drop_boilerplate),
    ("ngram_join", drop_similar),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Tokens, fertility and the schedule's order are beyond SQL; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; every result is a table in the shared folder."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
